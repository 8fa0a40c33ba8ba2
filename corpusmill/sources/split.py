"""JSON arrays and quoted CSV files read by many tasks each.

Neither format can be cut at a line end, as a line end (or a bracket) may lie within quotes. Spark's text scan cuts any
file into byte ranges at a separator (``}`` for JSON, a line feed for CSV), so each range holds whole pieces. Two passes
tell what the pieces are:

1. Each range is summed up once: the parity of its quotes and, for both states in which it may begin (outside or inside
   quotes), how the bracket depth moves. Running sums over the ranges of a file then give the state and depth at which
   each range begins, and the range in which a record begins that reaches over its end.
2. Each range, told its beginning, cuts its records. Those within one range leave at once; the parts of the others meet
   by the range in which they begin.

Only Spark's scan opens files, so a path may be any that Spark reads. A compressed file is one range.

Assumed: UTF-8, and in CSV that a quote stands only around a field or doubled within a quoted one.
"""
from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.session import cut_lineage

SEPARATOR = {"json": "}", "csv": "\n"}
KEY = ("path", "start", "length")
#: Ranges up to which their beginnings are broadcast (some 100 bytes each); beyond, pieces are sent to them.
MOST_BROADCAST = 100_000

_QUOTE, _ESCAPE, _FEED = b'"\\\n'
_STEP = np.zeros(256, np.int64)
_STEP[list(b"{[")], _STEP[list(b"}]")] = 1, -1
_MARK = _STEP != 0
_MARK[[_QUOTE, _ESCAPE]] = True


def _json_marks(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of brackets and quotes, 1 where a quote is not escaped, and the step that a bracket takes."""
    at = np.flatnonzero(_MARK[raw])
    kind = raw[at]
    escapes = at[kind == _ESCAPE]
    at, kind = at[kind != _ESCAPE], kind[kind != _ESCAPE]
    quote = kind == _QUOTE
    if len(escapes):
        first = escapes[np.diff(escapes, prepend=-2) != 1]
        after = quote & (at > 0) & (raw[at - 1] == _ESCAPE)
        run = at[after] - first[np.searchsorted(first, at[after] - 1, "right") - 1]
        quote[after] = run % 2 == 0
    return at, quote.astype(np.int64), _STEP[kind]


def _csv_marks(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero((raw == _QUOTE) | (raw == _FEED))
    return at, (raw[at] == _QUOTE).astype(np.int64)


def _runs(batch: pa.RecordBatch, separator: bytes) -> Iterator[tuple[int, bytes]]:
    """(first row, bytes) for each stretch of a batch that lies in one range."""
    keys = list(zip(*(batch.column(k).to_pylist() for k in KEY)))
    pieces = batch.column("piece").to_pylist()
    at = 0
    while at < len(keys):
        end = at + 1
        while end < len(keys) and keys[end] == keys[at]:
            end += 1
        yield at, separator.join(pieces[at:end]) + separator
        at = end


def _summaries(kind: str):
    separator = SEPARATOR[kind].encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, buf in _runs(batch, separator):
                raw = np.frombuffer(buf, np.uint8)
                at, quote, *step = _json_marks(raw) if kind == "json" else _csv_marks(raw)
                within = (np.cumsum(quote) - quote) % 2
                sums = []
                for state in (0, 1):
                    if kind == "json":
                        depth = np.cumsum(step[0] * (within == state))
                        sums += [int(depth[-1]) if len(depth) else 0, min(0, int(depth.min(initial=0)))]
                    else:  # records that end here
                        sums += [0, int(((quote == 0) & (within == state)).sum())]
                text = buf.lstrip(b"\xef\xbb\xbf \t\r\n")[:1]
                rows.append((*(batch.column(k)[row].as_py() for k in KEY), batch.column("place")[row].as_py(),
                             int(quote.sum()), *sums, text))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=_SUMMARY)

    return run


_SUMMARY = [*KEY, "place", "quotes", "move0", "low0", "move1", "low1", "opens"]
_SUMMARY_TYPE = ("path string, start long, length long, place long, quotes long, "
                 "move0 long, low0 long, move1 long, low1 long, opens binary")


def _pieces(spark: SparkSession, path: str, kind: str) -> DataFrame:
    m = "_metadata."
    return spark.read.option("lineSep", SEPARATOR[kind]).text(path).select(
        F.col("value").cast("binary").alias("piece"), F.col(m + "file_path").alias("path"),
        F.col(m + "file_block_start").alias("start"), F.col(m + "file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("place"))


def _starts(pieces: DataFrame, kind: str) -> DataFrame:
    """One row per range: ``state`` and ``depth`` at its beginning, ``inside`` (it begins within a record), ``owns`` (a
    record begins in it and reaches over its end) and ``owner`` (the range where the record that it begins within began).
    The sums of several batches of a range are put together first."""
    s = pieces.mapInArrow(_summaries(kind), _SUMMARY_TYPE)
    batch = Window.partitionBy(*KEY).orderBy("place")
    before = batch.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    s = s.select("*", *(F.when(turned, F.col(f"{c}{1 - i}")).otherwise(F.col(f"{c}{i}")).alias(f"{c}_{i}") for c in ("move", "low") for i in (0, 1)))
    if kind == "json":
        s = s.select("*", *((F.coalesce(F.sum(f"move_{i}").over(before), F.lit(0)) + F.col(f"low_{i}")).alias(f"reach_{i}") for i in (0, 1)))
        low = [F.min(f"reach_{i}").alias(f"low{i}") for i in (0, 1)]
    else:
        low = [F.sum(f"low_{i}").alias(f"low{i}") for i in (0, 1)]
    r = s.groupBy(*KEY).agg(F.sum("quotes").alias("quotes"), *(F.sum(f"move_{i}").alias(f"move{i}") for i in (0, 1)), *low, F.min_by("opens", "place").alias("opens"))
    file = Window.partitionBy("path").orderBy("start")
    earlier = file.rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("state", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).cast("int"))
    r = r.withColumn("move", F.when(F.col("state") == 0, F.col("move0")).otherwise(F.col("move1")))
    r = r.withColumn("low", F.when(F.col("state") == 0, F.col("low0")).otherwise(F.col("low1")))
    r = r.withColumn("depth", F.coalesce(F.sum("move").over(earlier), F.lit(0)))
    if kind == "json":
        inside = F.col("depth") >= 2
        owns = (F.col("depth") + F.col("move") >= 2) & (~inside | (F.col("depth") + F.col("low") <= 1))
    else:
        inside = F.col("state") == 1
        owns = ((F.col("state") + F.col("quotes")) % 2 == 1) & (~inside | (F.col("low") > 0))
    r = r.withColumn("inside", inside).withColumn("owns", owns)
    return r.withColumn("owner", F.last(F.when(F.col("owns"), F.col("start")), ignorenulls=True).over(earlier))


def _cuts(kind: str, buf: bytes, state: int, depth: int, open_: bool) -> tuple[list[int], list[int], int, int]:
    """Places where records begin and end in ``buf``, and the state and depth after it."""
    raw = np.frombuffer(buf, np.uint8)
    if kind == "json":
        at, quote, step = _json_marks(raw)
        step = step * ((state + np.cumsum(quote) - quote) % 2 == 0)
        d = depth + np.cumsum(step)
        begins, ends = at[(step == 1) & (d == 2)].tolist(), (at[(step == -1) & (d == 1)] + 1).tolist()
        depth = int(d[-1]) if len(d) else depth
    else:
        at, quote = _csv_marks(raw)
        ends = (at[(quote == 0) & ((state + np.cumsum(quote)) % 2 == 0)] + 1).tolist()
        begins = ([] if open_ else [0]) + [e for e in ends if e < len(buf)]
    return begins, ends, int(state + quote.sum()) % 2, depth


def _records(kind: str):
    separator = SEPARATOR[kind].encode()
    types = pa.schema([("path", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("no", pa.int64()),
                       ("whole", pa.bool_()), ("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            rows: list[tuple] = []
            for row, buf in _runs(batch, separator):
                here = {c: batch.column(c)[row].as_py() for c in batch.schema.names if c != "piece"}
                if here["state"] is None:
                    raise ValueError(f"the ranges of {here['path']} changed between the two passes; keep spark.sql.files.* as it is")
                if key != tuple(here[k] for k in KEY):
                    if key is not None and held:
                        rows.append((key[0], owner, key[1], no, False, b"".join(held)))
                    key, no, held = tuple(here[k] for k in KEY), 0, []
                    state, depth, open_ = here["state"], here["depth"], here["inside"]
                    owner = here["owner"] if open_ else key[1]
                    foreign = open_
                begins, ends, state, depth = _cuts(kind, buf, state, depth, open_)
                begin = 0 if open_ else None
                marks = sorted([(p, 1) for p in begins] + [(p, 0) for p in ends])
                for p, is_begin in marks:
                    if is_begin:
                        begin, open_ = p, True
                    elif open_:
                        part = b"".join([*held, buf[begin:p]])
                        rows.append((key[0], owner, key[1], no, not foreign, part))
                        held, open_, foreign, begin = [], False, False, None
                        owner, no = key[1], no + 1
                if open_:
                    held.append(buf[begin:])
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)
        if key is not None and held:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((key[0], owner, key[1], no, False, b"".join(held)), types)], schema=types)

    return run


def cut_records(spark: SparkSession, path: str, kind: str, most_broadcast: int = MOST_BROADCAST) -> tuple[DataFrame, DataFrame]:
    """(records(path, record, first), files(path, complete)) of the JSON arrays or CSV files at ``path``.

    A record is the text of one object (or array) of the top-level array, or one CSV record with its line end; ``first``
    marks the first of its file. ``complete``: the file is one array whose quotes and brackets close; of CSV, its quotes
    close. Values beside objects, and what stands between them, are not looked at. A file without a byte has no row; files may
    be empty of records.
    """
    pieces = _pieces(spark, path, kind)
    starts = cut_lineage(_starts(pieces, kind))
    told = starts.select(*KEY, "state", "depth", "inside", "owner")
    # pieces stay in order: below a broadcast join, or sorted by their place
    if starts.count() <= most_broadcast:
        given = pieces.join(F.broadcast(told), [*KEY], "left")
    else:
        given = pieces.join(told, [*KEY], "left").sortWithinPartitions(*KEY, "place")
    cut = given.mapInArrow(_records(kind), "path string, owner long, start long, no long, whole boolean, record binary")
    whole = cut.filter("whole").select("path", "record", ((F.col("start") == 0) & (F.col("no") == 0)).alias("first"))
    parts = cut.filter("not whole").groupBy("path", "owner").agg(
        F.array_sort(F.collect_list(F.struct("start", "no", "record"))).alias("parts"))
    joined = parts.select("path", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["record"])).alias("record"),
                          ((F.col("owner") == 0) & (F.col("parts")[0]["no"] == 0)).alias("first"))
    # the scan takes the separators away and _runs puts one after every piece; so a whole array, which ends with "]", has one "}" too many
    sums = starts.groupBy("path").agg(F.sum("quotes").alias("quotes"), F.sum("move").alias("move"), F.min_by("opens", "start").alias("opens"))
    complete = F.col("quotes") % 2 == 0
    if kind == "json":
        complete = complete & (F.col("move") == -1) & (F.col("opens") == F.lit(b"["))
    records = whole.unionByName(joined).select("path", F.decode("record", "UTF-8").alias("record"), "first")
    return records, sums.select("path", complete.alias("complete"))
