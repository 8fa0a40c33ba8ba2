"""Operator 11: substring dedup by super-k-mer partitioning.

Words ``[^\\x20\\x09-\\x0D]+`` of a text, unchanged; a window is ``WINDOW`` consecutive words. The minimiser of a
window is its run of ``GRAM`` words with the smallest hash, the leftmost of equals, so equal windows
have equal minimisers. Consecutive windows whose minimiser stands at the same place travel as one
super-k-mer: the packed string of their words, joined by one space, with where it came from. The minimiser is
the bucket. There equal strings, whose windows all repeat, become one, the windows of a bucket's different strings are sorted, and those
that have an equal neighbour repeat. Two windows of one super-k-mer never are equal (their minimisers stand at
different offsets), so a lone string repeats nothing. What a string repeats returns to the texts by its 128-bit digest.

What does not need to travel stays: minimisers are counted first (8 bytes each), and a bitmap of
fixed size (2 ** FILTER bits) tells which occur twice or more; a window whose minimiser occurs once cannot repeat.
A full bitmap lets everything pass, the result stays the same.

Hot buckets. Minimisers of more than ``max(HOT, total / 2**20)`` super-k-mers - 2 ** 20 at most, so they can be
broadcast - go another way: equal strings are counted with partial aggregates, and the windows of different
strings travel one by one, as 128-bit digests dealt out by the digest. So no task holds more of one bucket than that, and a
passage that a third of all documents share is spread over all tasks. Nothing is capped.

What returns are covered word ranges (doc_id, hash of the text, from, to). Texts are
shuffled only for documents that a second bitmap of fixed size cannot rule out.

Defined results: null text counts as empty: no words, the digest of the empty string; rows of equal (doc_id, text), null doc_id included,
repeat each other's windows and lose the same words; texts of fewer words than a window keep all; words
longer than ``LONG`` bytes are compared by SHA-256; texts are used whole, whatever their length; empty tables give
empty results; columns other than doc_id and text are not read, whatever their names (``drop_passages`` returns them unchanged).
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import bitmap, discard, flagged, free_name, map_slices, stored, strings
from corpusmill.llm.shingles import mix

WINDOW = 35
#: Words of a minimiser.
GRAM = 8
#: Super-k-mers of a minimiser from which on its windows travel one by one, and how many such minimisers there can be.
HOT, MOST_HOT = 1 << 14, 1 << 20
#: Longer words are packed as a digest of fixed size.
LONG = 96
#: Windows sorted at once: rows of a bucket are never parted, so more if a bucket has more.
SORTED = 1 << 16
#: Bytes of words that are hashed at once.
STEP = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.Generator(np.random.PCG64(50_021))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_SPACE] = 0
_PLACE = _RNG.integers(1, 1 << 63, 2 * WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, dtype=np.uint64))


class Words:
    """The words of a slice of texts: ``data`` holds them joined by single spaces, each text followed by one."""

    def __init__(self, texts: pa.Array):
        wide = texts.cast(pa.large_binary())
        off = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
        raw = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
        # a space after each text parts it from the next one
        raw, off = np.insert(raw, off[1:] - off[0], 0x20), off - off[0] + np.arange(len(off))
        space = _SPACE[raw]
        before = np.ones(len(raw), bool)
        before[1:] = space[:-1]
        begin = np.flatnonzero(before & ~space)
        last = space & ~before
        lengths = np.flatnonzero(last) - begin
        #: words i of text t: first[t] <= i < first[t + 1]
        self.first = np.searchsorted(begin, off)
        keep = last | ~space
        self.data = raw[keep]
        self.data[space[keep]] = 0x20
        self.starts = np.cumsum(lengths + 1) - lengths - 1
        self.ends = self.starts + lengths

    def hashes(self) -> np.ndarray:
        out = np.zeros(len(self.starts), np.uint64)
        edge = np.append(self.starts, len(self.data))
        for i, j in word_steps(self.starts, len(self.data)):
            at = edge[i:j]
            place = np.arange(edge[i], edge[j]) - np.repeat(at, np.diff(edge[i : j + 1]))
            out[i:j] = np.add.reduceat(_BYTE[self.data[edge[i] : edge[j]]] * _POWER[place & 0xFFFF], at - edge[i])
        return mix(out)


def word_steps(starts: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges (i, j) of words that together hold about ``STEP`` bytes, one word at least."""
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + STEP)))
        yield i, j
        i = j


def _runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words."""
    n = len(hashes) - width + 1
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h += hashes[j : j + n] * _PLACE[j]
    return mix(h)


def minimisers(grams: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` consecutive values, the place of the smallest, the leftmost of equals."""
    n = len(grams) - width + 1
    place = np.arange(len(grams))
    size = 1
    while size < width:  # place[i]: of the smallest among size values from i on; doubled, the last step overlaps
        step = min(size, width - size)
        a, b = place[: len(place) - step], place[step:]
        place = np.where(grams[b] < grams[a], b, a)
        size += step
    return place[:n]


def super_kmers(words: Words, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, windows, minimiser) of every super-k-mer; the first word counts over the whole slice."""
    none = np.zeros(0, np.int64)
    n = len(words.starts)
    if n < window:
        return none, none, none, np.zeros(0, np.uint64)
    grams = _runs(words.hashes(), gram)
    place = minimisers(grams, window - gram + 1)
    text = np.searchsorted(words.first, np.arange(len(place)), side="right") - 1
    inside = np.arange(len(place)) + window <= words.first[text + 1]
    new = inside.copy()
    new[1:] &= (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    # windows that cross the end of a text belong to none
    count = np.add.reduceat(inside.astype(np.int64), head) if len(head) else none
    return text[head], head, count, grams[place[head]]


def _packed(words: Words, first: np.ndarray, last: np.ndarray) -> list[bytes]:
    """The words first..last of each pair as one string; long words as digests."""
    data = words.data.tobytes()
    out = [data[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[last].tolist())]
    long = np.flatnonzero(words.ends - words.starts > LONG)
    if len(long):
        for i in np.flatnonzero(np.searchsorted(long, first) < np.searchsorted(long, last, side="right")).tolist():
            # \x0b never is part of a word, so a stand-in is no word
            out[i] = b" ".join(w if len(w) <= LONG else b"\x0b" + hashlib.sha256(w).hexdigest().encode() for w in out[i].split(b" "))
    return out


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("h", _text_hash())


def cut(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(m, doc_id, h, at, s): every super-k-mer with its minimiser, where it begins in its text, and its packed words."""

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            words = Words(strings(part, "text"))
            text, head, count, m = super_kmers(words, window, gram)
            s = _packed(words, head, head + count + window - 2)
            rows = part.select(["doc_id", "h"]).take(pa.array(text))
            return pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), *rows.columns, pa.array((head - words.first[text]).astype(np.int32)), pa.array(s, pa.binary())], names=["m", "doc_id", "h", "at", "s"])

        return one

    return map_slices(_source(docs), "text", make, "m long, doc_id long, h long, at int, s binary")


def minimiser_counts(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(m, n): how many super-k-mers each minimiser has."""

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            m, n = np.unique(super_kmers(Words(strings(part, "text")), window, gram)[3], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(m.view(np.int64)), pa.array(n)], names=["m", "n"])

        return one

    return map_slices(docs.select(F.col("text").cast("string").alias("text")), "text", make, "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))


def _boundaries(cells: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of packed strings: all bytes, where each word begins and ends in them, which string it is of, and each string's first word."""
    wide = cells.cast(pa.large_binary())
    off = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    gap = np.flatnonzero(data == 0x20)
    starts = np.sort(np.concatenate([off[:-1], gap + 1]))
    ends = np.sort(np.concatenate([off[1:], gap]))
    first = np.searchsorted(starts, off[:-1])
    row = np.searchsorted(off, starts, side="right") - 1
    return data.tobytes(), starts, ends, row, first


def repeated_windows(cells: pa.Array, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(string, offset) of the windows that occur twice or more in the strings: found by sorting all windows."""
    data, starts, ends, row, first = _boundaries(cells)
    head = np.flatnonzero(np.append(row, -1)[np.minimum(np.arange(len(row)) + window - 1, len(row))] == row) if len(row) >= window else np.zeros(0, np.int64)
    every = pa.array([data[a:b] for a, b in zip(starts[head].tolist(), ends[head + window - 1].tolist())], pa.large_binary())
    order = pc.array_sort_indices(every)
    ranked = every.take(order)
    same = pc.equal(ranked[1:], ranked[:-1]).to_numpy(zero_copy_only=False) if len(every) > 1 else np.zeros(0, bool)
    twice = np.zeros(len(every), bool)
    twice[1:] |= same
    twice[:-1] |= same
    head = np.sort(head[order.to_numpy()[twice]])
    return row[head], head - first[row[head]]


def _ranges(row: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) of the words that the windows cover, from sorted (row, offset)."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head, len(row))[1:] - 1
    return row[head], at[head], at[tail] + window


def _buckets(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Sorted rows, cut so that no bucket is parted and a batch has about ``rows`` rows."""
    held: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if held.num_rows < rows:
            continue
        m = held["m"].to_numpy()
        whole = int(np.searchsorted(m, m[-1]))
        if whole:
            yield from held.slice(0, whole).combine_chunks().to_batches()
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield from held.combine_chunks().to_batches()


_RANGES = "array<struct<a:int,b:int>>"


def in_buckets(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(d, ranges): what each string repeats, from super-k-mers (m, d, s) dealt out and sorted by minimiser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _buckets(batches, SORTED // 16):
            codes = batch.column("s").dictionary_encode()
            code, first = np.unique(codes.indices.to_numpy(), return_index=True)
            n = np.bincount(codes.indices.to_numpy())
            m = batch.column("m").to_numpy()[first]
            company = np.zeros(len(m), bool)
            company[1:] |= m[1:] == m[:-1]
            company[:-1] |= m[1:] == m[:-1]
            lone = code[company]
            row, a, b = _ranges(*repeated_windows(codes.dictionary.take(pa.array(lone)), window), window)
            row, single = lone[row], n[lone[row]] == 1
            whole = np.flatnonzero(n > 1)
            words = pc.add(pc.count_substring(codes.dictionary.take(pa.array(whole)), " "), 1).to_numpy()
            row, a, b = np.concatenate([row[single], whole]), np.concatenate([a[single], 0 * whole]), np.concatenate([b[single], words])
            order = np.argsort(row, kind="stable")
            row, start = np.unique(row[order], return_index=True)
            cells = pa.StructArray.from_arrays([pa.array(x[order].astype(np.int32)) for x in (a, b)], names=["a", "b"])
            lists = pa.ListArray.from_arrays(np.append(start, len(order)).astype(np.int32), cells)
            yield pa.RecordBatch.from_arrays([batch.column("d").take(pa.array(first[row])), lists], names=["d", "ranges"])

    dealt = parts.select("m", "d", "s").repartition(F.col("m")).sortWithinPartitions("m")
    return dealt.mapInArrow(run, f"d binary, ranges {_RANGES}")


def one_by_one(parts: DataFrame, window: int = WINDOW) -> DataFrame:
    """As ``in_buckets``, for buckets of any size: strings are counted first, then each window of the different ones is a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                data, starts, ends, row, first = _boundaries(batch.column("s"))
                head = np.flatnonzero(np.append(row, -1)[np.minimum(np.arange(len(row)) + window - 1, len(row))] == row)
                digests = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(starts[head].tolist(), ends[head + window - 1].tolist())]
                row = row[head]
                of = batch.select(["d", "n"]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), *of.columns, pa.array((head - first[row]).astype(np.int32))], names=["w", "d", "n", "a"])

    strings_ = stored(parts.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.first("s").alias("s")), "op11-strings")
    each = strings_.select("d", "n", "s").mapInArrow(run, "w binary, d binary, n long, a int")
    twice = each.groupBy("w").agg(F.sum("n").alias("n")).filter("n > 1").select("w")
    some = each.filter("n = 1").join(twice, "w").groupBy("d").agg(F.collect_list("a").alias("l"))  # the windows of one string
    some = some.select("d", F.transform("l", lambda a: F.struct(a.alias("a"), (a + window).cast("int").alias("b"))).cast(_RANGES).alias("ranges"))
    words = F.size(F.split(F.col("s").cast("string"), " "))
    every = strings_.filter("n > 1").select("d", F.array(F.struct(F.lit(0).alias("a"), words.alias("b"))).cast(_RANGES).alias("ranges"))
    return some.unionByName(every)


def covered(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc_id, h, ranges): the word ranges of each text that repeated windows cover; only texts that have some."""
    counts = stored(minimiser_counts(docs, window, gram).filter("n > 1"), "op11-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    many = max(hot, total // MOST_HOT)
    parts = flagged(cut(docs, window, gram), F.col("m"), bitmap(counts.select(F.col("m").alias("key")))).filter("__hit").drop("__hit")
    heavy = counts.filter(F.col("n") > many).select("m", F.lit(True).alias("heavy"))  # total / many rows at most
    parts = stored(parts.withColumn("d", F.unhex(F.md5("s"))).join(F.broadcast(heavy), "m", "left"), "op11-parts")
    found = in_buckets(parts.filter("heavy is null"), window)
    if not heavy.isEmpty():
        found = found.unionByName(one_by_one(parts.filter("heavy"), window))
    back = parts.select("d", "doc_id", "h", "at").join(found, "d").select("doc_id", "h", "at", F.explode("ranges").alias("r"))
    back = back.select("doc_id", "h", (F.col("at") + F.col("r.a")).alias("a"), (F.col("at") + F.col("r.b")).alias("b")).distinct()
    out = stored(back.groupBy("doc_id", "h").agg(F.collect_list(F.struct("a", "b")).alias("ranges")), "op11-ranges")  # of one text
    discard(counts, parts)
    return out


def _with_ranges(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows (doc_id, h, ...) with their ranges: texts surely without any go straight on, only the rest is shuffled."""
    key = F.xxhash64("doc_id", "h")
    marked = flagged(rows, key, bitmap(ranges.select(key.alias("key"))))
    named = ranges.select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "ranges")
    some = marked.filter("__hit").join(named, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h")), "left").drop("__id", "__h")
    none = marked.filter("not __hit").withColumn("ranges", F.lit(None).cast(_RANGES))
    return some.unionByName(none).drop("__hit")


def _kept(words: Words, ranges: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(which words stay, how many go in each text)."""
    step = np.zeros(len(words.starts) + 1, np.int64)
    lists = ranges.fill_null([]) if ranges.null_count else ranges
    cells = lists.flatten()
    base = np.repeat(words.first[:-1], pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    np.add.at(step, base + cells.field("a").to_numpy(zero_copy_only=False), 1)
    np.add.at(step, base + cells.field("b").to_numpy(zero_copy_only=False), -1)
    stays = np.cumsum(step[:-1]) == 0
    gone = np.concatenate([[0], np.cumsum(~stays)])
    return stays, np.diff(gone[words.first])


def _kept_texts(words: Words, stays: np.ndarray) -> list[bytes]:
    data, out = words.data, []
    keep = np.repeat(stays, words.ends - words.starts + 1)
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if a == b:
            out.append(b"")
            continue
        lo, hi = int(words.starts[a]), int(words.ends[b - 1]) + 1
        mine = keep[lo:hi]
        out.append((data[lo:hi] if mine.all() else data[lo:hi][mine]).tobytes()[:-1])
    return out


def _finished(rows: DataFrame, result: Callable, schema: str) -> DataFrame:
    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            words = Words(strings(part, "text"))
            stays, gone = _kept(words, part.column("ranges"))
            return result(part, words, stays, gone)

        return one

    return map_slices(rows, "text", make, schema)


def repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256."""

    def result(part: pa.RecordBatch, words: Words, stays: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        digests = [hashlib.sha256(t).hexdigest() for t in _kept_texts(words, stays)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(words.first)), pa.array(gone), pa.array(digests)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = _with_ranges(_source(docs), covered(docs, window, gram, hot))
    return _finished(rows, result, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def drop_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``docs`` with the words of repeated windows cut out of ``text``; texts that lose none, and other columns, unchanged."""
    ranges = covered(docs, window, gram, hot)

    def result(part: pa.RecordBatch, words: Words, stays: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
        texts = pa.array(_kept_texts(words, stays), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), texts], names=["doc_id", "h", "kept"]).filter(pa.array(gone > 0))

    cut_texts = _finished(_with_ranges(_source(docs), ranges).filter("ranges is not null"), result, "doc_id long, h long, kept string").dropDuplicates(["doc_id", "h"])
    new = cut_texts.select(F.struct(F.col("doc_id").alias("id"), "h", "kept").alias("__new"))
    name = free_name("__new", docs)
    new = new.withColumnRenamed("__new", name)
    j = docs.join(new, F.col("doc_id").cast("long").eqNullSafe(F.col(f"{name}.id")) & (_text_hash() == F.col(f"{name}.h")), "left")
    return j.select(*(F.coalesce(F.col(f"{name}.kept"), F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))
