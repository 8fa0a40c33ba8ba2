"""Feature and sampling operators (P2, P3, P4, P14, F1-F4, M1-M3, M13 folds).

Random choices are hash-based (md5 of seed and key), so they are reproducible,
independent of partitioning and re-checkable in SQL. Per-class positions come
from the range-partitioned dense id (W8), never from a global window.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from corpusmill.functions import text as X
from corpusmill.operators.ordered import block_of, dense_id
from corpusmill.operators.text import STOP_WORDS_EN
from corpusmill.session import discard, small_side, stored

#: Terms that ``tfidf_raw`` sends to all tasks at once when it looks up packed terms (16 bytes each).
LOOKUP = 1 << 22
#: Documents whose words are counted at a time.
SLICE = 2048


def seeded_hash(seed: int, *cols) -> Column:
    """32-bit hash of (seed, cols...) from md5 (same value in any SQL engine)."""
    parts = [F.lit(str(seed))]
    for c in cols:
        parts += [F.lit(":"), (F.col(c) if isinstance(c, str) else c).cast("string")]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("bigint")


def drop_all_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P2 (Q14): drop rows whose feature columns (all of them, null as 0) sum to zero."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(F.col(c), F.lit(0))
    return df.filter(total != 0)


def cast_cols(df: DataFrame, cols: Sequence[str], to: str = "int") -> DataFrame:
    """Cast the given columns."""
    return df.select(*[F.col(c).cast(to).alias(c) if c in cols else F.col(c) for c in df.columns])


def fill_blank(df: DataFrame) -> DataFrame:
    """Null strings become '' (numeric columns: cast to string first if wanted)."""
    return df.na.fill("")


def split_by(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where ``pred`` holds and rows where it does not (nulls count as not)."""
    p = F.coalesce(pred, F.lit(False))
    return df.filter(p), df.filter(~p)


def split(df: DataFrame, key: str, frac: float = 0.8, seed: int = 42, out: str = "is_train") -> DataFrame:
    """Deterministic train/test split: hash bucket of (seed, key) in [0, 1000) < frac * 1000."""
    return df.withColumn(out, (seeded_hash(seed, key) % 1000) < int(round(frac * 1000)))


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """sorted-order code from 0 (dense rank - 1) via a dense id over the distinct values; null comes first.

    Few codes are broadcast, so the rows are not shuffled on a handful of values."""
    out = out or f"{col}_code"
    codes = dense_id(df.select(F.col(col).alias("__v")).distinct(), ["__v"], out=out)
    return df.join(small_side(codes), F.col(col).eqNullSafe(F.col("__v"))).drop("__v")


def one_hot(df: DataFrame, col: str, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per sorted distinct value. The domain becomes the schema, so it reaches the
    driver; ``one_hot_long`` has the same content as rows, for domains of any size."""
    prefix = prefix or col
    values = sorted(r[0] for r in df.select(col).distinct().collect() if r[0] is not None)
    return df.withColumns({f"{prefix}_{v}": (F.col(col) == F.lit(v)).cast("int") for v in values})


def one_hot_long(df: DataFrame, key: str, col: str) -> DataFrame:
    """F2 without a limit: the ones of the 0/1 matrix as rows (key, value, hot = 1); a null value has none."""
    return df.filter(F.col(col).isNotNull()).select(key, F.col(col).alias("value"), F.lit(1).alias("hot"))


def class_positions(df: DataFrame, label: str, order: Sequence, out: str = "pos") -> DataFrame:
    """0-based position of each row inside its class in ``order``, plus the class size
    ``n_class``. Global dense id over (label, order) minus the class start."""
    ided = dense_id(df, [label, *order], out="__gid")
    starts = ided.groupBy(F.col(label).alias("__l")).agg(F.min("__gid").alias("__start"), F.count(F.lit(1)).alias("n_class"))
    j = ided.join(small_side(starts), F.col(label).eqNullSafe(F.col("__l")))
    return j.withColumn(out, F.col("__gid") - F.col("__start")).drop("__gid", "__start", "__l")


def undersample(df: DataFrame, label: str, key: str, seed: int = 42) -> DataFrame:
    """every class cut to the smallest class size m, without replacement: the m
    rows with the smallest (hash(seed, key), key) in each class."""
    h = df.withColumn("__h", seeded_hash(seed, key))
    pos = class_positions(h, label, ["__h", key])
    m = pos.select(F.min("n_class")).scalar()
    return pos.filter(F.col("pos") < m).drop("__h", "pos", "n_class")


def oversample(df: DataFrame, label: str, key: str, seed: int = 42, chunk: int = 4096) -> DataFrame:
    """every class grown to the largest class size M with replacement; originals
    kept. Deficit slots are generated in chunks spread over tasks; slot s of class c
    draws position hash(seed, c, s) mod n_c, resolved by an equi join."""
    pos = class_positions(df, label, [key])
    sizes = pos.groupBy(label).agg(F.first("n_class").alias("n_class"))
    m = sizes.select(F.max("n_class")).scalar()
    need = sizes.withColumn("deficit", m - F.col("n_class")).filter(F.col("deficit") > 0)
    starts = need.select(label, "n_class", "deficit",
                         F.explode(F.sequence(F.lit(0), F.col("deficit") - 1, F.lit(chunk))).alias("s0"))
    slots = starts.repartition(label, "s0").select(
        label, "n_class", F.explode(F.sequence(F.col("s0"), F.least(F.col("deficit") - 1, F.col("s0") + chunk - 1))).alias(
            "slot"))
    draws = slots.select(label, (seeded_hash(seed, label, "slot") % F.col("n_class")).alias("pos"))
    pos = pos.drop("n_class").withColumnRenamed("pos", "__p")
    d = draws.select(F.col(label).alias("__l"), "pos")
    picked = d.join(pos, F.col(label).eqNullSafe(F.col("__l")) & (F.col("pos") == F.col("__p")))
    return df.unionByName(picked.select(*df.columns))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Stratified, unshuffled k folds: inside each class (ordered by key) the
    rows are cut into k consecutive blocks, the first n_c % k one row larger."""
    pos = class_positions(df, label, [key])
    return pos.withColumn(out, block_of(F.col("pos"), F.col("n_class"), k)).drop("pos", "n_class")


# --------------------------------------------------------------------------- M1 / M2
def term_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", stops=STOP_WORDS_EN,
                accents: bool = True, packed: bool = False) -> DataFrame:
    """M1: long-form term counts (key, term, n): lower-case, accents stripped,
    vectoriser tokens, stop words removed (a short list, tested in place: a join would exchange every token).
    Texts are dealt out by key, so that a document's tokens are counted where they are made.

    ``packed``: the same counts as one row per key with arrays ``term`` and ``n``, stored; no text and no count is exchanged, but
    those of repeated keys (the counts of a repeated null key are several rows of different terms)."""
    t = X.strip_accents(F.col(text)) if accents else F.col(text)
    if packed:
        return _packed_counts(docs.select(key, F.coalesce(X.vec_tokens(t), F.array().cast("array<string>")).alias("term")), key, stops)
    toks = docs.select(key, F.col(text)).repartition(key).select(key, F.explode_outer(X.vec_tokens(t)).alias("term")).filter(F.col("term").isNotNull())
    words = sorted({w for w in stops if w is not None})
    if words:
        toks = toks.filter(~F.col("term").isin(words))
    return toks.groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a list column without nulls."""
    off = column.offsets.to_numpy().astype(np.int64)
    return off - off[0], column.flatten().to_numpy(zero_copy_only=False)


def _packed_counts(rows: DataFrame, key: str, stops) -> DataFrame:
    """``term_counts`` of rows (key, term: tokens) as rows (key, term, n), stored."""
    words = sorted({w for w in stops if w is not None})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, SLICE):
                batch = whole.slice(i, SLICE)
                column = batch.column("term")
                off = column.offsets.to_numpy().astype(np.int64)
                coded = column.flatten().dictionary_encode()
                names, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
                row = np.repeat(np.arange(batch.num_rows), np.diff(off))
                if words and len(names):
                    keep = ~pc.is_in(names, value_set=pa.array(words, names.type)).to_numpy(zero_copy_only=False)[codes]
                    row, codes = row[keep], codes[keep]
                cell, n = np.unique(row * max(1, len(names)) + codes, return_counts=True)
                row, codes = np.divmod(cell, max(1, len(names)))
                sizes = np.bincount(row, minlength=batch.num_rows)
                some = np.flatnonzero(sizes)
                ends = pa.array(np.concatenate([[0], np.cumsum(sizes[some])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, x) for x in (names.take(pa.array(codes)), pa.array(n.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(some)), *lists], names=[key, "term", "n"])

    kind = rows.schema[key].dataType.simpleString()
    rows = stored(rows.mapInArrow(run, f"`{key}` {kind}, term array<string>, n array<bigint>"), "counts")
    again = rows.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__key")
    again = small_side(again)
    if again.isEmpty():
        return rows
    same = F.col(key).eqNullSafe(F.col("__key"))
    each = rows.join(again, same, "left_semi").select(key, F.inline(F.arrays_zip("term", "n"))).groupBy(key, "term").agg(F.sum("n").alias("n"))
    # a null key has the words of any number of documents
    part = F.when(F.col(key).isNull(), F.pmod(F.xxhash64("term"), F.lit(4096))).otherwise(F.lit(0).cast("long"))
    each = each.groupBy(key, part.alias("__part")).agg(F.collect_list(F.struct("term", "n")).alias("__r"))
    whole = rows.join(again, same, "left_anti").unionByName(each.select(key, F.col("__r.term").alias("term"), F.col("__r.n").alias("n")))
    out = stored(whole, "merged-counts")
    discard(rows)
    return out


def _packed_tfidf(counts: DataFrame, key: str, train: str | None = None) -> DataFrame:
    """``tfidf_raw`` of packed counts. Terms are found by a hash that is known to tell all of them apart, in tables of ``LOOKUP``
    terms at most; so no count is exchanged, and terms of one document need no table.

    ``train``: a column of how many times a row counts for N and df; terms without any are left out, rows are brought to unit length
    and terms are named by ``xxhash64``."""
    spark = counts.sparkSession
    counts = counts if train or getattr(counts, "stored_path", None) else stored(counts, "counts")  # read for N, for df and for the weights
    fitted = F.coalesce(F.col(train).cast("bigint"), F.lit(0)) if train else F.lit(1).cast("bigint")
    n_docs = counts.filter(fitted > 0).select(F.count_distinct(key)).first()[0]
    each = counts.select(F.explode("term").alias("term"), fitted.alias("fitted"))
    terms = stored(each.groupBy("term").agg(F.count(F.lit(1)).alias("seen"), F.sum("fitted").alias("df")), "terms")
    seed = 0
    while not terms.groupBy(F.xxhash64("term", F.lit(seed)).alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        seed += 1
    # a term that is in no table has its one document's number as df
    shared = dense_id(terms.filter("seen > 1 and df > 0"), ["df", "term"], out="id").select(F.xxhash64("term", F.lit(seed)).alias("h"), "id", "df")
    shared = stored(shared, "shared-terms")
    discard(terms)
    kind = counts.schema[key].dataType.simpleString()

    def step(rows: DataFrame, sent, first: bool, last: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            least, hashes, ids, dfs = sent.value
            for whole in batches:
                for i in range(0, whole.num_rows, SLICE):
                    batch = whole.slice(i, SLICE)
                    off, h = _lists(batch.column("h"))
                    at, df = (np.full(len(h), -1), np.repeat(batch.column("fitted").to_numpy(), np.diff(off))) if first else (_lists(batch.column(c))[1].copy() for c in ("id", "df"))
                    if len(hashes):
                        place = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
                        hit = hashes[place] == h
                        at[hit], df[hit] = ids[place[hit]].astype(np.int64) + least, dfs[place[hit]]
                    ends = pa.array(off.astype(np.int32))
                    if last:
                        w = _lists(batch.column("n"))[1] * (np.log((1.0 + n_docs) / (1.0 + df)) + 1.0)
                        if train:
                            keep, row = df > 0, np.repeat(np.arange(batch.num_rows), np.diff(off))
                            at, w, row = _lists(batch.column("name"))[1][keep], w[keep], row[keep]
                            w = w / np.sqrt(np.bincount(row, w * w, batch.num_rows))[row]
                            ends = pa.array(np.searchsorted(row, np.arange(len(off))).astype(np.int32))
                        cols = {key: batch.column(key), "term": pa.ListArray.from_arrays(ends, pa.array(at)), "weight": pa.ListArray.from_arrays(ends, pa.array(w))}
                    else:
                        cols = {c: batch.column(c) for c in (key, "fitted", "term", "n")} | {c: pa.ListArray.from_arrays(ends, pa.array(x)) for c, x in (("id", at), ("df", df))}
                    yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

        h = F.transform("term", lambda x: F.xxhash64(x, F.lit(seed))).alias("h")
        name = [F.transform("term", lambda x: F.xxhash64(x)).alias("name")] if train and last else []
        rows = rows.select(key, fitted.alias("fitted") if first else "fitted", h, "n", *([] if first else ["id", "df"]), *(name if last else ["term"]))
        more = "term array<bigint>, weight array<double>" if last else "fitted bigint, term array<string>, n array<bigint>, id array<bigint>, df array<bigint>"
        return rows.mapInArrow(run, f"`{key}` {kind}, {more}")

    rounds = max(1, -(-shared.count() // LOOKUP))
    rows = counts
    for r in range(rounds):
        table = shared.filter(F.col("id").between(r * LOOKUP, (r + 1) * LOOKUP - 1)).toArrow()  # of bounded size
        order = np.argsort(table["h"].to_numpy())
        sent = spark.sparkContext.broadcast((r * LOOKUP, table["h"].to_numpy()[order], *(x[order].astype(np.uint32) for x in (table["id"].to_numpy() - r * LOOKUP, table["df"].to_numpy()))))
        del table, order
        out = step(rows, sent, r == 0, r == rounds - 1)
        if r < rounds - 1:
            out = stored(out, "looked-up")
            if r:
                discard(rows)
            sent.destroy()
        rows = out
    discard(shared)
    return out


def tfidf_raw(counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """M2: smooth TF-IDF tf * (ln((1 + N) / (1 + df)) + 1), not yet normalised: (key, term, weight).
    Packed counts give one row per key with arrays ``term`` and ``weight``; a term is then its place in the order by (df, term)
    among those of several documents, from 0, and -1 if no other document has it.

    MLlib's IDF lacks the +1 term, so it is written out here."""
    if isinstance(counts.schema["term"].dataType, ArrayType):
        return _packed_tfidf(counts, key)
    counts = stored(counts, "counts")  # counted once, read for N, for df and for the weights
    n_docs = counts.select(F.count_distinct(key)).scalar()
    df_ = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.join(df_, "term").select(
        key, "term", (F.col("n") * (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1)).alias("weight"))


def tfidf(counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """M2/M3: ``tfidf_raw``, then L2 per document. Long form (key, term, weight)."""
    return _unit_rows(tfidf_raw(counts, key), key)


def _unit_rows(w: DataFrame, key: str) -> DataFrame:
    """Rows (key, term, weight) brought to unit length per key; one exchange of the rows, a document's at most in a group."""
    rows = w.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.collect_list(F.struct("term", "weight")).alias("__r"), F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("__norm"))
    return rows.select(key, "__norm", F.inline("__r")).select(key, "term", (F.col("weight") / F.col("__norm")).alias("weight"))


def tfidf_fitted(counts: DataFrame, train: DataFrame | str, key: str = "doc_id") -> DataFrame:
    """M2/M3 for scoring: rows of ``counts`` weighed by the document frequencies of the training counts ``train`` and brought to
    unit length; terms that no training document holds are left out, as a fitted vectoriser leaves them out.
    Packed counts name their training rows by a column ``train``, how many times each counts; the weights are packed then, terms named by ``xxhash64``."""
    if isinstance(train, str):
        return _packed_tfidf(counts, key, train)
    train = stored(train, "train-counts")
    n_docs = train.select(F.count_distinct(key)).scalar()
    df_ = train.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = counts.join(df_, "term").select(
        key, "term", (F.col("n") * (F.log((F.lit(1) + n_docs) / (F.lit(1) + F.col("df"))) + 1)).alias("weight"))
    return _unit_rows(w, key)
