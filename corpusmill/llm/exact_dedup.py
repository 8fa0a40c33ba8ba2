"""Operator 8 (native): exact dedup by a tree-merge of sorted digest runs.

Each partition of the input is a run: its digests, sorted and reduced to one entry
each (the row that stays, the count, checks). In every round the runs of ``FAN``
neighbours exchange their entries, dealt out by digest, and are merged into one
run by a sort aggregate that again keeps one verified entry a digest. The last
round leaves a single run, spread over all tasks by digest. Hot groups shrink to one entry a run
in the first, map-side step.

Texts are equal when identical after lower-casing A-Z only; null counts as empty.
Equality is by SHA-256, verified in every merge by the text's length and a second,
independent 64-bit hash; a mismatch raises. Of equal texts the row with the largest
(or smallest) doc_id stays; of repeated rows with that doc_id, exactly one; a null
doc_id counts as the smallest. Texts are digested whole, whatever their length. An empty table gives an empty table.
Other columns are not read; ``drop_exact_duplicates`` returns them unchanged, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import discard, free_name, parted, stored

#: Runs that one merge takes in.
FAN = 16
#: The letters that are lower-cased.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal_text(text: Column) -> Column:
    """Lower-case A-Z only. For pure ASCII the faster lower() gives the same."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def digest_rows(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: doc_id, its run and place there, digest, length and check hash."""
    t = docs.select("doc_id", *extra, normal_text(F.col("text")).alias("__t"))
    return t.select(
        "doc_id", *extra,
        F.unhex(F.sha2(F.col("__t"), 256)).alias("digest"),
        F.octet_length("__t").cast("long").alias("n_bytes"),
        F.xxhash64("__t").alias("check"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
    )


def _merge(entries: DataFrame, *keys: str) -> DataFrame:
    """Merge entries of equal keys; the checks of a digest must all agree."""
    agree = (F.min("n_bytes") == F.max("n_bytes")) & (F.min("check") == F.max("check"))
    return entries.groupBy(*keys).agg(
        F.max("stays").alias("stays"),
        F.sum("n").alias("n"),
        F.min("n_bytes").alias("n_bytes"),
        F.when(agree, F.min("check")).otherwise(F.raise_error(F.lit("two texts with one digest"))).cast("long").alias("check"),
    )


def tree_merge(rows: DataFrame, fan: int = FAN, keep: str = "largest") -> DataFrame:
    """digest -> (stays: struct of order, doc_id and row; n), by rounds of merges of ``fan`` runs."""
    order = F.col("doc_id") if keep == "largest" else -F.col("doc_id")
    stays = F.struct(order.alias("o"), F.col("doc_id").alias("doc_id"), (-F.col("row")).alias("r"))
    runs = rows.agg(F.max("run")).first()[0]
    entries = _merge(rows.select("run", "digest", stays.alias("stays"), F.lit(1).cast("long").alias("n"), "n_bytes", "check"), "run", "digest")
    left = (runs or 0) + 1
    while True:
        left = -(-left // fan)
        if left == 1:
            return _merge(entries, "digest")
        entries = _merge(entries.withColumn("run", F.floor(F.col("run") / fan)), "run", "digest")


def exact_duplicates(docs: DataFrame, fan: int = FAN, keep: str = "largest") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = stored(digest_rows(docs), "op8-rows")
    # written, so that the join gets exchanges of its own, whose hot digests AQE can split
    merged = stored(tree_merge(rows, fan, keep), "op8-merged")
    out = rows.join(merged.select("digest", "stays", F.col("n").alias("group_size")), "digest")
    return out.select(
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        (-F.col("row") == F.col("stays.r")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, fan: int = FAN, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns unchanged.

    Dropped rows are found by doc_id and digest. Where a doc_id is repeated with the
    same text, the rows that share both are reduced to one.
    """
    rows = stored(digest_rows(docs.select("doc_id", "text")), "op8-rows")
    merged = stored(tree_merge(rows, fan, keep), "op8-merged")
    j = rows.join(merged.select("digest", F.col("stays.doc_id").alias("keep_id"), F.col("stays.r").alias("r")), "digest")
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    lost = stored(j.filter(-F.col("row") != F.col("r")).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__d"), same.alias("__twin")), "op8-lost")
    discard(rows, merged)
    if lost.isEmpty():
        return docs
    # texts whose doc_id surely lost no row go straight on; only the rest is joined
    maybe, rest = parted(docs, F.xxhash64("doc_id"), lost.select(F.xxhash64("__id").alias("key")))
    key, ids, own = (free_name(n, docs) for n in ("__digest", "__id", "__d"))
    keyed = maybe.withColumn(key, F.unhex(F.sha2(normal_text(F.col("text")), 256)))
    on = F.col("doc_id").eqNullSafe(F.col(ids)) & (F.col(key) == F.col(own))
    gone = lost.filter(~F.col("__twin")).select(F.col("__id").alias(ids), F.col("__d").alias(own)).distinct()
    kept = keyed.join(gone, on, "left_anti")
    twins = stored(lost.filter("__twin").select(F.col("__id").alias(ids), F.col("__d").alias(own)).distinct(), "op8-twins")
    if not twins.isEmpty():
        once = kept.join(twins, on, "left_semi").dropDuplicates(["doc_id", key])
        kept = kept.join(twins, on, "left_anti").unionByName(once)
    return rest.unionByName(kept.drop(key))
