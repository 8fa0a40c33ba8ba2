"""Ordered-sequence operators: dense ids, block splits, gaps, as-of lookups,
sorted merge and paired loads (W1-W8, P12, P13, J7-J9, O6, N2-N4).

Global order without a single-partition window: the frame is range-partitioned
on the order key, sorted inside each partition and checkpointed (so the counts
and the rows see the same partitioning); per-partition totals (at most one row
per partition) give each partition its offset. Only those <= p summary rows are
ever ordered globally.
"""
from __future__ import annotations

from typing import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.session import cut_lineage

_PID = "__pid"
_LOCAL = "__local"
_POS_BITS = 33  # monotonically_increasing_id keeps the position in the low 33 bits


def _order_cols(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def sorted_partitions(df: DataFrame, order: Sequence, parts: int | None = None) -> DataFrame:
    """Range-partition on ``order``, sort inside partitions and checkpoint.

    The returned frame carries ``__pid`` (partition index) and ``__local``
    (0-based position inside the partition); partition i holds keys before
    partition i+1.
    """
    cols = _order_cols(order)
    # without a fixed number AQE fits the partitions to the data
    ranged = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    ranged = cut_lineage(ranged.sortWithinPartitions(*cols))
    mid = F.monotonically_increasing_id()
    return ranged.withColumn(_PID, F.shiftright(mid, _POS_BITS)).withColumn(
        _LOCAL, mid.bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    )


def partition_offsets(counts: DataFrame, value: str, out: str = "__offset") -> DataFrame:
    """Exclusive running sum of ``value`` over the (<= p) partition summary rows."""
    w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("bigint"))


def dense_id(df: DataFrame, order: Sequence, out: str = "id", parts: int | None = None) -> DataFrame:
    """0-based sequential id in ``order`` (equal to ``row_number() - 1``).

    ``order`` must be a total order (add tie-breakers) for a deterministic result.
    """
    sp = sorted_partitions(df, order, parts)
    counts = sp.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    offs = partition_offsets(counts, "__n").select(_PID, "__offset")
    # offs has at most one row per partition: a proven size bound for broadcast.
    return (
        sp.join(F.broadcast(offs), _PID)
        .withColumn(out, (F.col("__offset") + F.col(_LOCAL)).cast("bigint"))
        .drop(_PID, _LOCAL, "__offset")
    )


# --------------------------------------------------------------------------- prefix sums
def _cumsum_partition(weight: str, out: str):
    def run(batches: Iterator) -> Iterator:
        carry = 0
        for pdf in batches:
            cs = pdf[weight].to_numpy(dtype=np.int64).cumsum() + carry
            if len(cs):
                carry = int(cs[-1])
            pdf[out] = cs
            yield pdf

    return run


def prefix_sum(df: DataFrame, order: Sequence, weight: str, out: str = "cum", parts: int | None = None) -> DataFrame:
    """Inclusive running sum of the integer column ``weight`` in global ``order``.

    Range partitions are checkpointed, each is summed locally (vectorised, batch
    by batch) and shifted by the total of earlier partitions.
    """
    sp = sorted_partitions(df, order, parts).drop(_LOCAL)
    schema = T.StructType(sp.schema.fields + [T.StructField(out, T.LongType())])
    local = sp.mapInPandas(_cumsum_partition(weight, out), schema)
    totals = sp.groupBy(_PID).agg(F.sum(weight).cast("bigint").alias("__w"))
    offs = partition_offsets(totals, "__w").select(_PID, "__offset")
    return (
        local.join(F.broadcast(offs), _PID)
        .withColumn(out, (F.col(out) + F.col("__offset")).cast("bigint"))
        .drop(_PID, "__offset")
    )


# --------------------------------------------------------------------------- J7 / J8
def asof_index(left: DataFrame, right: DataFrame, on: str, direction: str = "floor", out: str = "idx") -> DataFrame:
    """For each left row, the 0-based index into the sorted ``right[on]``:
    ``floor`` = last index with right <= x (-1 if none); ``ceil`` = first index with
    right >= x (null if none).

    Right values are pre-counted per distinct value and left values are
    de-duplicated before the global prefix count, so a hot value is one row.
    A left row with a null key stays, with a null index; null right keys count as no row.
    """
    right = right.filter(F.col(on).isNotNull())
    if direction not in ("floor", "ceil"):
        raise ValueError("direction must be 'floor' or 'ceil'")
    right_tag, left_tag = (0, 1) if direction == "floor" else (1, 0)
    rcounts = right.groupBy(F.col(on).alias("__v")).agg(F.count(F.lit(1)).alias("__w")).withColumn(
        "__tag", F.lit(right_tag))
    lvals = left.select(F.col(on).alias("__v")).distinct().withColumn("__w", F.lit(0).cast("bigint")).withColumn(
        "__tag", F.lit(left_tag))
    both = rcounts.unionByName(lvals)
    cum = prefix_sum(both, ["__v", "__tag"], "__w", "__cum").filter(F.col("__tag") == left_tag)
    if direction == "floor":
        idx = (F.col("__cum") - 1).cast("bigint")
    else:
        n_right = right.select(F.count(F.lit(1))).scalar()
        idx = F.when(F.col("__cum") < n_right, F.col("__cum")).cast("bigint")
    found = cum.select(F.col("__v").alias(on), idx.alias(out))
    return left.join(found, on, "left")


# --------------------------------------------------------------------------- O6 / W8 / P12 / P13
def merge_sorted(a: DataFrame, b: DataFrame, value: str = "v") -> DataFrame:
    """One sorted multiset from two sequences: (pos, v), duplicates kept.

    Equal values are ordered by a running id, so that a hot value is spread over several ranges."""
    both = a.select(F.col(value).alias("v")).unionAll(b.select(F.col(value).alias("v")))
    both = both.withColumn("__t", F.monotonically_increasing_id())
    return dense_id(both, ["v", "__t"], out="pos").select("pos", "v")


def block_of(pos: Column, n: Column, p: int) -> Column:
    """Block of 0-based position ``pos`` when n rows are split over p
    blocks and the first n % p blocks get one extra row (SQL ntile - 1)."""
    q = F.floor(n / F.lit(p)).cast("bigint")
    r = (n % F.lit(p)).cast("bigint")
    big = r * (q + 1)
    return F.when(pos < big, F.floor(pos / (q + 1))).otherwise(r + F.floor((pos - big) / q)).cast("bigint")


def block_split(df: DataFrame, order: Sequence, p: int, out: str = "block") -> DataFrame:
    """Balanced block split in ``order`` without a global window."""
    n = df.select(F.count(F.lit(1))).scalar()
    ided = dense_id(df, order, out="__pos")
    return ided.withColumn(out, block_of(F.col("__pos"), n, p)).drop("__pos")


def balanced_bucket(i: Column, n: Column, p: int) -> Column:
    """Pair row k with row n-k+1 so heavy and light rows share a bucket."""
    return (F.least(i, n + F.lit(1) - i) % F.lit(p)).cast("bigint")


# --------------------------------------------------------------------------- W1 / W2
def gap_per_key(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Gap to the previous value inside each key (window partitioned by key)."""
    w = Window.partitionBy(*by).orderBy(value)
    return df.withColumn("gap", F.col(value) - F.lag(value).over(w))


def max_gap(df: DataFrame, value: str, by: Sequence[str] | None = None, parts: int | None = None) -> DataFrame:
    """Largest gap between consecutive values in sorted order,
    with both witnesses (ties: leftmost), globally or per key. The gap of BIGINT values is DECIMAL(20,0), which holds
    any of them; other types keep their own.

    Values are first counted per distinct (key, value) (map-side combine, so a hot
    value is one row) and range-partitioned on (key, value); each sorted partition gives one
    summary row per key, and the <= p summaries of a key are stitched with a window. Output:
    keys..., gap, left, right (null gap for a single value, 0 for one repeated value). Null
    values count as no value; null keys are a key.
    """
    by = list(by or [])
    vt = T.DecimalType(20, 0) if isinstance(df.schema[value].dataType, T.LongType) else df.schema[value].dataType
    d = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__n"))
    sp = sorted_partitions(d, [*by, value], parts)

    def step(left: Column, right: Column) -> Column:
        return F.when(left.isNotNull(), F.struct((left.cast(vt) - right.cast(vt)).alias("ng"), left.alias("l"), right.alias("r")))

    inside = Window.partitionBy(_PID, *by).orderBy(value)
    steps = sp.withColumn("__b", step(F.lag(value).over(inside), F.col(value)))
    summ = steps.groupBy(_PID, *by).agg(
        F.min("__b").alias("__b"), F.min(value).alias("first"), F.max(value).alias("last"), F.sum("__n").alias("n"))
    w = Window.partitionBy(*by).orderBy(_PID) if by else Window.partitionBy(F.lit(0)).orderBy(_PID)
    per_row = summ.select(*by, "first", "n", F.least("__b", step(F.lag("last").over(w), F.col("first"))).alias("b"))
    agg = per_row.groupBy(*by).agg(F.min("b").alias("b"), F.min("first").alias("first"), F.sum("n").alias("rows"))
    single_dup = F.col("b").isNull() & (F.col("rows") >= 2)
    return agg.select(
        *by,
        F.when(single_dup, F.lit(0).cast(vt)).otherwise(F.negative("b.ng")).cast(vt).alias("gap"),
        F.when(single_dup, F.col("first")).otherwise(F.col("b.l")).alias("left"),
        F.when(single_dup, F.col("first")).otherwise(F.col("b.r")).alias("right"),
    )


# --------------------------------------------------------------------------- N4 / P13 on table columns
def distinct_products(df: DataFrame, a: str, b: str) -> DataFrame:
    """N4/J9/A11/U5 on columns: rows and distinct products of two columns, by a partial distinct before the count."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(a) * F.col(b)).alias("distinct_products"))


def balanced_load(df: DataFrame, order: Sequence, weight: str, p: int) -> DataFrame:
    """Rows in ``order`` paired heavy with light over p buckets: (bucket, n_rows, load)."""
    n = df.select(F.count(F.lit(1))).scalar()
    ided = dense_id(df, order, out="__pos")
    return ided.groupBy(balanced_bucket(F.col("__pos") + 1, n, p).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(weight).cast("bigint").alias("load"))
