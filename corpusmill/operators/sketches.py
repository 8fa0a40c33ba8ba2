"""Stored summaries that merge: moments, quantile sketches and distinct counts of table parts.

A part (a day, a month, a file) is read once and leaves one row of bounded size for each key and column. Later questions
read these rows only: moments merge exactly, quantiles within ``rank_error(k)`` of the rows, distinct counts by HyperLogLog.
The exact forms are ``stats.describe``, ``stats.boxplot`` and ``count(DISTINCT)``, which read every row again.
"""
from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.stats import same_keys

#: Size of the quantile sketches: they keep a few times as many values.
K = 800
#: Binary logarithm of the registers of a distinct count: relative standard error 1.04 / sqrt(2 ** LG_REGISTERS) at most.
LG_REGISTERS = 12
#: Quantiles by which a share of rows beyond a bound is told.
GRID = 1000


def rank_error(k: int = K) -> float:
    """Error of a quantile as a share of the rows (99 of 100 times less), by the published fit for KLL sketches."""
    return 2.296 / k ** 0.9723


def summarise(df: DataFrame, cols: Sequence[str], part: Column, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """One row a part, key and column: part, by..., column, count, missing, mean, m2, lo, hi, quantiles, distinct.

    Null and NaN values count as missing and enter nothing else. Every aggregate is partial, so a part that holds most
    rows meets as one small row a task. ``by`` may hold nulls; names in ``by`` must differ from the names above.
    """
    taken = {"part", "column", "count", "missing", "mean", "m2", "lo", "hi", "quantiles", "distinct", "v", "h"} & set(by)
    if taken:
        raise ValueError(f"key columns {sorted(taken)} have names of the summary; rename them")

    def cell(c: str) -> Column:
        v = F.col(c).cast("double")
        there = v.isNotNull() & ~F.isnan(v)
        return F.struct(F.lit(c).alias("column"), F.when(there, v + 0.0).alias("v"), F.when(there, F.xxhash64(F.col(c) + F.lit(0))).alias("h"))

    long = df.select(part.cast("string").alias("part"), *by, F.inline(F.array(*[cell(c) for c in cols])))
    return long.groupBy("part", *by, "column").agg(
        F.count("v").alias("count"), (F.count(F.lit(1)) - F.count("v")).alias("missing"), F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("v")).alias("m2"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.kll_sketch_agg_double("v", F.lit(k)).alias("quantiles"), F.hll_sketch_agg("h", F.lit(LG_REGISTERS)).alias("distinct"))


def store(summary: DataFrame, path: str) -> None:
    """Write the parts of a summary below ``path``, one folder a part. A part that is taken again replaces what was stored
    of it, so a job may be repeated; other parts stay."""
    (summary.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path))


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The stored parts; a filter on ``part`` reads only those folders."""
    return spark.read.parquet(path).withColumn("part", F.col("part").cast("string"))


def merge(parts: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """Summary rows of (by..., column) from those of parts, and of keys that ``by`` leaves out: the same columns without part.

    Squares about the common mean come in a second pass over the summary rows, not from differences of large sums.
    """
    by = list(by)
    n, keys = F.col("count"), [*by, "column"]
    means = parts.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)]).agg(
        (F.sum(F.col("mean") * n) / F.nullif(F.sum(n), F.lit(0))).alias("__mean"))
    g = parts.join(means, same_keys(keys)).groupBy(*keys).agg(
        F.sum(n).alias("count"), F.sum("missing").alias("missing"), F.max("__mean").alias("mean"),
        F.sum(F.col("m2") + n * F.pow(F.col("mean") - F.col("__mean"), 2)).alias("m2"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.kll_merge_agg_double("quantiles", F.lit(k)).alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))
    return g


def _quantile(q: float) -> Column:
    return F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(q)))


def describe_sketch(parts: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """A6, A7, A11 from stored parts: by..., column, count, missing, mean, std (sample), min, q25, q50, q75, max (exact but for the
    quartiles, which are values of the column), distinct (estimate). Without a value all but the counts are null."""
    g = merge(parts, by, k)
    return g.select(
        *by, "column", "count", "missing", "mean", F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"),
        F.col("lo").alias("min"), _quantile(0.25).alias("q25"), _quantile(0.5).alias("q50"), _quantile(0.75).alias("q75"), F.col("hi").alias("max"),
        F.hll_sketch_estimate("distinct").alias("distinct"))


def boxplot_sketch(parts: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """A9 from stored parts: by..., column, q1, median, q3, lo_fence, hi_fence (1.5 quartile distances out, within the data) and
    outliers, the estimated number of rows beyond the fences (by a grid of GRID
    quantiles: error of a fence at most ``rank_error(k) + 1 / GRID`` of the rows)."""
    q = merge(parts, by, k).select("*", _quantile(0.25).alias("q1"), _quantile(0.5).alias("median"), _quantile(0.75).alias("q3"))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    q = q.withColumn("lo_fence", F.greatest(F.col("q1") - reach, F.col("lo"))).withColumn("hi_fence", F.least(F.col("q3") + reach, F.col("hi")))
    grid = F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("quantiles", F.array(*[F.lit((i + 0.5) / GRID) for i in range(GRID)])))
    beyond = F.size(F.filter(grid, lambda v: (v < F.col("lo_fence")) | (v > F.col("hi_fence")))) / GRID
    return q.select(*by, "column", "q1", "median", "q3", "lo_fence", "hi_fence",
                    F.when(F.col("count") > 0, F.round(beyond * F.col("count"))).cast("bigint").alias("outliers"))
