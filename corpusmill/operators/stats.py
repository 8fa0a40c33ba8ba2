"""Descriptive, classification and clustering metrics as aggregates.

Quantiles are exact (linear interpolation, like SQL ``quantile_cont``) without
holding a group's values in one buffer: values are counted per distinct value,
given global cumulative counts by the range-partitioned prefix sum, and the two
order statistics around each requested position are picked by a range filter.
Label-domain tables (confusion, contingency margins) are bounded by the number of
classes.
"""
from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.ordered import prefix_sum
from corpusmill.session import cut_lineage, small_side

EPS_KERAS = 1e-7


# --------------------------------------------------------------------------- quantiles
def same_keys(by: Sequence[str]) -> Column:
    """Null-safe equality of the keys with their copies __k0, __k1, ..."""
    out = F.lit(True)
    for i, k in enumerate(by):
        out &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return out


def quantiles(df: DataFrame, value: str, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles per key (linear interpolation): rows (by..., q, quantile).

    One pass over the cumulative-count table: each distinct value row emits the
    (q, low/high) order statistics whose position its count range covers.
    """
    by = list(by)
    d = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__w"))
    c = prefix_sum(d, by + [value], "__w", "__cum").withColumn("__lo", F.col("__cum") - F.col("__w"))
    if by:
        ks = c.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(by)]).agg(F.min("__lo").alias("__base"), F.sum("__w").alias("__n"))
        c = c.join(small_side(ks), same_keys(by)).drop(*[f"__k{i}" for i in range(len(by))])
        base, n = F.col("__base"), F.col("__n")
    else:
        base, n = F.lit(0).cast("bigint"), d.select(F.sum("__w")).scalar()
    hits = []
    for q in qs:
        pos = (n - 1) * F.lit(float(q))
        frac = pos - F.floor(pos)
        for side, t in ((0, F.floor(pos)), (1, F.ceil(pos))):
            tt = base + t
            hits.append(F.when((F.col("__lo") <= tt) & (tt < F.col("__cum")), F.struct(
                F.lit(float(q)).alias("q"), frac.alias("frac"), F.lit(side).alias("side"))))
    ex = c.select(*by, F.col(value).alias("__v"), F.explode(F.array(*hits)).alias("h")).filter(F.col("h").isNotNull())
    g = ex.groupBy(*by, F.col("h.q").alias("q"), F.col("h.frac").alias("__frac")).agg(
        F.max(F.when(F.col("h.side") == 0, F.col("__v"))).alias("__vlo"),
        F.max(F.when(F.col("h.side") == 1, F.col("__v"))).alias("__vhi"))
    return g.select(*by, "q", (F.col("__vlo") + (F.col("__vhi") - F.col("__vlo")) * F.col("__frac")).alias(
        "quantile"))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: count, mean, std (sample), min, 25%, 50%, 75%, max.
    The columns are stacked into (column, v) so one grouped pass serves them all."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("s")).select("s.column", "s.v")
    base = long.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    qs = quantiles(long, "v", [0.25, 0.5, 0.75], ["column"])
    wide = qs.groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("quantile")).toDF(
        "column", "q25", "q50", "q75")
    return base.join(wide, "column").select(
        "column", F.col("count").cast("bigint").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def histogram(df: DataFrame, value: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over each group's own [min, max]; last bin closed.
    Output: by..., bin, lo, hi, n (only non-empty bins). Null and NaN values lie in no bin."""
    by = list(by)
    x = F.col(value).cast("double")
    df = df.filter(x.isNotNull() & ~F.isnan(x))
    if by:
        mm = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(by)]).agg(F.min(x).alias("__mn"), F.max(x).alias("__mx"))
        j = df.join(small_side(mm), same_keys(by))
    else:  # global bounds enter as scalar subqueries
        j = df.withColumn("__mn", df.select(F.min(x)).scalar()).withColumn("__mx", df.select(F.max(x)).scalar())
    width = (F.col("__mx") - F.col("__mn")) / F.lit(bins)
    b = F.when(F.col("__mx") == F.col("__mn"), F.lit(0)).otherwise(
        F.least(F.floor((x - F.col("__mn")) / (F.col("__mx") - F.col("__mn")) * bins), F.lit(bins - 1))).cast("bigint")
    return j.groupBy(*by, b.alias("bin"), "__mn", "__mx").agg(F.count(F.lit(1)).alias("n")).select(
        *by, "bin", (F.col("__mn") + F.col("bin") * width).alias("lo"),
        (F.col("__mn") + (F.col("bin") + 1) * width).alias("hi"), "n")


def boxplot(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Per group Q1, median, Q3, whiskers at the last datum within 1.5 IQR,
    outlier count."""
    by = list(by)
    qs = quantiles(df, value, [0.25, 0.5, 0.75], by)
    wide = qs.groupBy(*by).pivot("q", [0.25, 0.5, 0.75]).agg(F.first("quantile")).toDF(*by, "q1", "median", "q3")
    keyed = small_side(wide.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(by)], "q1", "median", "q3"))
    j = df.select(*by, F.col(value).cast("double").alias("x")).join(keyed, same_keys(by))
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return j.groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(F.col("x") >= lo_f, F.col("x"))).alias("whisker_lo"),
        F.max(F.when(F.col("x") <= hi_f, F.col("x"))).alias("whisker_hi"),
        F.sum(F.when((F.col("x") < lo_f) | (F.col("x") > hi_f), 1).otherwise(0)).cast("bigint").alias("outliers"),
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A10: (value, n) by n desc."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("bigint"))


# --------------------------------------------------------------------------- A18 / A19
def confusion(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(y, p, n) over the full label x label grid (zeros included); a null label is a class."""
    counts = df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counts)  # a row a pair of classes: the rows are read once, for the counts and the classes
    labels = counts.select(F.col("y").alias("l")).union(counts.select(F.col("p").alias("l"))).distinct()
    # one row of |classes| entries: the grid that is asked for has their square; structs, as a list keeps no nulls
    dom = labels.agg(F.array_sort(F.collect_list(F.struct("l"))).alias("d"))
    grid = dom.select(F.explode("d.l").alias("gy"), "d").select("gy", F.explode("d.l").alias("gp"))
    on = F.col("gy").eqNullSafe(F.col("y")) & F.col("gp").eqNullSafe(F.col("p"))
    return grid.join(counts, on, "left").select(F.col("gy").alias("y"), F.col("gp").alias("p"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def per_class(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(label, tp, fp, fn, support) from one pass over the rows: counts of (y, p), each told once as
    truth and once as prediction. No label grid."""
    cm = cut_lineage(df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n")))
    sides = F.array(F.struct(F.col("y").alias("label"), F.lit(1).alias("act"), F.lit(0).alias("pred")),
                    F.struct(F.col("p").alias("label"), F.lit(0).alias("act"), F.lit(1).alias("pred")))
    told = cm.select("n", (F.col("y") == F.col("p")).alias("hit"), F.explode(sides).alias("s")).filter(F.col("s.label").isNotNull())
    s = told.groupBy(F.col("s.label").alias("label")).agg(
        F.sum(F.when(F.col("hit"), F.col("n") * F.col("s.act")).otherwise(0)).cast("bigint").alias("tp"),
        F.sum(F.col("n") * F.col("s.pred")).cast("bigint").alias("pp"),
        F.sum(F.col("n") * F.col("s.act")).cast("bigint").alias("support"))
    return s.select("label", "tp", (F.col("pp") - F.col("tp")).alias("fp"), (F.col("support") - F.col("tp")).alias("fn"),
                    "support")


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def prf(df: DataFrame, y: str = "y", p: str = "p", average: str = "weighted", pos_label=None) -> DataFrame:
    """One row (accuracy, precision, recall, f1) with ``average`` in binary
    (``pos_label``), micro, macro, weighted; zero where undefined."""
    pc = per_class(df, y, p)
    prec = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _safe_div(2 * prec * rec, prec + rec)
    pc = pc.select("*", prec.alias("pr"), rec.alias("rc"), f1.alias("f"))
    acc = F.sum("tp") / F.sum("support")
    if average == "binary":
        row = pc.filter(F.col("label") == F.lit(pos_label))
        accuracy = pc.select(acc).scalar()
        return row.select(accuracy.alias("accuracy"), F.col("pr").alias("precision"), F.col("rc").alias("recall"),
                          F.col("f").alias("f1"))
    if average == "micro":
        mp = _safe_div(F.sum("tp"), F.sum("tp") + F.sum("fp"))
        mr = _safe_div(F.sum("tp"), F.sum("tp") + F.sum("fn"))
        return pc.agg(acc.alias("accuracy"), mp.alias("precision"), mr.alias("recall")).withColumn(
            "f1", _safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    if average == "macro":
        return pc.agg(acc.alias("accuracy"), F.avg("pr").alias("precision"), F.avg("rc").alias("recall"),
                      F.avg("f").alias("f1"))
    if average == "weighted":
        wsum = F.sum("support")
        return pc.agg(acc.alias("accuracy"), (F.sum(F.col("pr") * F.col("support")) / wsum).alias("precision"),
                      (F.sum(F.col("rc") * F.col("support")) / wsum).alias("recall"),
                      (F.sum(F.col("f") * F.col("support")) / wsum).alias("f1"))
    raise ValueError(average)


def onehot_metrics(df: DataFrame, ys: Sequence[str], ps: Sequence[str], eps: float = EPS_KERAS) -> DataFrame:
    """Clipped-and-rounded precision / recall / F1 with epsilon (rounding half
    to even), mean squared error and categorical cross-entropy over one-hot targets
    ``ys`` and predicted probabilities ``ps``."""
    clip = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    tp = sum((F.bround(clip(F.col(y) * F.col(p))) for y, p in zip(ys, ps)), F.lit(0.0))
    pp = sum((F.bround(clip(F.col(p))) for p in ps), F.lit(0.0))
    ap = sum((F.bround(clip(F.col(y))) for y in ys), F.lit(0.0))
    se = sum(((F.col(y) - F.col(p)) ** 2 for y, p in zip(ys, ps)), F.lit(0.0))
    ce = sum((F.col(y) * F.log(F.greatest(F.lit(eps), F.least(F.lit(1 - eps), F.col(p)))) for y, p in zip(ys, ps)),
             F.lit(0.0))
    agg = df.agg(F.sum(tp).alias("tp"), F.sum(pp).alias("pp"), F.sum(ap).alias("ap"),
                 (F.sum(se) / (F.count(F.lit(1)) * len(ys))).alias("mse"), (-F.avg(ce)).alias("cce"))
    prec = F.col("tp") / (F.col("pp") + eps)
    rec = F.col("tp") / (F.col("ap") + eps)
    return agg.select(prec.alias("precision"), rec.alias("recall"),
                      (2 * prec * rec / (prec + rec + eps)).alias("f1"), "mse", "cce")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair in one aggregate; long form (a, b, corr)."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    stacked = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias(
        "corr")) for a, b in pairs]))
    return row.select(stacked.alias("s")).select("s.a", "s.b", "s.corr")


# --------------------------------------------------------------------------- A22 - A25
def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n)."""
    return df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))


def _comb2(c: Column) -> Column:
    x = c.cast("decimal(38,0)")
    return x * (x - 1) / 2


def ari(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index from pair counts over the contingency table."""
    ct = contingency(df, a, b)
    rows = ct.groupBy("a").agg(F.sum("n").alias("m"))
    cols = ct.groupBy("b").agg(F.sum("n").alias("m"))
    idx = ct.select(F.sum(_comb2(F.col("n")))).scalar()
    sa = rows.select(F.sum(_comb2(F.col("m")))).scalar()
    sb = cols.select(F.sum(_comb2(F.col("m")))).scalar()
    n = ct.select(F.sum("n")).scalar()
    expected = sa.cast("double") * sb.cast("double") / _comb2(n).cast("double")
    mx = (sa.cast("double") + sb.cast("double")) / 2
    spark = df.sparkSession
    val = F.when(mx == expected, F.lit(1.0)).otherwise((idx.cast("double") - expected) / (mx - expected))
    return spark.range(1).select(val.alias("ari"))


def _entropy(margins: DataFrame, n: Column) -> Column:
    p = F.col("m") / n
    return margins.select(-F.sum(p * F.log(p))).scalar()


def mutual_info(df: DataFrame, a: str, b: str):
    """(MI, H(a), H(b)) as scalar columns (natural log)."""
    ct = contingency(df, a, b)
    n = ct.select(F.sum("n").cast("double")).scalar()
    ra = ct.groupBy("a").agg(F.sum("n").alias("m"))
    cb = ct.groupBy("b").agg(F.sum("n").alias("m"))
    j = ct.join(ra.withColumnRenamed("m", "ma"), "a").join(cb.withColumnRenamed("m", "mb"), "b")
    mi = j.select(F.sum(F.col("n") / n * (F.log(F.col("n") * n) - F.log(F.col("ma") * F.col("mb"))))).scalar()
    return mi, _entropy(ra, n), _entropy(cb, n)


def completeness(df: DataFrame, labels_true: str, labels_pred: str) -> DataFrame:
    """MI / H(pred) (1.0 when H(pred) = 0)."""
    mi, _, hp = mutual_info(df, labels_true, labels_pred)
    return df.sparkSession.range(1).select(F.when(hp == 0, F.lit(1.0)).otherwise(mi / hp).alias("completeness"))


def _emi_terms(n_total: int):
    def run(batches):
        import numpy as np

        lg = np.frompyfunc(math.lgamma, 1, 1)
        N = float(n_total)
        for pdf in batches:
            a = pdf["a"].to_numpy(dtype=float)
            b = pdf["b"].to_numpy(dtype=float)
            k = pdf["k"].to_numpy(dtype=float)
            mult = pdf["mult"].to_numpy(dtype=float)
            logp = (lg(a + 1) + lg(b + 1) + lg(N - a + 1) + lg(N - b + 1) - lg(N + 1) - lg(k + 1) - lg(a - k + 1)
                    - lg(b - k + 1) - lg(N - a - b + k + 1)).astype(float)
            term = k / N * np.log(N * k / (a * b)) * np.exp(logp) * mult
            yield pdf.assign(term=term)[["term"]]

    return run


def ami(df: DataFrame, labels_true: str, labels_pred: str, chunk: int = 4096) -> DataFrame:
    """Adjusted mutual information, arithmetic mean normalisation.

    Expected MI sums hypergeometric terms over every pair of margins (a, b) and
    every feasible cell count; the count ranges are exploded in chunks and spread
    over tasks, and the log-factorials are evaluated on Arrow batches.
    """
    spark = df.sparkSession
    mi, ha, hb = mutual_info(df, labels_true, labels_pred)
    ct = contingency(df, labels_true, labels_pred)
    n_total = ct.agg(F.sum("n")).first()[0]  # one scalar, needed by the batch function
    ra = ct.groupBy("a").agg(F.sum("n").alias("ma")).groupBy("ma").agg(F.count(F.lit(1)).alias("ca"))
    cb = ct.groupBy("b").agg(F.sum("n").alias("mb")).groupBy("mb").agg(F.count(F.lit(1)).alias("cb"))
    # every pair of distinct margin values: the right margins (bounded by the
    # class count) enter as one scalar array and are exploded against the left
    right = cb.select(F.collect_list(F.struct("mb", "cb"))).scalar()
    pairs = ra.select("ma", "ca", F.explode(right).alias("r")).select("ma", "ca", "r.mb", "r.cb")
    lo = F.greatest(F.lit(1), F.col("ma") + F.col("mb") - F.lit(n_total))
    hi = F.least("ma", "mb")
    starts = pairs.select("ma", "mb", (F.col("ca") * F.col("cb")).alias("mult"), lo.alias("lo"), hi.alias("hi"))
    starts = starts.filter(F.col("lo") <= F.col("hi")).select(
        "ma", "mb", "mult", "hi", F.explode(F.sequence(F.col("lo"), F.col("hi"), F.lit(chunk))).alias("s"))
    cells = starts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).select(
        F.col("ma").alias("a"), F.col("mb").alias("b"), "mult",
        F.explode(F.sequence(F.col("s"), F.least(F.col("hi"), F.col("s") + chunk - 1))).alias("k"))
    emi = cells.mapInPandas(_emi_terms(n_total), "term double").select(F.sum("term")).scalar()
    mean_h = (ha + hb) / 2
    val = F.when(mean_h - emi == 0, F.lit(1.0)).otherwise((mi - emi) / (mean_h - emi))
    return spark.range(1).select(val.alias("ami"))
