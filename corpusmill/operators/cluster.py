"""Similarity joins and clustering.

Nearest neighbours and neighbours within a distance are exact and come from the distributed ball tree of
``operators/balltree.py``; for sparse text vectors see ``operators/sparse.py``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from corpusmill.operators import balltree
from corpusmill.operators import stats as ST
from corpusmill.session import cut_lineage, stored

def _vec(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("array<double>")


def _stack(x: pd.Series) -> np.ndarray:
    return np.vstack(x.to_numpy()).astype(float) if len(x) else np.zeros((0, 0))


def _euclid_np(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    return pd.Series(np.sqrt(((_stack(a) - _stack(b)) ** 2).sum(axis=1)))


def _dot_np(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    return pd.Series((_stack(a) * _stack(b)).sum(axis=1))


def _unit_np(a: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=object)
    m = _stack(a)
    return pd.Series(list(m / np.sqrt((m * m).sum(axis=1, keepdims=True))))


def euclid(a: Column, b: Column) -> Column:
    """Euclidean distance of two array columns (one numpy pass per Arrow batch)."""
    return F.pandas_udf(_euclid_np, "double")(a, b)


def dot(a: Column, b: Column) -> Column:
    return F.pandas_udf(_dot_np, "double")(a, b)


def l2_normalize(v: Column) -> Column:
    """V / ||v||."""
    return F.pandas_udf(_unit_np, "array<double>")(v)


def _rows(df: DataFrame, key: str, vec: str) -> DataFrame:
    return df.select(F.col(key).cast("bigint").alias("id"), _vec(vec).alias("v"))


def knn(queries: DataFrame, base: DataFrame, k: int, qkey: str = "qid", bkey: str = "bid", vec: str = "vec",
        exclude_self: bool = False, digits: int = 9, leaf: int = balltree.LEAF) -> DataFrame:
    """Exact k nearest neighbours (Euclidean) of every query among ``base``. Ties by (rounded distance, base key).
    Output: qkey, rank, bkey, dist. Null or not finite vectors take no part; lengths that differ raise ValueError."""
    found = balltree.nearest(_rows(queries, qkey, vec), _rows(base, bkey, vec), k, exclude_self, digits, leaf)
    return found.select(F.col("id").alias(qkey), "rank", F.col("bid").alias(bkey), "dist")


def knn_vote(neigh: DataFrame, labels: DataFrame, qkey: str, bkey: str, label: str = "label") -> DataFrame:
    """M6: uniform vote over the neighbours; ties to the smallest label."""
    v = neigh.join(labels.select(F.col(bkey), F.col(label).alias("__l")), bkey).groupBy(qkey, "__l").agg(
        F.count(F.lit(1)).alias("votes"))
    return v.groupBy(qkey).agg(F.min(F.struct(F.negative("votes"), F.col("__l"))).alias("b")).select(
        qkey, F.col("b.__l").alias("prediction"))


def eps_pairs(df: DataFrame, key: str, vec: str, min_cos: float, digits: int = 6, leaf: int = balltree.LEAF) -> DataFrame:
    """Pairs (a < b) of vectors whose L2-normalised forms have cosine >= min_cos
    (Euclidean distance <= sqrt(2 - 2 min_cos)); exact. Zero, null or not finite vectors have no pairs; lengths that
    differ raise ValueError."""
    kind = df.schema[vec].dataType
    v = F.col(vec) if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else _vec(vec)
    return balltree.within(df.select(F.col(key).cast("bigint").alias("id"), v.alias("v")), min_cos, digits, leaf)


# --------------------------------------------------------------------------- M16
def core_points(df: DataFrame, pairs: DataFrame, key: str, min_pts: int) -> DataFrame:
    """DBSCAN core flags: neighbours + 1 >= min_pts."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("a"))  # the pairs are found once
    deg = ends.groupBy("a").agg(F.count(F.lit(1)).alias("deg"))
    return df.select(F.col(key).alias("a")).join(deg, "a", "left").select(
        F.col("a").alias(key), (F.coalesce("deg", F.lit(0)) + 1 >= min_pts).alias("core"))


#: Pairs that a task thins at a time, and points from which on it begins anew.
THIN_PAIRS, THIN_POINTS = 1 << 20, 1 << 20


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of 0 .. n - 1 that each reaches by the edges (a, b)."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        more = ra != rb
        a, b, ra, rb = a[more], b[more], ra[more], rb[more]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def thinned(pairs: DataFrame, min_pts: int) -> DataFrame:
    """What DBSCAN needs of neighbours (a, b; each pair once), at most about ``min_pts`` rows a point and task instead of all pairs:
    rows (a, null, near) that add up to the weight of a's neighbours, and edges (a, b, null). Columns wa, wb: the points' own
    weights (1 without them); core points have a weight of ``min_pts`` with their neighbours.

    A point that is known to be core by the pairs of one task is so by all. Among those, the task keeps one edge to the smallest point
    reached; points that are not have few neighbours there, and keep all edges."""
    kind = pairs.schema["a"].dataType.simpleString()
    weighted = "wa" in pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, held, n = None, [], 0

        def thin():
            nonlocal held, n
            cols = [pa.concat_arrays([b.column(c) for b in held]).to_numpy(zero_copy_only=False) for c in range(4 if weighted else 2)]
            held, n = [], 0
            old, near, own, x, y = state if state is not None else (cols[0][:0], *(np.zeros(0, np.int64) for _ in range(4)))
            names, code = np.unique(np.concatenate([old, *cols[:2]]), return_inverse=True)
            code = code.reshape(-1)
            was, a, b = np.split(code, [len(old), len(old) + len(cols[0])])
            wa, wb = cols[2:] if weighted else (np.ones(len(a), np.int64),) * 2
            weight, sums = np.ones(len(names), np.int64), np.zeros(len(names), np.int64)
            sums[was], weight[was] = near, own
            weight[a], weight[b] = wa, wb
            sums += np.bincount(a, wb, len(names)).astype(np.int64) + np.bincount(b, wa, len(names)).astype(np.int64)
            x, y = np.concatenate([was[x], a]), np.concatenate([was[y], b])
            sure = sums + weight >= min_pts
            core = sure[x] & sure[y]
            root = _roots(len(names), x[core], y[core])
            below = np.flatnonzero(root != np.arange(len(names)))
            return names, sums, weight, np.concatenate([root[below], x[~core]]), np.concatenate([below, y[~core]])

        def told() -> pa.RecordBatch:
            names, sums, _, x, y = state
            none = pa.nulls(len(names), kind_)
            a = pa.concat_arrays([pa.array(names, kind_), pa.array(names[x], kind_)])
            b = pa.concat_arrays([none, pa.array(names[y], kind_)])
            return pa.RecordBatch.from_arrays([a, b, pa.concat_arrays([pa.array(sums), pa.nulls(len(x), pa.int64())])], names=["a", "b", "near"])

        kind_ = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind_ = batch.column(0).type
            held.append(batch)
            n += batch.num_rows
            if n >= THIN_PAIRS:
                state = thin()
                if len(state[0]) >= THIN_POINTS:
                    yield told()
                    state = None
        if held:
            state = thin()
        if state is not None:
            yield told()

    return pairs.mapInArrow(run, f"a {kind}, b {kind}, near bigint")


def core_components(core: DataFrame, ce: DataFrame) -> DataFrame:
    """(a, lab) of core points (a): the smallest core point that the core-core edges (a, b; both ways) reach;
    by min-label propagation, one join and aggregate per round, checkpointed."""
    lab = core.select("a", F.col("a").alias("lab"))
    while True:  # until no label changes
        nb = ce.join(lab.withColumnRenamed("a", "b").withColumnRenamed("lab", "nl"), "b").groupBy("a").agg(
            F.min("nl").alias("m"))
        step = lab.join(nb, "a", "left").select("a", F.least("lab", F.coalesce("m", "lab")).alias("lab"))
        # pointer jumping: a label is itself a core point of the same component,
        # so taking the label of the label is safe and shortens the chains
        jump = step.join(step.select(F.col("a").alias("lab"), F.col("lab").alias("ll")), "lab", "left").select(
            "a", F.least("lab", F.coalesce("ll", "lab")).alias("lab"))
        new = cut_lineage(jump.join(lab.withColumnRenamed("lab", "old"), "a").withColumn(
            "chg", F.col("lab") != F.col("old")).drop("old"))
        changed = new.filter("chg").limit(1).count()
        lab = new.drop("chg")
        if changed == 0:
            break
    return lab


def dbscan(df: DataFrame, key: str, vec: str, min_cos: float, min_pts: int = 5,
           pairs: DataFrame | None = None) -> DataFrame:
    """DBSCAN on cosine neighbourhoods. Core = neighbours + 1 >= min_pts;
    core components by min-label propagation (one join + aggregate per round,
    checkpointed); border points take the smallest neighbouring core label;
    noise is -1. Output: key, cluster (smallest core key of the component), core."""
    pr = pairs if pairs is not None else eps_pairs(df, key, vec, min_cos)
    few = stored(thinned(pr.select("a", "b"), min_pts), "pairs")  # read for degrees, core edges and borders
    deg = few.filter("b is null").groupBy("a").agg(F.sum("near").alias("deg"))
    pr = few.filter("b is not null").select("a", "b")
    both = pr.union(pr.select(F.col("b").alias("a"), F.col("a").alias("b")))
    ids = df.select(F.col(key).alias("a"))
    info = ids.join(deg, "a", "left").withColumn("core", F.coalesce("deg", F.lit(0)) + 1 >= min_pts)
    core = info.filter("core").select("a").distinct()  # a repeated key is one point
    ce = both.join(core, "a").join(core.withColumnRenamed("a", "b"), "b")  # core-core edges
    ce = stored(ce.select("a", "b"), "core-pairs")
    lab = core_components(core, ce)
    border = both.join(lab.withColumnRenamed("a", "b").withColumnRenamed("lab", "nl"), "b").groupBy("a").agg(
        F.min("nl").alias("bl"))
    out = info.join(lab, "a", "left").join(border, "a", "left").select(
        F.col("a").alias(key),
        F.when(F.col("core"), F.col("lab")).otherwise(F.coalesce("bl", F.lit(-1))).cast("bigint").alias("cluster"),
        "core")
    return out


# --------------------------------------------------------------------------- M14 / M15
def kmeans(df: DataFrame, key: str, vec: str, k: int, restarts: int = 10, seed: int = 42,
           max_iter: int = 50) -> tuple[DataFrame, float]:
    """K-means with several seeded restarts, lowest training cost kept.
    Output: (key, cluster), cost."""
    data = df.select(key, array_to_vector(_vec(vec)).alias("features")).cache()
    best = None
    for r in range(restarts):
        m = KMeans(k=k, seed=seed + r, maxIter=max_iter).fit(data)
        cost = m.summary.trainingCost
        if best is None or cost < best[1]:
            best = (m, cost)
    out = cut_lineage(best[0].transform(data).select(key, F.col("prediction").cast("bigint").alias("cluster")))
    data.unpersist()
    return out, best[1]


def bisecting(df: DataFrame, key: str, vec: str, k: int, seed: int = 42) -> DataFrame:
    """M15, re-aimed: hierarchical clusters by bisecting k-means, fully distributed."""
    data = df.select(key, array_to_vector(_vec(vec)).alias("features"))
    m = BisectingKMeans(k=k, seed=seed).fit(data)
    return m.transform(data).select(key, F.col("prediction").cast("bigint").alias("cluster"))


def fit_clusters(rows: DataFrame, key: str, method: str, k: int, restarts: int = 2, seed: int = 42, max_iter: int = 20) -> DataFrame:
    """M14, M15 on prepared rows (key, features; sparse ones stay sparse): (key, cluster) by ``kmeans`` (the restart of lowest
    training cost) or ``bisecting``. Only the k centres are held by the driver. Fewer distinct rows than k give fewer clusters."""
    if method == "kmeans":
        fits = [KMeans(k=k, seed=seed + r, maxIter=max_iter).fit(rows) for r in range(restarts)]
        model = min(fits, key=lambda m: m.summary.trainingCost)
    elif method == "bisecting":
        model = BisectingKMeans(k=k, seed=seed, maxIter=max_iter).fit(rows)
    else:
        raise ValueError(f"method is kmeans or bisecting, not {method}")
    return model.transform(rows).select(key, F.col("prediction").cast("bigint").alias("cluster"))


def report(labels: DataFrame, clusterings: dict, key: str, label: str) -> DataFrame:
    """Rows (method, k, clusters, ari, completeness, ami) of several clusterings {(method, k): (key, cluster)} against
    ``labels`` (key, label). k is null for methods that find their own number; rows without a label or cluster take no part."""
    out = None
    for (method, k), found in clusterings.items():
        both = labels.select(key, F.col(label).alias("__l")).join(found.select(key, F.col("cluster").alias("__c")), key)
        j = cut_lineage(both.select("__l", "__c").filter("__l IS NOT NULL AND __c IS NOT NULL"))
        values = {name: fn(j, "__l", "__c").first()[0] for name, fn in (("ari", ST.ari), ("completeness", ST.completeness), ("ami", ST.ami))}
        row = j.agg(F.count_distinct("__c").alias("clusters")).select(
            F.lit(method).alias("method"), F.lit(k).cast("bigint").alias("k"), "clusters",
            *[F.lit(v).cast("double").alias(name) for name, v in values.items()])
        out = row if out is None else out.unionByName(row)
    return out
