"""Operator 4: approximate nearest neighbours by a permutation index.

A vector is represented by the ordered list of its ``PREFIX`` nearest of ``PIVOTS``
pivots. The index is cut into blocks of about ``BLOCK`` vectors; within a block the
lists are posted in inverted files, one a pivot, holding place and vector. For a query,
the inverted files of its own pivots are read and each hit adds PREFIX + 1 - max(place,
place in the query), which ranks candidates as the footrule distance of the two lists
does (a missing pivot counts as place PREFIX + 1): for lists of equal length the distance is a
constant minus twice that sum. The best ``SHARE`` of a block, with all ties, are
reranked by exact cosine in double precision.

Pivots are fitted on a bounded sample (the ``PIVOTS`` vectors of smallest hash); every
vector is indexed. Equal vectors are indexed once, with as many of their smallest ids as a
result can hold, so a vector that a third of all rows share costs one entry. Queries go
to the blocks in blocks of ``QUERIES``, so no task holds all of either. Measured recall is in the README.

Vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part; nor do rows without id. Rows that repeat id and vector are one
vector. Ties go to the smaller id. An empty table gives an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import discard, stored

PIVOTS = 256
PREFIX = 128
BLOCK = 4096
#: Share of a block that is reranked, and its least number.
SHARE, LEAST = 1 / 8, 256
QUERIES = 1024


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v: array of double) of the vectors that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = F.col(vec_col).cast("array<double>")
    ok = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter("id is not null and v is not null and size(v) > 0")
    ok = ok.filter(~F.exists("v", bad) & F.exists("v", lambda x: x != 0))
    top = ok.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return ok.filter(F.size("v") == (top["d"] if top else 0)).dropDuplicates(["id", "v"])


def matrix(col: pa.Array) -> np.ndarray:
    """(rows, dimension) of a list column without nulls."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def permutations(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """(rows, prefix) numbers of the nearest pivots, nearest first, ties to the smaller number."""
    return np.argsort(-(unit(x) @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int16)


class InvertedFiles:
    """For each pivot the vectors whose list holds it, with PREFIX - place (places from 0)."""

    def __init__(self, lists: np.ndarray, pivots: int) -> None:
        n, self.prefix = lists.shape
        order = np.argsort(lists, axis=None, kind="stable")
        self.rows = order // self.prefix
        self.gain = self.prefix - order % self.prefix
        self.starts = np.searchsorted(lists.reshape(-1)[order], np.arange(pivots + 1))
        self.n = n

    def rank(self, query: np.ndarray) -> np.ndarray:
        """For each vector the sum of PREFIX + 1 - max(place, place): the larger, the smaller the footrule distance."""
        total = np.zeros(self.n, np.int64)
        for place, p in enumerate(query.tolist()):
            a, b = self.starts[p], self.starts[p + 1]
            total[self.rows[a:b]] += np.minimum(self.gain[a:b], self.prefix - place)
        return total


def candidates(total: np.ndarray, share: float, least: int) -> np.ndarray:
    """The best of a block, with all that tie with the last; all, if the last shares no pivot with the query."""
    take = max(least, int(np.ceil(share * len(total))))
    if take >= len(total):
        return np.arange(len(total))
    return np.flatnonzero(total >= np.partition(total, len(total) - take)[len(total) - take])


def nearest(rows: DataFrame, queries: DataFrame, n: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX, block: int = BLOCK, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """The ``n`` nearest found of ``rows`` for each of ``queries``, itself excepted: query_id, rank, vec_id, score."""
    vectors = stored(usable(rows, id_col, vec_col), "op4-vectors")
    first = Window.partitionBy("v").orderBy("id")
    ids = vectors.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= n + 1)
    index = ids.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # at most n + 1 ids a vector
    index = stored(index.select("v", "ids", F.element_at("ids", 1).alias("id")), "op4-index")
    asked = stored(usable(queries, id_col, vec_col), "op4-asked")
    ask = asked.groupBy("v").agg(F.min("id").alias("q"))
    total, asks = index.count(), ask.count()
    sample = index.orderBy(F.xxhash64("id"), "id").select("v").limit(pivots).toArrow()
    if not total or not asks:
        return asked.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).filter("false")
    pivot = unit(matrix(sample["v"]))
    prefix = min(prefix, len(pivot))

    def lists(names: list[str]):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    p = permutations(matrix(batch.column("v")), pivot, prefix)
                    col = pa.FixedSizeListArray.from_arrays(pa.array(p.reshape(-1)), prefix).cast(pa.list_(pa.int16()))
                    yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), col], names=[*names, "p"])

        return run

    blocks, asked_blocks = -(-total // block), -(-asks // QUERIES)
    posted = index.mapInArrow(lists(["id", "ids", "v"]), "id long, ids array<long>, v array<double>, p array<short>")
    posted = posted.select("*", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("ib"), F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))).alias("qb"))
    put = ask.mapInArrow(lists(["q", "v"]), "q long, v array<double>, p array<short>")
    put = put.select("*", F.pmod(F.xxhash64("q"), F.lit(asked_blocks)).cast("int").alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("ib"))

    def search(have: pa.Table, want: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if have.num_rows and want.num_rows:
            x, q = matrix(have["v"]), matrix(want["v"])
            scale = np.abs(x).max(axis=1, keepdims=True)
            x, x_ids = x / scale, have["ids"].to_pylist()
            norms = np.linalg.norm(x, axis=1)
            files = InvertedFiles(matrix(have["p"]), len(pivot))
            for name, vec, perm in zip(want["q"].to_pylist(), q, matrix(want["p"])):
                near = candidates(files.rank(perm), share, least)
                vec = vec / np.abs(vec).max()
                cos = (x[near] @ vec) / (norms[near] * np.linalg.norm(vec))
                # all that reach the (n + 1)th place, ties too, before ids decide
                if len(near) > n + 1:
                    last = np.partition(cos, len(cos) - n - 1)[len(cos) - n - 1]
                    keep = np.flatnonzero(cos >= last)
                    near, cos = near[keep], cos[keep]
                found = sorted((-s, i) for r, s in zip(near.tolist(), cos.tolist()) for i in x_ids[r])
                out += [(name, i, -s) for s, i in found[: n + 1]]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table({"q": pa.array(cols[0], pa.int64()), "vec_id": pa.array(cols[1], pa.int64()), "score": pa.array(cols[2], pa.float64())})

    hits = posted.groupBy("ib", "qb").cogroup(put.groupBy("ib", "qb")).applyInArrow(search, "q long, vec_id long, score double")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = hits.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= n + 1)
    lists_of = top.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
    named = asked.join(lists_of.join(ask, "q").select("v", "found"), "v")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("id")), 1, n)
    each = named.select("id", F.posexplode(others).alias("i", "f"))
    out = each.select(F.col("id").alias("query_id"), (F.col("i") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
    out = stored(out, "op4-result")
    discard(vectors, index, asked)
    return out
