"""Exact neighbour search by a distributed ball tree.

The upper levels are built on a sample of fixed size: each node cuts its points in two along the line between two far
ones, at the median. Every row descends to a leaf; a leaf's ball is its centre and its farthest row, measured over all
rows. There are at most ``MAX_LEAVES`` balls, so they can be sent to every task. A leaf of many rows is dealt into
chunks of about ``leaf`` rows, and many visitors of one leaf into parts of as many, so a group never grows with the data.
For neighbours within a distance, leaves make up blocks, and a row is copied once for each block that its distance meets.

Nearest neighbours: a query visits its nearest leaves until they hold enough rows, which bounds how far its neighbours
can be; the second visit goes only to the balls that this radius meets. Neighbours within a distance: a row visits only the
balls that the distance meets. Balls that cannot hold a neighbour are never read for a query, and no
row is copied to all leaves unless its radius meets them all (vectors without structure in many dimensions do that).
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from corpusmill.session import cut_lineage, stored

#: Rows and values of the sample, rows of a leaf, most leaves.
SAMPLE_ROWS, SAMPLE_VALUES = 1 << 15, 1 << 22
LEAF, MAX_LEAVES, LEAST_LEAVES = 2048, 1 << 12, 4
#: Visitors that are compared with a chunk at once.
BLOCK = 128
#: Values of a block of ``within``, blocks that it cuts few rows into, rows of a block that are compared with a leaf at once.
BLOCK_VALUES, LEAST_BLOCKS, TILE = 1 << 22, 8, 512


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of equal length as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def finite(rows: DataFrame) -> DataFrame:
    """Rows (id, v) that have an id and only finite components."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)


def counted(rows: DataFrame, *others: DataFrame) -> int:
    """Rows of the first frame; raises if the frames' vectors differ in length."""
    sizes = [f.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).first() for f in (rows, *others)]
    lengths = {x for _, lo, hi in sizes for x in (lo, hi) if x is not None}
    if len(lengths) > 1:
        raise ValueError(f"vectors have {min(lengths)} to {max(lengths)} components; distances need equal lengths")
    return sizes[0][0]


@dataclass
class Tree:
    """Inner nodes in heap order (children of i: 2 i + 1, 2 i + 2) and the leaves below the last level."""

    depth: int
    normals: np.ndarray
    cuts: np.ndarray
    centres: np.ndarray
    radii: np.ndarray | None = None
    counts: np.ndarray | None = None
    leaf: int = LEAF
    blocks: int = 0

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def route(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            side = np.einsum("ij,ij->i", x, self.normals[node]) > self.cuts[node]
            node = 2 * node + 1 + side
        return node - (self.leaves - 1)

    def from_centres(self, x: np.ndarray) -> np.ndarray:
        """(rows, leaves): distances to the centres; a little too small rather than too large."""
        sq = (x * x).sum(1)[:, None] + (self.centres**2).sum(1)[None, :]
        return np.sqrt(np.maximum(sq - 2 * (x @ self.centres.T) - 1e-9 * np.maximum(sq, 1.0), 0.0))

    def chunks(self) -> np.ndarray:
        return np.maximum(-(-self.counts // self.leaf), 1)


def grow(points: np.ndarray, leaves: int) -> Tree:
    """A tree of at most ``leaves`` leaves over the sampled points."""
    depth = max(0, min(leaves, max(1, len(points) // 4)).bit_length() - 1)
    dims = points.shape[1]
    normals, cuts = np.zeros(((1 << depth) - 1, dims)), np.zeros((1 << depth) - 1)
    level = [np.arange(len(points))]
    for d in range(depth):
        below = []
        for i, own in enumerate(level):
            x = points[own]
            if len(x):
                far = x[((x - x.mean(0)) ** 2).sum(1).argmax()]
                line = x[((x - far) ** 2).sum(1).argmax()] - far
                side = x @ line
                cut = np.median(side)
                normals[(1 << d) - 1 + i], cuts[(1 << d) - 1 + i] = line, cut
                below += [own[side <= cut], own[side > cut]]
            else:
                below += [own, own]
        level = below
    centres = np.array([points[own].mean(0) if len(own) else np.zeros(dims) for own in level]).reshape(len(level), dims)
    return Tree(depth, normals, cuts, centres)


def sampled(rows: DataFrame, n: int, leaf: int = LEAF) -> Tree:
    """The tree of a sample of rows (id, v), its balls still without rows."""
    dims = max(1, rows.select(F.max(F.size("v"))).first()[0] or 1)
    take = min(SAMPLE_ROWS, max(64, SAMPLE_VALUES // dims))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(take).select("v").toArrow()  # of fixed size
    tree = grow(matrix(sample["v"]), min(MAX_LEAVES, max(LEAST_LEAVES, -(-n // leaf))))
    tree.leaf = leaf
    return tree


def measured(tree: Tree, placed: DataFrame) -> None:
    """Radius and rows of each ball, from rows (leaf, far)."""
    balls = placed.groupBy("leaf").agg(F.max("far").alias("r"), F.count(F.lit(1)).alias("n")).collect()  # one row a leaf
    tree.radii, tree.counts = np.full(tree.leaves, -np.inf), np.zeros(tree.leaves, np.int64)
    for leaf, r, m in balls:
        tree.radii[leaf], tree.counts[leaf] = r * (1 + 1e-9) + 1e-9, m


def planted(rows: DataFrame, n: int, leaf: int = LEAF) -> tuple[Tree, DataFrame]:
    """The tree of rows (id, v) and the rows with their leaf and chunk: (id, v, leaf, chunk)."""
    tree = sampled(rows, n, leaf)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("v"))
                at = tree.route(x)
                far = np.sqrt(((x - tree.centres[at]) ** 2).sum(1))
                yield batch.append_column("leaf", pa.array(at.astype(np.int32))).append_column("far", pa.array(far))

    placed = cut_lineage(rows.mapInArrow(place, "id bigint, v array<double>, leaf int, far double"))
    measured(tree, placed)
    return tree, with_count(placed.drop("far"), "leaf", tree.chunks(), "chunk")


def with_count(rows: DataFrame, leaf: str, parts: np.ndarray, out: str) -> DataFrame:
    """Rows dealt into ``parts[leaf]`` by a hash of their id."""
    many = [(int(i), int(parts[i])) for i in np.flatnonzero(parts > 1)]  # of at most MAX_LEAVES
    table = F.broadcast(rows.sparkSession.createDataFrame(many, "__leaf int, __parts int"))
    j = rows.join(table, F.col(leaf) == F.col("__leaf"), "left")
    return j.withColumn(out, F.pmod(F.xxhash64("id"), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__leaf", "__parts")


def visits(tree: Tree, rows: DataFrame, choose, extra: str = "") -> DataFrame:
    """(id, v, ..., leaf): each row once for every leaf that ``choose(tree, batch, x)`` names as (row, leaf)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                row, leaf = choose(tree, batch, matrix(batch.column("v")))
                out = batch.take(pa.array(row))
                yield out.append_column("leaf", pa.array(leaf.astype(np.int32)))

    return rows.mapInArrow(run, f"id bigint, v array<double>{extra}, leaf int")


def met(tree: Tree, visitors: DataFrame, placed: DataFrame, compare, schema: str) -> DataFrame:
    """``compare(visitors, rows)`` of every chunk of a leaf with every part of its visitors; where visitors name two blocks (lo, hi),
    ``compare(batches)`` of tasks that have all visitors of a pair of blocks together."""
    if "lo" in visitors.columns:
        groups = tree.blocks * (tree.blocks + 1) // 2
        return visitors.repartition(min(groups, 1 << 14), "lo", "hi").sortWithinPartitions("lo", "hi").mapInArrow(compare, schema)
    visitors = cut_lineage(visitors)
    crowd = np.zeros(tree.leaves, np.int64)
    for leaf, n in visitors.groupBy("leaf").count().collect():  # one row a leaf
        crowd[leaf] = n
    parts = np.maximum(-(-crowd // tree.leaf), 1)
    chunks = tree.chunks()
    spark = visitors.sparkSession
    table = F.broadcast(spark.createDataFrame([(int(i), int(chunks[i]), int(parts[i])) for i in np.flatnonzero(crowd)], "__leaf int, __chunks int, __parts int"))
    left = visitors.join(table, F.col("leaf") == F.col("__leaf"))
    left = left.withColumn("part", F.pmod(F.xxhash64("id"), F.col("__parts")).cast("int"))
    left = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1))).drop("__leaf", "__chunks", "__parts")
    right = placed.join(table, F.col("leaf") == F.col("__leaf"))
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__leaf", "__chunks", "__parts")
    keys = ["leaf", "chunk", "part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, schema)


def nearest(queries: DataFrame, base: DataFrame, k: int, exclude_self: bool = False, digits: int = 9, leaf: int = LEAF) -> DataFrame:
    """(id, rank, bid, dist): the k rows of ``base`` (id, v) nearest to each query (id, v), ties by (rounded distance, bid)."""
    schema = "id bigint, rank bigint, bid bigint, dist double"
    queries, base = finite(queries), finite(base)
    n = counted(base, queries)
    if not n:
        return queries.sparkSession.createDataFrame([], schema)
    # of equal vectors only the first k can be among the k nearest (one more, as one may be the query itself)
    w = Window.partitionBy("v").orderBy("id")
    base = base.withColumn("__i", F.row_number().over(w)).filter(F.col("__i") <= k + 1).drop("__i")
    tree, placed = planted(base, n, leaf)
    enough = k + int(exclude_self)

    def home(tree: Tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which leaves (row, leaf) a query visits first: the nearest ones that together hold enough rows."""
        order = np.argsort(tree.from_centres(x), axis=1, kind="stable")
        held = np.cumsum(tree.counts[order], axis=1)
        use = ((held - tree.counts[order]) < enough) & (tree.counts[order] > 0)
        row, place = np.nonzero(use)
        return row, order[row, place]

    def choose_first(tree: Tree, batch: pa.RecordBatch, x: np.ndarray):
        return home(tree, x)

    def choose_second(tree: Tree, batch: pa.RecordBatch, x: np.ndarray):
        reach = batch.column("reach").to_numpy(zero_copy_only=False)
        meets = (tree.from_centres(x) - tree.radii[None, :] <= reach[:, None] + 10.0 ** (1 - digits)) & (tree.counts > 0)
        meets[home(tree, x)] = False
        return np.nonzero(meets)

    def compare(want: pa.Table, have: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if want.num_rows and have.num_rows:
            x, y, ids = matrix(want["v"]), matrix(have["v"]), have["id"].to_numpy()
            xx, yy, names = (x * x).sum(1), (y * y).sum(1), want["id"].to_pylist()
            for i, name in enumerate(names):
                if i % BLOCK == 0:
                    sq = xx[i:i + BLOCK, None] + yy[None, :]
                    rough = sq - 2 * (x[i:i + BLOCK] @ y.T)
                    slack = 1e-9 * np.maximum(sq.max(1), 1.0)  # above the rounding error of the product form
                r = np.where(ids == name, np.inf, rough[i % BLOCK]) if exclude_self else rough[i % BLOCK]
                m = min(k, len(r)) - 1
                near_by = np.flatnonzero(r <= np.partition(r, m)[m] + 2 * slack[i % BLOCK] + 10.0 ** (1 - digits))
                near_by = near_by[np.isfinite(r[near_by])]
                d = np.round(np.sqrt(((y[near_by] - x[i]) ** 2).sum(axis=1)), digits)
                out += [(name, int(ids[j]), e) for e, j in sorted(zip(d.tolist(), near_by.tolist()), key=lambda t: (t[0], ids[t[1]]))[:k]]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table({"id": pa.array(cols[0], pa.int64()), "bid": pa.array(cols[1], pa.int64()), "dist": pa.array(cols[2], pa.float64())})

    pair = "id bigint, bid bigint, dist double"
    order = Window.partitionBy("id").orderBy("dist", "bid")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= k)

    first = cut_lineage(best(met(tree, visits(tree, queries, choose_first), placed, compare, pair)).drop("rank"))
    reach = first.groupBy("id").agg(F.max("dist").alias("far"), F.count(F.lit(1)).alias("found"))
    reach = reach.select("id", F.when(F.col("found") < k, F.lit(float("inf"))).otherwise(F.col("far")).alias("reach"))
    again = queries.join(reach, "id", "left").withColumn("reach", F.coalesce("reach", F.lit(float("inf"))))
    second = met(tree, visits(tree, again.select("id", "v", "reach"), choose_second, ", reach double"), placed, compare, pair)
    # a query id that is repeated counts once
    return best(first.unionByName(second).distinct()).select("id", "rank", "bid", "dist")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, initial=0.0)[:, None]
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def within(rows: DataFrame, min_cos: float, digits: int = 6, leaf: int = LEAF) -> DataFrame:
    """(a, b, cos), a < b: all pairs of rows (id, v) whose unit vectors have round(cosine, digits) >= min_cos.

    Rows whose vector is null, zero or not finite have no pairs. Leaves make up blocks of a bounded number of values. A task compares
    two blocks; a row goes to it if its distance meets a leaf of the other block, once, with its numbers as they were read. Pairs
    are handed on as they are found."""
    schema = "a bigint, b bigint, cos double"
    rows = finite(rows).filter(F.exists("v", lambda x: x != 0.0))
    n = counted(rows)
    if not n:
        return rows.sparkSession.createDataFrame([], schema)
    kind = np.dtype(np.float32 if isinstance(rows.schema["v"].dataType.elementType, FloatType) else np.float64)
    dims = rows.select(F.max(F.size("v"))).first()[0]

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _unit(matrix(batch.column("v")).astype(float))
                off = pa.array(np.arange(0, x.size + 1, max(1, x.shape[1]), dtype=np.int32)[: len(x) + 1])
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(off, pa.array(x.ravel()))], names=["id", "v"])

    tree = sampled(rows.mapInArrow(unit, "id bigint, v array<double>"), n, leaf)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = np.ascontiguousarray(matrix(batch.column("v")), kind)
                x = _unit(raw.astype(float))
                at = tree.route(x)
                far = np.sqrt(((x - tree.centres[at]) ** 2).sum(1))
                off = pa.array(np.arange(len(raw) + 1, dtype=np.int32) * (dims * kind.itemsize))
                v = pa.Array.from_buffers(pa.binary(), len(raw), [None, off.buffers()[1], pa.py_buffer(raw.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column("id"), v, pa.array(at.astype(np.int32)), pa.array(far)], names=["id", "v", "leaf", "far"])

    placed = stored(rows.mapInArrow(place, "id bigint, v binary, leaf int, far double"), "placed")
    measured(tree, placed)
    reach = np.sqrt(max(0.0, 2 - 2 * (min_cos - 10.0**-digits))) + 1e-6

    # leaves that follow each other make a block, a leaf of too many rows is dealt into several
    most = max(1, min(max(leaf, -(-n // LEAST_BLOCKS)), BLOCK_VALUES // dims))
    first, parts, blocks, room = np.zeros(tree.leaves, np.int64), np.maximum(-(-tree.counts // most), 1), 0, 0
    for i in range(tree.leaves):
        if parts[i] > 1 or tree.counts[i] > room:
            blocks += 1
            room = most
        first[i] = blocks - 1
        if parts[i] > 1:
            blocks += int(parts[i]) - 1
            room = 0
        else:
            room -= int(tree.counts[i])

    tree.blocks = blocks

    def vectors(column: pa.Array) -> np.ndarray:
        off = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        return np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]].view(kind).reshape(len(column), -1)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                x = _unit(vectors(batch.column("v")).astype(float))
                at = batch.column("leaf").to_numpy()
                own = first[at] + batch.column("part").to_numpy() % parts[at]
                meets = (tree.from_centres(x) - tree.radii[None, :] <= reach) & (tree.counts > 0)
                other = np.zeros((len(x), blocks), bool)
                for leaf_ in np.flatnonzero(meets.any(0)):
                    other[:, first[leaf_]:first[leaf_] + parts[leaf_]] |= meets[:, leaf_, None]
                other[np.arange(len(x)), own] = True
                row, to = np.nonzero(other)
                lo, hi = np.minimum(own[row], to), np.maximum(own[row], to)
                out = batch.select(["id", "v", "leaf"]).take(pa.array(row))
                for name, col in (("lo", lo), ("hi", hi), ("side", own[row] > lo)):
                    out = out.append_column(name, pa.array(col.astype(np.int32)))
                yield out

    def compare(left: tuple, right: tuple | None) -> Iterator[pa.RecordBatch]:
        ids, v, _ = left
        others, w, leaves = right or left
        for leaf_ in np.unique(leaves):
            there = np.flatnonzero(leaves == leaf_)
            ball = Tree(0, tree.normals, tree.cuts, tree.centres[leaf_:leaf_ + 1])
            here = np.flatnonzero(ball.from_centres(v)[:, 0] - tree.radii[leaf_] <= reach)
            if right is None:
                here = np.union1d(here, there)
            y, names = w[there], others[there]
            for k in range(0, len(here), TILE):
                some = here[k:k + TILE]
                c = v[some] @ y.T
                i, j = np.nonzero(c >= min_cos - 10.0**-digits)
                cos = np.round(c[i, j], digits)
                x, z = ids[some[i]], names[j]
                keep = (cos >= round(min_cos, digits)) & ((x < z) if right is None else (x != z))
                x, z = x[keep], z[keep]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, z)), pa.array(np.maximum(x, z)), pa.array(cos[keep])], names=["a", "b", "cos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None

        def group() -> Iterator[pa.RecordBatch]:
            side = np.concatenate([b.column("side").to_numpy() for b in held])
            ids, leaves = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("id", "leaf"))
            x = _unit(np.concatenate([vectors(b.column("v")) for b in held]).astype(float))
            held.clear()
            sides = [(ids[side == s], x[side == s], leaves[side == s]) for s in (0, 1)]
            if now[0] == now[1]:
                yield from compare(sides[0], None)
            elif len(sides[0][0]) and len(sides[1][0]):
                yield from compare(*sides)

        for batch in batches:
            if not batch.num_rows:
                continue
            lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
            cuts = [0, *(np.flatnonzero(np.diff(lo * blocks + hi)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if held and now != (lo[a], hi[a]):
                    yield from group()
                now = (lo[a], hi[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield from group()

    parted = placed.select("id", "v", "leaf", F.pmod(F.xxhash64("id"), F.lit(1 << 30)).cast("int").alias("part"))
    visitors = parted.mapInArrow(visit, "id bigint, v binary, leaf int, lo int, hi int, side int")
    return met(tree, visitors, placed, run, schema)
