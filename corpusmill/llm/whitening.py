"""Operator 12: whitening of embeddings by a bit-sliced scatter matrix.

Entries become integers x = floor(SCALE * c) + OFFSET. The fit list holds each distinct x
vector once. A task takes blocks of its rows, shifts every dimension by its least value
in the block, and cuts the shifted values into bit planes: plane b of a dimension has a
row's bit b, and the bits of 64 rows share a word. The popcount of two planes' AND tells in how many rows
both bits are set, so the popcounts of all plane pairs, weighted by 2 ** (a + b), are the
exact sums of products of every two dimensions; the shifts are put back in whole numbers. Blocks give one
row a pair of dimensions, which Spark adds up in two DECIMAL(38) parts. The scatter matrix is centred as
integers too (n * sum(x y) - sum(x) * sum(y)) and becomes floating point only for eigh.
Only sums over dimensions, whose number does not grow with the rows, reach the driver.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are left
out; so are rows whose length is not the most common one (the larger on ties), and empty vectors. Rows with null or repeated
vec_id are rows like others. Entries beyond 2**55 in size are taken as that. A component whose eigenvalue is zero (to
rounding) has null ``whitened``; ``explained`` is null if all variances are zero; ``deviation`` is null
where it exceeds a long. An empty table gives an empty result. Other columns are not read, whatever their names.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Rows whose bits are packed at once.
BLOCK = 1 << 16
#: Bytes of vectors in a batch that a task hands on.
BATCH = 4 << 20
_LONG = 1 << 63


def to_grid(values: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(values, -(2.0**55), 2.0**55) * SCALE).astype(np.int64) + OFFSET


def grid(rows: DataFrame, key: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(id, x): the whole-number vectors of the rows that take part, x as little-endian longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("v").is_valid())
            lists = batch.column("v")
            n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            values = lists.flatten().to_numpy(zero_copy_only=False)  # nulls become NaN
            row = np.repeat(np.arange(len(n)), n)
            good = np.bincount(row[~np.isfinite(values)], minlength=len(n)) == 0
            x = to_grid(values[good[row]]).astype("<i8").tobytes()
            ids, ends = batch.column("id").filter(pa.array(good)), np.concatenate([[0], np.cumsum(8 * n[good])])
            step = max(1, BATCH // max(8, int(8 * n.max(initial=1))))
            for a in range(0, len(ids), step):
                part = ends[a : a + step + 1]
                cells = pa.Array.from_buffers(pa.binary(), len(part) - 1, [None, pa.py_buffer((part - part[0]).astype(np.int32)), pa.py_buffer(x[part[0] : part[-1]])])
                yield pa.RecordBatch.from_arrays([ids.slice(a, step), cells], names=["id", "x"])

    source = rows.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"))
    return source.mapInArrow(run, "id long, x binary")


def dimensions(vectors: DataFrame) -> int:
    """The most common length (the larger on ties); 0 without rows."""
    n = F.octet_length("x")
    top = vectors.groupBy(n.alias("n")).count().filter("n > 0").orderBy(F.desc("count"), F.desc("n")).first()
    return top["n"] // 8 if top else 0


def _matrix(cells: pa.Array, dims: int) -> np.ndarray:
    if not len(cells):
        return np.zeros((0, dims), np.int64)
    wide = cells.cast(pa.large_binary())
    start = int(np.frombuffer(wide.buffers()[1], np.int64)[wide.offset])
    return np.frombuffer(wide.buffers()[2], "<i8", count=len(cells) * dims, offset=start).reshape(-1, dims)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(planes, dimension, bit) of non-negative whole numbers: each plane's row bits packed into 64-bit words."""
    words = -(-len(y) // 64)
    planes, dim, bit = [], [], []
    for j in range(y.shape[1]):
        for b in range(int(y[:, j].max(initial=0)).bit_length()):
            packed = np.zeros(8 * words, np.uint8)
            bits = np.packbits(((y[:, j] >> b) & 1).astype(np.uint8))
            packed[: len(bits)] = bits
            planes.append(packed.view(np.uint64))
            dim.append(j)
            bit.append(b)
    return np.array(planes, np.uint64).reshape(len(planes), words), np.array(dim, np.int64), np.array(bit, np.int64)


def cross_products(y: np.ndarray) -> np.ndarray:
    """Exact sums over rows of y_i * y_j (objects: Python integers), by weighted AND-popcounts of bit planes."""
    dims = y.shape[1]
    planes, dim, bit = bit_planes(y)
    both = np.zeros((len(planes), len(planes)), np.int64)
    for a in range(len(planes)):
        both[a, a:] = np.bitwise_count(planes[a] & planes[a:]).sum(axis=1, dtype=np.int64)
        both[a:, a] = both[a, a:]
    top = int(bit.max(initial=0)) + 1
    weights = np.zeros((len(planes), dims), np.int64 if len(y).bit_length() + 2 * top + 1 < 63 else object)
    weights[np.arange(len(planes)), dim] = np.array([1 << b for b in bit.tolist()], weights.dtype)
    if weights.dtype == object:
        both = both.astype(object)
    return (weights.T @ both @ weights).astype(object) if len(planes) else np.full((dims, dims), 0, object)


def block_sums(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, sums, sums of products) of a block, as Python integers."""
    low = x.min(axis=0)
    y = x - low
    n, low = len(x), low.astype(object)
    s = np.array([int(v) for v in (y >> 32).sum(axis=0)], object) * (1 << 32) + (y & 0xFFFFFFFF).sum(axis=0).astype(object)
    return n, s + n * low, cross_products(y) + np.outer(low, s) + np.outer(s, low) + n * np.outer(low, low)


def scatter(fit: DataFrame, dims: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, S, sums of products) over all rows of ``fit`` (x), exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done() -> pa.RecordBatch:
            n, s, p = block_sums(np.concatenate(held))
            upper = [(i, j) for i in range(dims) for j in range(i, dims)]
            i, j = [-1] + [-1] * dims + [a for a, _ in upper], [-1, *range(dims)] + [b for _, b in upper]
            v = [n, *s.tolist(), *(p[a, b] for a, b in upper)]
            parts = [pa.array([int(a) >> 60 for a in v], pa.decimal128(38, 0)), pa.array([int(a) & ((1 << 60) - 1) for a in v], pa.decimal128(38, 0))]
            return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *parts], names=["i", "j", "hi", "lo"])

        for batch in batches:
            part = _matrix(batch.column("x"), dims)
            for a in range(0, len(part), BLOCK):
                held.append(part[a : a + BLOCK])
                size += len(held[-1])
                if size >= BLOCK:
                    yield done()
                    held, size = [], 0
        if size:
            yield done()

    sums = fit.select("x").mapInArrow(run, "i int, j int, hi decimal(38,0), lo decimal(38,0)").groupBy("i", "j").agg(F.sum("hi"), F.sum("lo"))
    n, s, p = 0, [0] * dims, [[0] * dims for _ in range(dims)]
    for i, j, hi, lo in sums.collect():  # one row a pair of dimensions
        v = (int(hi) << 60) + int(lo)
        if i >= 0:
            p[i][j] = p[j][i] = v
        elif j >= 0:
            s[j] = v
        else:
            n = v
    return n, s, p


@dataclass
class Whitening:
    """A fitted whitening: rows of ``axes`` are the unit eigenvectors, by falling eigenvalue."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    explained: list[float | None]
    error: float | None = None

    @property
    def usable(self) -> np.ndarray:
        return self.values > 0

    def shifted(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        reach = max((max(abs(self.n * int(v)) for v in (x.min(initial=0), x.max(initial=0))) + max(map(abs, self.sums))), 1)
        return self.n * (x if reach < _LONG else x.astype(object)) - np.array(self.sums, np.int64 if reach < _LONG else object)

    def project(self, shifted: np.ndarray) -> np.ndarray:
        """Whitened coordinates; those of components without variance are NaN."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (shifted / self.n).astype(float) @ self.axes.T / np.sqrt(np.where(self.usable, self.values, np.nan))
        return out

    def deviations(self, shifted: np.ndarray) -> list[int | None]:
        """Exact sums of squares; None beyond a long."""
        most = int(np.abs(shifted).max(initial=0))
        if most * most * max(1, len(self.sums)) < _LONG:
            return (shifted.astype(np.int64) ** 2).sum(axis=1).tolist()
        each = [sum(int(v) * int(v) for v in row) for row in shifted]
        return [v if v < _LONG else None for v in each]


def solve(n: int, sums: list[int], products: list[list[int]], components: int = COMPONENTS) -> Whitening:
    """Eigenvectors of the exactly centred covariance."""
    dims = len(sums)
    cov = np.array([[(n * products[i][j] - sums[i] * sums[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    trace = sum(n * products[i][i] - sums[i] * sums[i] for i in range(dims)) / (n * n)
    top = np.where(values[order] > dims * np.finfo(float).eps * max(values.max(), 0.0) * 4, values[order], 0.0)
    return Whitening(n, sums, vectors.T[order], top, [float(v) / trace if trace else None for v in top])


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of (covariance of the whitened fit list - identity), measured on its rows."""
    use = np.flatnonzero(model.usable)
    k, dims = len(use), len(model.sums)
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = model.project(model.shifted(_matrix(batch.column("x"), dims)))[:, use]
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        i, j = np.divmod(np.arange(total.size), k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())], names=["i", "j", "v"])

    total = np.zeros((k + 1, k))
    for i, j, v in fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        total[i, j] = v / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of ``vectors`` (x); None without rows."""
    dims = dimensions(vectors)
    if not dims:
        return None
    fit = stored(vectors.filter(F.octet_length("x") == 8 * dims).select("x").distinct(), "op12-fit")
    model = solve(*scatter(fit, dims), components)
    model.error = identity_error(fit, model)
    return model


def whitened(rows: DataFrame, key: str = "vec_id", vec: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per row that takes part and component: id, component, n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    vectors = grid(rows, key, vec)
    model = fitted(vectors, components)
    schema = f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], schema)
    dims, k = len(model.sums), len(model.values)
    step = max(1, BATCH // (64 * k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, step):
                batch = whole.slice(a, step)
                shifted = model.shifted(_matrix(batch.column("x"), dims))
                w, rows_ = model.project(shifted).ravel(), batch.num_rows
                at = pa.array(np.repeat(np.arange(rows_), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(at),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_)),
                        pa.array(np.full(rows_ * k, model.n)),
                        pa.array(model.deviations(shifted), pa.int64()).take(at),
                        pa.array(w, mask=np.isnan(w)),
                        pa.array(model.explained * rows_, pa.float64()),
                        pa.array([model.error] * (rows_ * k), pa.float64()),
                    ],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.filter(F.octet_length("x") == 8 * dims).mapInArrow(run, schema)
