"""Shared helpers: table reads, written intermediates in the shared folder, Arrow batches of bounded size."""
from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import discard, shared_path, ship_package, stored  # noqa: F401 (operators import them from here)

#: Bytes of text a task turns into numpy arrays at once.
TEXT_BYTES = 4 << 20
#: Bits of the bitmaps that rule out rows before a join, as a power of two.
FILTER = 26


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read by Spark only (the path may be in a store that only Spark reaches)."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_slices(batch: pa.RecordBatch, column: str, limit: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows so that each piece has about ``limit`` bytes of ``column`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only


def release() -> None:
    """Give freed memory back to the system: Spark keeps its Python workers, and what they hold on to adds to that of later stages."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def map_slices(df: DataFrame, column: str, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str, limit: int = TEXT_BYTES) -> DataFrame:
    """mapInArrow over slices of bounded text; ``make`` runs once per task and returns the slice function."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for part in text_slices(batch, column, limit):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out
        release()

    return df.mapInArrow(run, schema)


def strings(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The column as non-null strings; null counts as empty."""
    col = batch.column(column)
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    return pc.fill_null(col, "")


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added while a column of the frames has it (in any case)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _bit(key: Column) -> Column:
    return F.pmod(key, F.lit(1 << FILTER))


def bitmap(keys: DataFrame) -> DataFrame:
    """(__w, __b) from (key): the set bits of all keys mod 2 ** FILTER, 64 a row, so 2 ** (FILTER - 6) rows at most."""
    bit = keys.select(_bit(F.col("key")).alias("b"))
    return bit.groupBy(F.shiftright("b", 6).alias("__w")).agg(F.bit_or(F.expr("shiftleft(1L, int(b % 64))")).alias("__b"))


def flagged(rows: DataFrame, key: Column, bits: DataFrame, hit: str = "__hit") -> DataFrame:
    """``rows`` with ``hit``: whether the bitmap has the key. False rules a key out; no shuffle of ``rows``."""
    k, w, b = (free_name(n, rows) for n in ("__k", "__w", "__b"))
    j = rows.withColumn(k, _bit(key)).join(F.broadcast(bits.toDF(w, b)), F.shiftright(k, 6) == F.col(w), "left")
    return j.withColumn(hit, F.coalesce(F.expr(f"shiftright({b}, int({k} % 64)) & 1L") == 1, F.lit(False))).drop(k, w, b)


def parted(rows: DataFrame, key: Column, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may have one of the keys, rows that surely have none); ``keys``: (key), computed like the Column ``key``."""
    hit = free_name("__hit", rows)
    marked = flagged(rows, key, stored(bitmap(keys), "bitmap"), hit)
    return marked.filter(hit).drop(hit), marked.filter(~F.col(hit)).drop(hit)
