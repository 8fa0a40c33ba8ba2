"""Operator 9: token counts by a separator scan of flat token files.

A token file is nothing but little-endian unsigned 16-bit ids, each document ended by
the end-of-document id; no index, no lengths. Files are cut into blocks of fixed
size that are read apart; in a block all separators are found at once with numpy. Every
separator ends a document; all but the first of a block lie in one block with their predecessor. What
a block cannot know, how many documents ended before it and where the last separator before it
lies, comes from a prefix scan over one summary row a block. A
file whose last document has no separator ends in an open document, reported as such.

``write_token_files`` makes such files from documents with Spark's text writer: the bytes of a
document's ids are the line, the end-of-document id's bytes are the line separator, so
the writer's commit protocol covers lost tasks. Files are reached through ``pyarrow.fs``.

Null and empty texts are documents of no tokens; repeated rows are documents of their own; an
empty table gives files without documents, hence an empty result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.bpe import encode_text, encoding
from corpusmill.llm.common import map_slices, shared_path, stored, strings
from corpusmill.llm.warc import store

#: Bytes of a block.
BLOCK = 4 << 20


def write_token_files(docs: DataFrame, path: str, rank_file: str, pattern: str, end_id: int) -> None:
    """The ids of every whole text, in the order of the rows, one file a task."""
    if not 0 <= end_id < 1 << 16:
        raise ValueError("ids are 16-bit")

    def make():
        enc = encoding(rank_file, pattern)

        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            raw = [np.array(encode_text(enc, t), dtype="<u2").tobytes() for t in strings(part, "text").to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], names=["ids"])

        return one

    ids = map_slices(docs.select("text"), "text", make, "ids binary")
    separator = end_id.to_bytes(2, "little").decode("latin-1")
    ids.select(F.col("ids").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", separator).text(path)


def _separators(batches, end_id: int):
    """One row a separator: its file, block, number in the block, place in the file and that of the one before in the block."""
    for batch in batches:
        for path, start, size in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "size"))):
            where, name = store(path)
            with where.open_input_file(name) as f:
                ids = np.frombuffer(f.read_at(size, start), dtype="<u2")
            at = np.flatnonzero(ids == end_id) + start // 2
            if len(at):
                before = pa.array(np.concatenate([[0], at[:-1]]), mask=np.arange(len(at)) == 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(at)), pa.array(np.full(len(at), start)), pa.array(np.arange(len(at))), pa.array(at), before],
                    names=["path", "start", "i", "at", "before"],
                )


def token_counts(spark: SparkSession, path: str, end_id: int, block: int = BLOCK) -> DataFrame:
    """One row a document: file (its path), doc_no (from 0 in the file), start (place of its first id), n_tokens, open."""
    block -= block % 2
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    files = stored(files, "op9-files")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block).cast("long"))
    blocks = files.filter("length > 0").select("path", "length", F.explode(starts).alias("start"))
    blocks = blocks.select("path", "start", F.least(F.lit(block), F.col("length") - F.col("start")).alias("size"))
    found = blocks.repartition("path", "start").mapInArrow(lambda b: _separators(b, end_id), "path string, start long, i long, at long, before long")
    found = stored(found, "op9-separators")

    # the prefix scan: one row a block, in the order of its file
    sums = found.groupBy("path", "start").agg(F.count(F.lit(1)).alias("n"), F.max("at").alias("last"))
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    scan = sums.select("path", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("docs_before"), F.coalesce(F.max("last").over(earlier), F.lit(-1)).alias("carry"))
    begin = F.coalesce("before", "carry") + 1
    ended = found.join(scan, ["path", "start"]).select(F.col("path").alias("file"), (F.col("docs_before") + F.col("i")).alias("doc_no"), begin.alias("start"), (F.col("at") - begin).alias("n_tokens"), F.lit(False).alias("open"))

    ends = sums.groupBy("path").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    tail = files.join(ends, "path", "left").select(F.col("path").alias("file"), F.coalesce("n", F.lit(0)).alias("doc_no"), (F.coalesce("last", F.lit(-1)) + 1).alias("start"), F.floor(F.col("length") / 2).alias("tokens"))
    rest = tail.filter("tokens > start").select("file", "doc_no", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(True).alias("open"))
    return ended.unionByName(rest)


def counted_documents(docs: DataFrame, rank_file: str, pattern: str, end_id: int) -> DataFrame:
    """Write documents as token files into the shared folder and count by scanning: file (number of the file), doc_no, start, n_tokens."""
    spark = docs.sparkSession
    path = shared_path(spark, "op9-tokens")
    write_token_files(docs, path, rank_file, pattern, end_id)
    out = token_counts(spark, path, end_id)
    return out.select(F.regexp_extract("file", "part-([0-9]+)", 1).cast("long").alias("file"), "doc_no", "start", "n_tokens")
