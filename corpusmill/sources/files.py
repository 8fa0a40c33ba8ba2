"""File sources and sinks (S1-S14): article JSON, edge lists, CSV/TSV tables,
directory corpora, seed lists, crawl logs, doc maps, unigram and index files,
token files, nested JSON documents and labelled image folders.

Every reader is a Spark scan with an explicit schema (no inference on large
inputs); every writer is a DataFrame write, so both scale with the cluster.
"""
from __future__ import annotations

from typing import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import text as X
from corpusmill.session import small_side
from corpusmill.sources.split import cut_records

CORRUPT = "_corrupt_record"


# --------------------------------------------------------------------------- S1
def read_articles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S1 (Q1): JSON files, each an array of objects; one row per item with its
    ``text``. Returns (articles(path, text), errors(path)) — unreadable files are
    reported, not fatal, and give no article. A file is read by many tasks (``sources.split``)."""
    records, files = cut_records(spark, path, "json")
    items = records.select("path", F.from_json("record", f"text string, {CORRUPT} string",
                                               {"columnNameOfCorruptRecord": CORRUPT}).alias("item"))
    bad = files.filter("not complete").select("path").union(items.filter(F.col(f"item.{CORRUPT}").isNotNull()).select("path"))
    bad = small_side(bad.distinct())
    arts = items.join(bad, "path", "left_anti").filter(F.col("item.text").isNotNull()).select("path", "item.text")
    return arts, bad


# --------------------------------------------------------------------------- S2
def read_edges(spark: SparkSession, path: str) -> tuple[DataFrame, int | None]:
    """Whitespace-separated ``src dst`` lines; ``#`` lines are comments and a
    ``# Nodes: N`` header gives the node count."""
    lines = spark.read.text(path)
    header = lines.filter(F.col("value").rlike(r"^#\s*Nodes:")).select(
        F.regexp_extract("value", r"Nodes:\s*(\d+)", 1).cast("long").alias("n")).limit(1).collect()
    n = header[0]["n"] if header else None
    parts = F.split(F.trim(F.col("value")), r"\s+")
    edges = lines.filter(~F.col("value").startswith("#") & (F.trim("value") != "")).select(
        parts[0].cast("long").alias("src"), parts[1].cast("long").alias("dst"))
    return edges, n


# --------------------------------------------------------------------------- S3 / S4
def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S3: CSV with a header row, quoted multi-line fields, explicit schema. A file is read by many tasks
    (``sources.split``); as with Spark's own reader, fields that do not fit are null."""
    if isinstance(schema, T.StructType):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    records, _ = cut_records(spark, path, "csv")
    line = F.regexp_replace("record", r"\r?\n\z", "")
    rows = records.filter(~F.col("first")).select(line.alias("line")).filter("line != ''")
    return rows.select(F.from_csv("line", schema, {"escape": '"', "multiLine": "true"}).alias("row")).select("row.*")


def read_labelled(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``text<TAB>label`` files, one per source; fields stripped, label int,
    a literal ``source`` column; the chosen sources are unioned."""
    out = None
    for source, path in paths.items():
        df = spark.read.csv(path, sep="\t", quote="", schema="text string, label string").select(
            F.trim("text").alias("text"), F.trim("label").cast("int").alias("label"), F.lit(source).alias("source"))
        out = df if out is None else out.unionByName(df)
    return out


# --------------------------------------------------------------------------- S5
def read_dir_corpus(spark: SparkSession, root: str, encoding: str = "UTF-8") -> DataFrame:
    """``<root>/<label>/<file>`` corpus; text decoded (latin-1 or utf-8), label
    from the parent folder, label id by sorted label name."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    docs = files.select(
        "path", X.decode_text("content", encoding).alias("text"),
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("label"))
    from corpusmill.operators.ordered import dense_id

    ids = dense_id(docs.select("label").distinct(), ["label"], out="label_id")
    return docs.join(small_side(ids), "label").select("path", "text", "label", "label_id")


# --------------------------------------------------------------------------- S6 / S7
def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Seed list ``topic, url``."""
    return spark.read.csv(path, schema="topic string, url string", ignoreLeadingWhiteSpace=True,
                          ignoreTrailingWhiteSpace=True)


CRAWL_SCHEMA = "topic string, url string, doc_id long, published_at timestamp"


def write_crawl_log(df: DataFrame, path: str) -> None:
    """S7 (Q2): append crawl records, every field quoted (URLs may hold commas)."""
    df.select("topic", "url", "doc_id", "published_at").write.mode("append").option("quoteAll", True).csv(path)


def read_crawl_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=CRAWL_SCHEMA)


# --------------------------------------------------------------------------- S8
def write_doc_map(df: DataFrame, path: str) -> None:
    """``<sha256> | H<id>`` lines, overwritten (not appended) each time."""
    df.select(F.concat_ws(" | ", "url_hash", F.concat(F.lit("H"), F.col("doc_id").cast("string"))).alias(
        "value")).write.mode("overwrite").text(path)


def read_doc_map(spark: SparkSession, path: str) -> DataFrame:
    parts = F.split(F.col("value"), r" \| ")
    return spark.read.text(path).select(parts[0].alias("url_hash"),
                                        F.regexp_replace(parts[1], "^H", "").cast("long").alias("doc_id"))


# --------------------------------------------------------------------------- S9
def write_unigrams(df: DataFrame, path: str, fmt: str = "text") -> None:
    """``token: count`` text lines, or Parquet."""
    if fmt == "parquet":
        df.select("token", "n").write.mode("overwrite").parquet(path)
    else:
        df.select(F.concat_ws(": ", "token", F.col("n").cast("string")).alias("value")).write.mode(
            "overwrite").text(path)


def read_unigrams(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """Counts are read back as numbers (Q5)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    v = spark.read.text(path)
    return v.select(F.regexp_extract("value", r"^(.*): (\d+)$", 1).alias("token"),
                    F.regexp_extract("value", r"^(.*): (\d+)$", 2).cast("long").alias("n"))


def store_spell_index(unigrams: DataFrame, path: str) -> None:
    """The vocabulary and its symmetric-delete index, once; the index sorted by deletion, so that lookups prune
    row groups."""
    from corpusmill.operators.text import spell_index

    unigrams.select("token", "n").write.mode("overwrite").parquet(f"{path}/vocabulary")
    index = spell_index(unigrams.sparkSession.read.parquet(f"{path}/vocabulary"))
    index.repartitionByRange("part").sortWithinPartitions("part").write.mode("overwrite").parquet(f"{path}/deletions")


def load_spell_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(unigrams, index) as ``store_spell_index`` wrote them."""
    return spark.read.parquet(f"{path}/vocabulary"), spark.read.parquet(f"{path}/deletions")


# --------------------------------------------------------------------------- S10
def write_index(post: DataFrame, path: str, fmt: str = "parquet", parts: int | None = None) -> None:
    """The inverted index sorted by term.

    ``parquet``: flat postings range-partitioned and sorted by token, so later
    token lookups prune row groups by min/max statistics. ``json``: one object per
    term with soundex and postings. ``table``: the pipe table
    ``| term | soundex | [(doc, tf), ...] |``.
    """
    spark = post.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if fmt == "parquet":
        post.repartitionByRange(parts, "token").sortWithinPartitions("token", "doc_id").write.mode(
            "overwrite").parquet(path)
        return
    nested = post.groupBy("token").agg(
        F.array_sort(F.collect_list(F.struct(F.col("doc_id"), F.col("tf")))).alias("postings")).withColumn(
        "soundex", X.soundex_code("token"))
    ordered = nested.repartitionByRange(parts, "token").sortWithinPartitions("token")
    if fmt == "json":
        ordered.select("token", "soundex", "postings").write.mode("overwrite").json(path)
    elif fmt == "table":
        pl = F.concat(F.lit("["), F.array_join(F.transform("postings", lambda p: F.concat(
            F.lit("("), p["doc_id"].cast("string"), F.lit(", "), p["tf"].cast("string"), F.lit(")"))), ", "),
            F.lit("]"))
        ordered.select(F.concat(F.lit("| "), F.col("token"), F.lit(" | "), F.col("soundex"), F.lit(" | "), pl,
                                F.lit(" |")).alias("value")).write.mode("overwrite").text(path)
    else:
        raise ValueError(fmt)


def store_search_index(post: DataFrame, doc_map: DataFrame, path: str) -> None:
    """All that a search needs, once: postings sorted by token, the vocabulary with soundex
    codes and document frequencies, the doc map, and the impact-ordered blocks of the postings whose document it holds."""
    from corpusmill.operators.text import impact_blocks, vocabulary

    write_index(post, f"{path}/postings")
    known = read_index(post.sparkSession, f"{path}/postings").join(doc_map.select("doc_id").distinct(), "doc_id", "left_semi")
    impact_blocks(known).repartitionByRange("token", "no").sortWithinPartitions("token", "no").write.mode("overwrite").parquet(f"{path}/blocks")
    vocabulary(read_index(post.sparkSession, f"{path}/postings")).write.mode("overwrite").parquet(f"{path}/vocabulary")
    doc_map.select("doc_id", "url").write.mode("overwrite").parquet(f"{path}/doc_map")


def load_search_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(postings, vocabulary, doc map) of a stored index."""
    return tuple(spark.read.parquet(f"{path}/{part}") for part in ("postings", "vocabulary", "doc_map"))


def load_search_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(blocks, vocabulary, doc map) of a stored index."""
    return tuple(spark.read.parquet(f"{path}/{part}") for part in ("blocks", "vocabulary", "doc_map"))


def read_index(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Back to flat (token, doc_id, tf)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "json":
        schema = "token string, soundex string, postings array<struct<doc_id:long, tf:long>>"
        j = spark.read.schema(schema).json(path)
    else:
        v = spark.read.text(path).filter(F.col("value").startswith("| ") & ~F.col("value").startswith("| Term"))
        cells = F.split(F.col("value"), r" \| ")
        pairs = F.regexp_extract_all(cells[2], F.lit(r"\((\d+), (\d+)\)"), 0)
        j = v.select(F.regexp_replace(cells[0], r"^\| ", "").alias("token"), F.transform(
            pairs, lambda p: F.struct(F.regexp_extract(p, r"\((\d+),", 1).cast("long").alias("doc_id"),
                                      F.regexp_extract(p, r", (\d+)\)", 1).cast("long").alias("tf"))).alias(
            "postings"))
    return j.select("token", F.explode("postings").alias("p")).select("token", "p.doc_id", "p.tf")


# --------------------------------------------------------------------------- S11 / S12 / S14
def write_tokens(tokens: DataFrame, path: str) -> None:
    """One token per line."""
    tokens.select(F.col("token").alias("value")).write.mode("overwrite").text(path)


def write_profiles(profiles: DataFrame, path: str, buckets: int = 16) -> None:
    """Nested JSON documents keyed by sha256(url), partitioned by a hash bucket."""
    out = profiles.withColumn("url_hash", X.url_hash("url")).withColumn(
        "bucket", F.substring("url_hash", 1, 2))
    out.write.mode("overwrite").partitionBy("bucket").json(path)


def read_nested(spark: SparkSession, path: str, field: str, schema: str) -> DataFrame:
    """``{"<field>": [ {...}, ... ]}`` documents, one row per element."""
    doc = spark.read.schema(f"`{field}` array<struct<{schema}>>").option("multiLine", True).json(path)
    return doc.selectExpr(f"inline(`{field}`)")


# --------------------------------------------------------------------------- S13
def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Labelled image folders ``<root>/<label>/<file>``; class from the folder.
    Output: path, label, height, width, channels, data (decoded by Spark's image source); a file that
    is no image stays, with height and width -1."""
    img = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(root)
    return img.select(F.col("image.origin").alias("path"),
                      F.regexp_extract("image.origin", r"([^/]+)/[^/]+$", 1).alias("label"),
                      F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                      F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


def image_pixels(images: DataFrame, flip: bool = False, size: tuple[int, int] | None = None) -> DataFrame:
    """Pixels rescaled by 1/255 as ARRAY<FLOAT> (row-major, BGR as decoded), optionally brought to ``size`` (height, width;
    nearest pixel) and mirrored left-right; one pass per Arrow batch. A file that is no image has null pixels."""

    def to_pixels(data: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.Series:
        out = []
        for d, hh, ww, cc in zip(data, h, w, c):
            if d is None or not (hh > 0 and ww > 0 and cc > 0):
                out.append(None)
                continue
            a = np.frombuffer(d, dtype=np.uint8).reshape(int(hh), int(ww), int(cc)).astype(np.float32) / 255.0
            if size:
                rows = (2 * np.arange(size[0]) + 1) * int(hh) // (2 * size[0])
                columns = (2 * np.arange(size[1]) + 1) * int(ww) // (2 * size[1])
                a = a[rows][:, columns]
            if flip:
                a = a[:, ::-1, :]
            out.append(a.reshape(-1))
        return pd.Series(out)

    udf = F.pandas_udf(to_pixels, "array<float>")
    return images.withColumn("pixels", udf("data", "height", "width", "channels"))
