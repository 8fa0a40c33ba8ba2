"""Structured Streaming re-aims of the crawl/append loop.

R1: stored pages arriving as files -> each URL once (keyed state with a time to live) -> per micro-batch: the
pages, doc map rows with dense ids, and postings, written under ``batch_id=<n>`` with dynamic partition
overwrite, so a replayed batch rewrites its own output and nothing else (idempotent sink).
R2: running unigram counts as a stateful aggregation; each batch writes the counts that changed.
"""
from __future__ import annotations

import os
from contextlib import contextmanager
from typing import Any, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from corpusmill.functions import text as X
from corpusmill.operators import text as TX
from corpusmill.operators.ordered import dense_id

PAGE_SCHEMA = "page_id long, url string, html string"
DOC_SCHEMA = "doc_id long, text string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How long a URL stays known after it was seen.
SEEN_MS = 30 * 24 * 3600 * 1000


def page_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    return spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def _page_text(html):
    return F.regexp_replace(html, "<[^>]*>", " ")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its own file system (with or without a scheme); errors are raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@contextmanager
def _settings(spark: SparkSession, **wanted: str):
    """Session settings for as long as a query starts; it keeps those that it started with."""
    old = {k.replace("__", "."): spark.conf.get(k.replace("__", "."), None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k.replace("__", "."), v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


class FirstSeen(StatefulProcessor):
    """Passes the row of smallest ``page_id`` of a key that is not known yet (nulls last), and keeps the key for a while."""

    def __init__(self, ttl_ms: int) -> None:
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "at boolean", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = self.seen.exists()
        best = None
        for part in rows:
            if known or not len(part):
                continue
            row = part.sort_values(["page_id", "html"], na_position="last", kind="stable").head(1)
            best = row if best is None else pd.concat([best, row]).sort_values(["page_id", "html"], na_position="last", kind="stable").head(1)
        if best is not None:
            self.seen.update((True,))
            yield best[["url_hash", "page_id", "url", "html"]]

    def close(self) -> None:
        pass


def first_seen(pages: DataFrame, ttl_ms: int = SEEN_MS) -> DataFrame:
    """The pages of a stream whose URL was not seen within ``ttl_ms`` (counted from the first sight). Copies of a URL in
    one batch give one page; a page without URL goes."""
    keyed = pages.filter("url IS NOT NULL").select(X.url_hash("url").alias("url_hash"), "page_id", "url", "html")
    return keyed.groupBy("url_hash").transformWithStateInPandas(
        FirstSeen(ttl_ms), "url_hash string, page_id long, url string, html string", "Update", "processingTime")


def intake_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """One micro-batch of R1: ids continue after every earlier batch's doc map. The batch is stored first, so its state is
    worked out once."""
    spark = batch.sparkSession
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    map_path = os.path.join(out, "doc_map")
    offset = 0
    if _exists(spark, map_path):
        last = spark.read.parquet(map_path).filter(F.col("batch_id") < batch_id).agg(F.max("doc_id")).first()[0]
        offset = 0 if last is None else last + 1
    pages_path = os.path.join(out, "pages", f"batch_id={batch_id}")
    batch.select("url", "html").write.mode("overwrite").parquet(pages_path)
    pages = spark.read.schema("url string, html string").parquet(pages_path)
    # only the URLs are ordered and numbered; the pages join their number
    ids = dense_id(pages.select("url").distinct(), ["url"], out="local_id").withColumn("doc_id", F.col("local_id") + F.lit(offset))
    docs = pages.join(ids, "url").select("doc_id", "url", X.url_hash("url").alias("url_hash"), "html")
    docs.select("doc_id", "url", "url_hash", F.lit(batch_id).alias("batch_id")).write.mode("overwrite").partitionBy(
        "batch_id").parquet(map_path)
    text = docs.select("doc_id", _page_text(F.col("html")).alias("text"))
    post = TX.postings(TX.tokenize(text, stops=TX.stop_words_df(spark)))
    post.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").partitionBy("batch_id").parquet(
        os.path.join(out, "postings"))


def start_intake(spark: SparkSession, src: str, out: str, checkpoint: str, available_now: bool = True,
                 max_files: int = 1, ttl_ms: int = SEEN_MS) -> StreamingQuery:
    """Pages stream, each URL once within ``ttl_ms``, into pages, doc map and postings under ``out``."""
    w = first_seen(page_stream(spark, src, max_files), ttl_ms).writeStream.outputMode("update").foreachBatch(
        lambda df, bid: intake_batch(df, bid, out)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    # without empty batches: what has expired goes with the next pages, and a run over what is there comes to its end
    with _settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB,
                   spark__sql__streaming__noDataMicroBatches__enabled="false"):
        return w.start()


def running_unigrams(spark: SparkSession, src: str, max_files: int = 1) -> DataFrame:
    """R2: streaming token counts (stateful aggregation, one row of state a token; emit in update mode)."""
    docs = spark.readStream.schema(DOC_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(src)
    return TX.unigram_counts(TX.tokenize(docs))


def counts_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """The counts that a micro-batch changed, under ``batch_id=<n>``; a replayed batch writes its own folder again."""
    batch.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))


def start_running_unigrams(spark: SparkSession, src: str, out: str, checkpoint: str, available_now: bool = True,
                           max_files: int = 1) -> StreamingQuery:
    """R2 into files below ``out``; ``current_unigrams`` reads the counts."""
    w = running_unigrams(spark, src, max_files).writeStream.outputMode("update").foreachBatch(
        lambda df, bid: counts_batch(df, bid, out)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    with _settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        return w.start()


def current_unigrams(spark: SparkSession, out: str) -> DataFrame:
    """The newest count of each token."""
    return spark.read.schema("token string, n long, batch_id long").parquet(out).groupBy("token").agg(
        F.max_by("n", "batch_id").alias("n"))
