"""Scans of the driver tables (Parquet, one file per table)."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core.

    A file written as one row group is read by one task; the row-level work that
    follows (regexes, tokenising, HTML) would then run on one core. When the scan
    has fewer partitions than the default parallelism, rows are spread
    round-robin; a scan of many splits passes unchanged, on any file system.
    """
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name}")
    return spread(spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet")))


def read_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages (url + raw HTML) replace live fetching."""
    return table(spark, sf_dir, "pages").select("page_id", "url", "html")
