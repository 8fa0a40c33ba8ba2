"""Documents to packed training sequences: toxicity, exact dedup, near-dedup, packing.

Each stage works on all rows its predecessor kept. ``run`` writes every stage's result
into the shared folder and reads it again.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.common import discard, read, stored
from corpusmill.llm.exact_dedup import drop_exact_duplicates
from corpusmill.llm.near_dedup import drop_near_duplicates
from corpusmill.llm.packing import pack_documents
from corpusmill.llm.queries import END_ID, WORD_BPE
from corpusmill.llm.toxicity import drop_toxic
from corpusmill.session import ship_package


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    ship_package(spark)
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    ship_package(spark)
    return drop_near_duplicates(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    ship_package(spark)
    return pack_documents(docs, public_tokenizers.path(WORD_BPE), END_ID)


STAGES = [("toxicity", clean), ("exact_dedup", exact), ("near_dedup", near), ("packing", packed)]

#: Trained scores and packed sequences have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        done = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(docs)
        docs = done
    return docs
