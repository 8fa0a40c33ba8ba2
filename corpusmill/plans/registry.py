"""Registered queries: name -> (spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame over the whole given
tables. Column names equal the oracle's; integers are BIGINT and floating
results are rounded to 6 places on both sides so values hash alike.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from corpusmill.plans import (  # noqa: F401
        feature_queries,
        graph_queries,
        html_queries,
        ml_queries,
        stats_queries,
        sequence_queries,
        text_queries,
    )
