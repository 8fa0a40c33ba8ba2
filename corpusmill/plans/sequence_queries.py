"""Ordered-sequence queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import ordered as O
from corpusmill.plans.registry import register
from corpusmill.sources.tables import table

EVENT_MICROS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"


def _events_us(spark, sf):
    return table(spark, sf, "events").select("user_id", F.expr(EVENT_MICROS).alias("us"))


# W2 (global) -----------------------------------------------------------------
@register(
    "max_gap_global",
    """WITH d AS (SELECT DISTINCT epoch_us(ts) AS v FROM events),
    g AS (SELECT lag(v) OVER (ORDER BY v) AS l, v AS r FROM d)
    SELECT r - l AS gap, l AS "left", r AS "right" FROM g WHERE l IS NOT NULL
    ORDER BY r - l DESC, l LIMIT 1""",
)
def q_max_gap_global(spark, sf):
    return O.max_gap(_events_us(spark, sf), "us").withColumn("gap", F.col("gap").cast("bigint"))


# W1 / N2 per key ---------------------------------------------------------------
@register(
    "max_gap_per_user",
    """WITH e AS (SELECT user_id, epoch_us(ts) AS v, count(*) AS n FROM events GROUP BY user_id, epoch_us(ts)),
    g AS (SELECT user_id, v, n, lag(v) OVER (PARTITION BY user_id ORDER BY v) AS l FROM e),
    r AS (SELECT user_id, v - l AS gap, l, v, row_number() OVER (PARTITION BY user_id ORDER BY v - l DESC NULLS LAST, l)
          AS rk, sum(n) OVER (PARTITION BY user_id) AS tot, min(v) OVER (PARTITION BY user_id) AS mn FROM g)
    SELECT user_id,
      CASE WHEN gap IS NULL AND tot >= 2 THEN 0 ELSE gap END AS gap,
      CASE WHEN gap IS NULL AND tot >= 2 THEN mn ELSE l END AS "left",
      CASE WHEN gap IS NULL AND tot >= 2 THEN mn WHEN gap IS NULL THEN NULL ELSE v END AS "right"
    FROM r WHERE rk = 1""",
)
def q_max_gap_per_user(spark, sf):
    return O.max_gap(_events_us(spark, sf), "us", by=["user_id"]).withColumn("gap", F.col("gap").cast("bigint"))


# N4 / J9 / A11 / W5 / U5 on table columns ---------------------------------------
@register(
    "distinct_products",
    """SELECT count(*) AS n, count(DISTINCT CAST(l_quantity AS BIGINT) * CAST(round(l_extendedprice * 100) AS BIGINT))
    AS distinct_products FROM lineitem""",
)
def q_distinct_products(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_quantity").cast("bigint").alias("a"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("b"))
    return O.distinct_products(li, "a", "b")


# P13 / A17 -----------------------------------------------------------------------
@register(
    "balanced_load",
    """WITH o AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
    i AS (SELECT cents, row_number() OVER (ORDER BY cents, o_orderkey) AS i, count(*) OVER () AS n FROM o)
    SELECT CAST(least(i, n + 1 - i) % 8 AS BIGINT) AS bucket, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) AS load
    FROM i GROUP BY 1""",
)
def q_balanced_load(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    return O.balanced_load(o, ["cents", "o_orderkey"], "cents", 8)


# P12 / W7 ------------------------------------------------------------------------
@register("block_split", "SELECT o_orderkey, ntile(8) OVER (ORDER BY o_orderkey) - 1 AS block FROM orders")
def q_block_split(spark, sf):
    return O.block_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 8)


# J7 / J8 -------------------------------------------------------------------------
ASOF_BASE = """WITH a AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS x FROM orders),
    b AS (SELECT CAST(round(l_extendedprice * 100) AS BIGINT) AS x FROM lineitem)"""


def _asof_inputs(spark, sf):
    a = table(spark, sf, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("x"))
    b = table(spark, sf, "lineitem").select(F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("x"))
    return a, b


# an as-of join of its own: ranks of the distinct right values, floor and ceiling by DuckDB's ASOF JOIN
ASOF_RANKS = """, r AS (SELECT x, count(*) AS n FROM b GROUP BY x),
    c AS (SELECT x, CAST(sum(n) OVER (ORDER BY x) AS BIGINT) AS upto, n FROM r)"""


@register(
    "asof_floor",
    ASOF_BASE + ASOF_RANKS + """ SELECT a.o_orderkey, a.x, coalesce(c.upto, 0) - 1 AS idx
    FROM a ASOF LEFT JOIN c ON a.x >= c.x""",
)
def q_asof_floor(spark, sf):
    a, b = _asof_inputs(spark, sf)
    return O.asof_index(a, b, "x", "floor").select("o_orderkey", "x", "idx")


@register(
    "asof_ceil",
    ASOF_BASE + ASOF_RANKS + """ SELECT a.o_orderkey, a.x, CAST(c.upto - c.n AS BIGINT) AS idx
    FROM a ASOF LEFT JOIN c ON a.x <= c.x""",
)
def q_asof_ceil(spark, sf):
    a, b = _asof_inputs(spark, sf)
    return O.asof_index(a, b, "x", "ceil").select("o_orderkey", "x", "idx")


# O6 / N3 -------------------------------------------------------------------------
@register(
    "sorted_merge",
    ASOF_BASE + """ SELECT row_number() OVER (ORDER BY x) - 1 AS pos, x AS v
    FROM (SELECT x FROM a UNION ALL SELECT x FROM b)""",
)
def q_sorted_merge(spark, sf):
    a, b = _asof_inputs(spark, sf)
    return O.merge_sorted(a.select("x"), b, "x")


# W6 ------------------------------------------------------------------------------
@register(
    "cumulative_hist",
    """SELECT bucket, n, CAST(sum(n) OVER (ORDER BY bucket) AS BIGINT) AS cum
    FROM (SELECT CAST(l_quantity AS BIGINT) AS bucket, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def q_cumulative_hist(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy(F.col("l_quantity").cast("bigint").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"))
    return O.prefix_sum(counts, ["bucket"], "n", "cum").select("bucket", "n", "cum")
