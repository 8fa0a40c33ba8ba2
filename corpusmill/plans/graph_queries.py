"""Link-graph queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.operators import graph as G
from corpusmill.plans.registry import register
from corpusmill.sources.tables import table

EDGES_SQL = """SELECT src, dst FROM (SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey) AS dst FROM lineitem) WHERE dst IS NOT NULL"""
PR_DIGITS = 10


def _graph(spark, sf):
    edges = G.edges_from_lines(table(spark, sf, "lineitem"))
    nodes = table(spark, sf, "part").select(F.col("p_partkey").alias("node"))
    return edges, nodes


def _pagerank_sql(iters: int, lam: float = 0.25, final: str = "SELECT node, round(pr, {d}) AS pr FROM r{k}") -> str:
    ctes = [f"e AS ({EDGES_SQL})", "l AS (SELECT DISTINCT src, dst FROM e)",
            "o AS (SELECT src, count(*) AS out FROM l GROUP BY src)",
            "nodes AS (SELECT p_partkey AS node FROM part)",
            "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)",
            "r0 AS (SELECT node, 1.0e0 / (SELECT n FROM nn) AS pr FROM nodes)"]
    for k in range(1, iters + 1):
        ctes.append(
            f"r{k} AS (SELECT nodes.node, {lam}e0 / (SELECT n FROM nn) + {1 - lam}e0 * coalesce(s.s, 0.0e0) AS pr "
            f"FROM nodes LEFT JOIN (SELECT l.dst AS node, sum(r.pr / o.out) AS s FROM l JOIN o USING (src) "
            f"JOIN r{k - 1} r ON r.node = l.src GROUP BY l.dst) s USING (node))")
    return "WITH " + ",\n".join(ctes) + "\n" + final.format(d=PR_DIGITS, k=iters)


@register(
    "degrees",
    f"""WITH e AS ({EDGES_SQL}), nodes AS (SELECT p_partkey AS node FROM part),
    o AS (SELECT src AS node, count(*) AS out_degree FROM e GROUP BY src),
    i AS (SELECT dst AS node, count(DISTINCT src) AS in_links FROM e GROUP BY dst)
    SELECT node, coalesce(out_degree, 0) AS out_degree, coalesce(in_links, 0) AS in_links
    FROM nodes LEFT JOIN o USING (node) LEFT JOIN i USING (node)""",
)
def q_degrees(spark, sf):
    edges, nodes = _graph(spark, sf)
    return G.degrees(edges, nodes)


@register("pagerank_k", _pagerank_sql(3))
def q_pagerank_k(spark, sf):
    edges, nodes = _graph(spark, sf)
    r = G.pagerank(edges, nodes, lam=0.25, max_iter=3).ranks
    return r.select("node", F.round("pr", PR_DIGITS).alias("pr"))


@register(
    "pagerank_lookup",
    _pagerank_sql(20, final="SELECT node, round(pr, {d}) AS pr FROM r{k} WHERE node IN "
                            "(SELECT p_partkey FROM part WHERE p_brand = 'Brand#13')"),
)
def q_pagerank_lookup(spark, sf):
    edges, nodes = _graph(spark, sf)
    r = G.pagerank(edges, nodes, lam=0.25, max_iter=20).ranks
    ids = table(spark, sf, "part").filter(F.col("p_brand") == "Brand#13").select(F.col("p_partkey").alias("node"))
    return G.lookup(r, ids).select("node", F.round("pr", PR_DIGITS).alias("pr"))


def _bipartite_sql(iters: int) -> str:
    ctes = ["l AS (SELECT DISTINCT 'L:' || CAST(l_suppkey AS VARCHAR) AS a, 'R:' || CAST(l_partkey AS VARCHAR) AS b FROM lineitem)",
            "e AS (SELECT a AS src, b AS dst FROM l UNION ALL SELECT b, a FROM l)",
            "o AS (SELECT src, count(*) AS out FROM e GROUP BY src)",
            "r0 AS (SELECT src AS node, 1.0e0 / (SELECT count(*) FROM o) AS pr FROM o)"]
    for k in range(1, iters + 1):
        ctes.append(f"r{k} AS MATERIALIZED (SELECT e.dst AS node, sum(r.pr / o.out) AS pr FROM e JOIN o USING (src) "
                    f"JOIN r{k - 1} r ON r.node = e.src GROUP BY e.dst)")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT node, round(pr, {PR_DIGITS}) AS pr FROM r{iters}"


@register("bipartite_rank", _bipartite_sql(20))
def q_bipartite_rank(spark, sf):
    pairs = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey")
    return G.bipartite_rank(pairs, "l_suppkey", "l_partkey", iters=20).select(
        "node", F.round("pr", PR_DIGITS).alias("pr"))
