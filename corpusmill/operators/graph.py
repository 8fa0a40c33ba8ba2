"""Link-graph jobs: degrees, PageRank with the reference's update rule and stop
rules, lookups, bipartite rank (A12, A13, A15, G1-G4, J3, U6).

Each PageRank iteration is one join of the (pre-partitioned, cached) edge table
with the rank table on ``src`` plus one aggregation on ``dst``; the node table
is right-joined so nodes without in-links keep the teleport term. Lineage is cut
with a reliable checkpoint every few iterations. The driver holds only the loop
counter and one scalar per iteration for the stop rule.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.ordered import dense_id
from corpusmill.session import cut_lineage, stored


def edges_from_lines(lineitem: DataFrame) -> DataFrame:
    """Link graph derived from orders: each line item's part links to the part of the
    next line of the same order (order by line number, part, supplier)."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    e = lineitem.select(F.col("l_partkey").alias("src"), F.lead("l_partkey").over(w).alias("dst"))
    return e.filter(F.col("dst").isNotNull())


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """A12 (Q6): out-degree counting duplicate edges, in-links counted once per source."""
    out = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("out_degree"))
    inn = edges.groupBy(F.col("dst").alias("node")).agg(F.count_distinct("src").alias("in_links"))
    ids = nodes.select("node") if nodes is not None else out.select("node").union(inn.select("node")).distinct()
    return ids.join(out, "node", "left").join(inn, "node", "left").select(
        "node", F.coalesce("out_degree", F.lit(0)).cast("bigint").alias("out_degree"),
        F.coalesce("in_links", F.lit(0)).cast("bigint").alias("in_links"))


@dataclass
class PageRankResult:
    ranks: DataFrame          # node, pr
    iterations: int           # iterations run
    stopped_at: int | None    # first node meeting the threshold (stop rule), if any


#: Out-edges from which on a node's edges are cut into chunks, each with a copy of the node's rank.
HUB = 100_000


class CutEdges:
    """Edges (src, dst, out) dealt out once for all iterations: those of ordinary sources by source, so that rank tables
    partitioned alike need no shuffle; those of hubs by source and chunk (a hash of dst), so that no task holds a hub."""

    def __init__(self, adj: DataFrame, parts: int, hub: int = HUB) -> None:
        sizes = adj.groupBy("src").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hub)
        self.hubs = cut_lineage(sizes.select("src", F.ceil(F.col("n") / hub).alias("k")))
        self.heavy = None
        if not self.hubs.isEmpty():
            heavy = adj.join(self.hubs, "src").withColumn("chunk", F.pmod(F.xxhash64("dst"), F.col("k"))).drop("k")
            self.heavy = heavy.repartition(parts, "src", "chunk").sortWithinPartitions("src", "chunk").cache()
            adj = adj.join(self.hubs, "src", "left_anti")
        self.light = adj.repartition(parts, "src").sortWithinPartitions("src").cache()  # sorted once, not in each join

    def contributions(self, ranks: DataFrame) -> DataFrame:
        """(node, s): the sums of pr / out over in-links; partial sums of all chunks and tasks are merged."""
        ranks = ranks.select(F.col("node").alias("src"), "pr")
        share = (F.col("pr") / F.col("out")).alias("c")
        each = self.light.join(ranks, "src").select("dst", share)
        if self.heavy is not None:
            copies = self.hubs.join(ranks, "src").select("src", "pr", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("chunk"))
            each = each.unionByName(self.heavy.join(copies, ["src", "chunk"]).select("dst", share))
        return each.groupBy(F.col("dst").alias("node")).agg(F.sum("c").alias("s"))

    def release(self) -> None:
        for frame in (self.light, self.heavy):
            if frame is not None:
                frame.unpersist()


def pagerank(edges: DataFrame, nodes: DataFrame, lam: float = 0.25, max_iter: int = 20, thr: float = 0.0,
             dup: str = "distinct", stop: str = "any", checkpoint_every: int = 5, hub: int = HUB) -> PageRankResult:
    """pr' = lam / N + (1 - lam) * sum over in-links k of pr(k) / out(k),
    synchronous, start 1/N, no redistribution of dangling mass.

    ``dup='distinct'`` de-duplicates edges; ``dup='reference'`` keeps duplicates in
    the out-degree but counts each in-link once (Q6). ``stop='any'``: when some
    node moves by less than ``thr`` the iteration is finished and the loop stops
    (Q7); ``stop='all'`` waits for every node.
    """
    spark = edges.sparkSession
    nodes = nodes.select(F.col("node").cast("bigint").alias("node")).distinct()
    n = nodes.count()
    raw = edges.select(F.col("src").cast("bigint").alias("src"), F.col("dst").cast("bigint").alias("dst"))
    links = raw.distinct()
    if dup == "distinct":
        out = links.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
    elif dup == "reference":
        out = raw.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
    else:
        raise ValueError("dup must be 'distinct' or 'reference'")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Edge x out-degree, dealt out once and reused by every iteration
    adj = CutEdges(links.join(out, "src"), parts, hub)
    # nodes (and so every rank table) hash-partitioned like the edges: each
    # iteration then shuffles only the contributions
    nodes = nodes.repartition(parts, "node").sortWithinPartitions("node").cache()
    ranks = nodes.select("node", F.lit(1.0 / n).alias("pr"))
    stopped_at = None
    it = 0
    while it < max_iter:
        new = nodes.join(adj.contributions(ranks), "node", "left").select(
            "node", (F.lit(lam / n) + F.lit(1.0 - lam) * F.coalesce("s", F.lit(0.0))).alias("pr"))
        it += 1
        if (it % checkpoint_every) == 0:
            new = cut_lineage(new)
        if thr > 0:
            d = new.join(ranks.withColumnRenamed("pr", "old"), "node").select(
                "node", F.abs(F.col("pr") - F.col("old")).alias("d"))
            if stop == "any":
                hit = d.filter(F.col("d") < thr).agg(F.min("node")).first()[0]
                if hit is not None:
                    stopped_at = hit
                    ranks = new
                    break
            else:
                if d.filter(F.col("d") >= thr).limit(1).count() == 0:
                    ranks = new
                    break
        ranks = new
    # the result is lazy: materialise it before releasing the cached inputs it reads
    ranks = cut_lineage(ranks)
    adj.release()
    nodes.unpersist()
    return PageRankResult(ranks, it, stopped_at)


def lookup(ranks: DataFrame, ids: DataFrame) -> DataFrame:
    """Ranks of the requested nodes (semi join)."""
    return ranks.join(ids.select(F.col("node").cast("bigint").alias("node")), "node", "left_semi")


def bipartite_rank(pairs: DataFrame, left: str, right: str, iters: int = 20, hub: int = HUB) -> DataFrame:
    """JR(u) = sum over linked v of JR(v) / L(v) on a bipartite graph (both
    directions), no teleport, start 1/N over all vertices."""
    # vertices are numbers while ranks move, and are named at the end; a null one stays null
    named = stored(pairs.select(F.concat(F.lit("L:"), F.col(left).cast("string")).alias("a"),
                                F.concat(F.lit("R:"), F.col(right).cast("string")).alias("b")).distinct(), "pairs")
    names = named.select(F.explode(F.array("a", "b")).alias("name")).filter("name IS NOT NULL").distinct()
    names = stored(dense_id(names, ["name"], out="no"), "vertices")
    l_ = named.join(names.toDF("a", "ano"), "a", "left").join(names.toDF("b", "bno"), "b", "left").select(F.col("ano").alias("a"), F.col("bno").alias("b"))
    edges = l_.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(
        l_.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    deg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    verts = edges.select(F.col("src").alias("node")).distinct().repartition(parts, "node").sortWithinPartitions("node").cache()
    n = verts.count()
    adj = CutEdges(edges.join(deg, "src"), parts, hub)
    ranks = verts.select("node", F.lit(1.0 / n).alias("pr"))
    for it in range(1, iters + 1):
        ranks = verts.join(adj.contributions(ranks), "node", "left").select("node", F.coalesce("s", F.lit(0.0)).alias("pr"))
        if it % 5 == 0:
            ranks = cut_lineage(ranks)
    ranks = cut_lineage(ranks)
    adj.release()
    verts.unpersist()
    return ranks.join(names.toDF("name", "node"), "node", "left").select(F.col("name").alias("node"), "pr")
