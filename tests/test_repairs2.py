"""Repaired answers, and search over impact-ordered blocks."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import ordered as O
from corpusmill.operators import stats as ST
from corpusmill.operators import text as TX
from corpusmill.sources.files import image_pixels, load_search_blocks, load_search_index, store_search_index


def test_histogram_leaves_out_nulls(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (4.0, "a"), (None, "a"), (None, "b"), (float("nan"), "a")], "x double, k string")
    assert sorted((r.bin, r.n) for r in ST.histogram(df, "x", 3).collect()) == [(0, 1), (1, 1), (2, 1)]
    assert sorted((r.k, r.bin, r.n) for r in ST.histogram(df, "x", 3, ["k"]).collect()) == [("a", 0, 1), ("a", 1, 1), ("a", 2, 1)]


def test_confusion_keeps_null_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, "b")], "y string, p string")
    got = {(r.y, r.p): r.n for r in ST.confusion(df).collect()}
    assert len(got) == 9 and sum(got.values()) == 3
    assert got["a", "a"] == got["a", None] == got[None, "b"] == 1


def test_gap_at_the_ends_of_bigint(spark):
    lo, hi = -(1 << 63), (1 << 63) - 1
    df = spark.createDataFrame([(lo, 1), (hi, 1), (5, 2), (7, 2)], "v long, k int")
    r = O.max_gap(df, "v").first()
    assert (int(r.gap), r.left, r.right) == (5 - lo, lo, 5)
    per = {r.k: (int(r.gap), r.left, r.right) for r in O.max_gap(df, "v", ["k"]).collect()}
    assert per == {1: (hi - lo, lo, hi), 2: (2, 5, 7)}


def test_pixels_of_bad_files_and_sizes(spark):
    flat = np.arange(2 * 4 * 3, dtype=np.uint8)
    df = spark.createDataFrame([("ok", 2, 4, 3, bytearray(flat)), ("bad", -1, -1, -1, bytearray()), ("none", 1, 1, 1, None)], "path string, height int, width int, channels int, data binary")
    got = {r.path: r.pixels for r in image_pixels(df).collect()}
    assert got["bad"] is None and got["none"] is None and np.allclose(got["ok"], flat / 255.0)
    small = {r.path: r.pixels for r in image_pixels(df, size=(1, 2)).collect()}
    a = flat.reshape(2, 4, 3) / 255.0
    assert np.allclose(np.array(small["ok"]).reshape(1, 2, 3), a[[1]][:, [1, 3]])
    large = {r.path: r.pixels for r in image_pixels(df, flip=True, size=(64, 64)).collect()}["ok"]
    assert np.allclose(np.array(large).reshape(64, 64, 3)[0, 0], a[0, 3]) and len(large) == 64 * 64 * 3


# ------------------------------------------------------------ block search
@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    rows = []
    for d in range(900):
        rows += [("hot", d, rng.choice([1, 1, 1, 2, 3])), (f"mid{d % 40}", d, rng.randrange(1, 4)), (f"rare{d % 333}", d, 1)]
    return spark.createDataFrame(rows, "token string, doc_id long, tf long").cache()


QUERIES = [(1, "hot"), (2, "hot mid3"), (3, "rare5 hot"), (4, "rare5"), (5, "mid1 mid2 rare7"), (6, "nothing xyzzy"), (7, ""), (8, None), (None, "mid9")]


def search_both(spark, corpus, path, docs, k):
    doc_map = docs.select("doc_id", F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("url"))
    store_search_index(corpus, doc_map, path)
    queries = spark.createDataFrame(QUERIES, "query_id long, text string")
    post, vocab, dm = load_search_index(spark, path)
    want = {(r.query_id, r["rank"]): (r.doc_id, r.url, r.term, r.tf) for r in TX.search(queries, post, dm, k=k, vocab=vocab).collect()}
    blocks, vocab, dm = load_search_blocks(spark, path)
    got = {(r.query_id, r["rank"]): (r.doc_id, r.url, r.term, r.tf) for r in TX.search_blocks(queries, blocks, vocab, dm, k=k).collect()}
    return want, got


@pytest.mark.parametrize("k", [1, 3, 200])
def test_blocks_give_the_same_hits(spark, corpus, tmp_path, k):
    want, got = search_both(spark, corpus, f"{tmp_path}/i", spark.range(900).withColumnRenamed("id", "doc_id"), k)
    assert got == want and len(want) >= 6


def test_documents_without_url_do_not_count(spark, corpus, tmp_path):
    want, got = search_both(spark, corpus, f"{tmp_path}/i", spark.range(100, 400).withColumnRenamed("id", "doc_id"), 3)
    assert got == want and all(100 <= d < 400 for d, *_ in got.values())


def test_blocks_of_a_hot_term_stay_unread(spark, corpus):
    blocks = TX.impact_blocks(corpus, block=32).cache()
    rows = sorted(blocks.filter("token = 'hot'").collect(), key=lambda r: r.no)
    flat = [(e.ntf, e.doc) for r in rows for e in r.entries]
    assert len(rows) >= 28 and flat == sorted(flat) and len(flat) == 900 and [r.lead for r in rows] == [True] + [False] * (len(rows) - 1)
    assert all((r.tf, r.first) == (-r.entries[0].ntf, r.entries[0].doc) and len(r.entries) <= 32 for r in rows)
    queries = spark.createDataFrame([(1, "hot"), (2, "hot rare5")], "query_id long, text string")
    doc_map = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("u").alias("url"))
    # entries are only reached through the blocks that a query still wants: poison all later blocks of the hot term
    poison = blocks.withColumn("entries", F.when((F.col("token") == "hot") & ~F.col("lead"), F.array(F.struct(F.lit(-99).cast("long").alias("ntf"), F.lit(-1).cast("long").alias("doc")))).otherwise(F.col("entries")))
    want = TX.search_blocks(queries, blocks, TX.vocabulary(corpus), doc_map).collect()
    got = TX.search_blocks(queries, poison, TX.vocabulary(corpus), doc_map).collect()
    assert sorted(got) == sorted(want) and len(got) == 6


# ------------------------------------------------------------ sentiment
def test_sentiment_joins_a_lexicon_of_any_size(spark):
    from corpusmill.operators import sentiment as SE

    many = spark.range(150_000).select(F.concat(F.lit("w"), "id").alias("word"), (F.col("id") % 5 - 2).cast("double").alias("valence"))
    odd = spark.createDataFrame([("good", 1.0), ("good", 3.0), (None, 1.0), ("bad", None)], "word string, valence double")
    lexicon = many.unionByName(odd)
    rows = [(1, "good"), (2, "very good, w149999"), (3, "not w4"), (4, None), (5, ""), (6, "bad unknown"), (7, "good"), (7, "good")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "id long, text string, word string, d int")
    got = sorted((r.id, round(r.compound, 9), r.word, r.d) for r in SE.sentiment(df, "text", lexicon).collect())
    raw = {1: 2.0, 2: 2 + 0.293 + 2.0, 3: 2 * -0.74, 4: 0, 5: 0, 6: 0, 7: 2.0}
    assert got == sorted((i, round(raw[i] / (raw[i] ** 2 + 15) ** 0.5, 9), "x", 1) for i, _ in rows)
    plan = SE.sentiment(df, "text", lexicon)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# ------------------------------------------------------------ hubs
def test_hub_edges_are_cut(spark):
    from corpusmill.operators import graph as G

    rows = [(0, i) for i in range(1, 4001)] + [(i, (i * 7) % 300) for i in range(1, 400)] + [(i, 0) for i in range(1, 3000, 3)]
    edges = spark.createDataFrame(rows, "src long, dst long")
    nodes = spark.range(4001).withColumnRenamed("id", "node")
    plain = {r.node: r.pr for r in G.pagerank(edges, nodes, max_iter=4).ranks.collect()}
    cut = {r.node: r.pr for r in G.pagerank(edges, nodes, max_iter=4, hub=200).ranks.collect()}
    assert plain.keys() == cut.keys() and max(abs(plain[k] - cut[k]) for k in plain) < 1e-15
    links = edges.distinct().join(edges.distinct().groupBy("src").agg(F.count(F.lit(1)).alias("out")), "src")
    dealt = G.CutEdges(links, 16, 200)
    sizes = [r["count"] for r in dealt.heavy.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) >= 8 and max(sizes) <= 5 * sorted(sizes)[len(sizes) // 2]
    assert dealt.light.filter("src = 0").isEmpty()
    dealt.release()
    both = spark.createDataFrame([(1, i) for i in range(500)] + [(i, i % 9) for i in range(2, 60)], "u long, v long")
    a = {r.node: r.pr for r in G.bipartite_rank(both, "u", "v", 3).collect()}
    b = {r.node: r.pr for r in G.bipartite_rank(both, "u", "v", 3, hub=50).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-15
