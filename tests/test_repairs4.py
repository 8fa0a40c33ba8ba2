"""Steps that read or exchange rows once where they did so several times, and memory of one task that a group's size does not set."""
import numpy as np
import pytest

from corpusmill.operators import balltree
from corpusmill.operators import cluster as C
from corpusmill.operators import features as FE
from corpusmill.operators import graph as G
from corpusmill.operators import html as H
from corpusmill.operators import models as M
from corpusmill.operators import sentiment as SE
from corpusmill.operators import sparse as SP
from corpusmill.operators import stats as ST
from corpusmill.operators import text as TX


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stop_words_need_no_join(spark):
    docs = spark.createDataFrame([(1, "the apple the pear"), (1, "apple"), (2, None), (3, "the")], "doc_id long, text string")
    out = FE.term_counts(docs)
    assert "Join" not in _plan(out)
    assert sorted(out.collect()) == [(1, "apple", 2), (1, "pear", 1)]
    assert {r.term for r in FE.term_counts(docs, stops=()).collect()} == {"the", "apple", "pear"}


def test_unit_rows_come_from_one_weighing(spark):
    counts = spark.createDataFrame([(1, "a", 3), (1, "b", 4), (2, "a", 2), (None, "a", 1)], "doc_id long, term string, n long")
    out = FE.tfidf(counts)
    assert _plan(out).count("Join") == 1
    norm = {}
    for r in out.collect():
        norm[r.doc_id] = norm.get(r.doc_id, 0.0) + r.weight**2
    assert norm.keys() == {1, 2} and all(abs(v - 1) < 1e-12 for v in norm.values())


def test_confusion_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([("a", "b"), ("a", "a"), (None, "b")], "y string, p string").mapInArrow(look, "y string, p string")
    got = {(r.y, r.p): r.n for r in ST.confusion(rows).collect()}
    assert seen.value == 3
    assert len(got) == 9 and got["a", "b"] == got["a", "a"] == got[None, "b"] == 1 and sum(got.values()) == 3


def test_words_outside_the_lexicon_are_not_dealt_out(spark):
    docs = spark.createDataFrame([(1, "very good x y z"), (2, "x y"), (3, None), (1, "not good")], "doc_id long, text string")
    lex = spark.createDataFrame([("good", 2.0), ("good", 4.0)], "word string, valence double")
    out = SE.sentiment(docs, "text", lex)
    plan = _plan(out)
    counted = plan.index("count(1) AS n#") if "count(1) AS n#" in plan else plan.index("lift")
    assert plan.index("Join", counted) > counted  # the lexicon's join is below the count of uses
    got = sorted((r.doc_id, round(r.compound, 6)) for r in out.collect())
    s, t = 3.293, 3 * -0.74
    assert got == sorted([(1, round(s / (s * s + 15) ** 0.5, 6)), (1, round(t / (t * t + 15) ** 0.5, 6)), (2, 0.0), (3, 0.0)])


def test_vocabulary_is_counted_once_for_both_matches(spark):
    words = spark.createDataFrame([("apple",), ("appel",), ("zzz",)], "word string")
    post = spark.createDataFrame([("apple", 1, 1), ("apple", 2, 1), ("apply", 2, 1)], "token string, doc_id long, tf long")
    out = TX.resolve_terms(words, TX.vocabulary(post))
    assert "count(" not in _plan(out)
    assert sorted(out.collect()) == [("appel", "apple", "soundex"), ("apple", "apple", "exact")]


def test_rare_terms_need_no_chunk_hash(spark):
    post = spark.createDataFrame([("hot", d, 1) for d in range(7)] + [("rare", 3, 2)], "token string, doc_id long, tf long")
    out = TX.index_nested(post, max_postings=3)
    assert "CASE WHEN (df" in _plan(out)
    rows = {(r.token, r.chunk): r.postings for r in out.collect()}
    assert rows["rare", 0] == "3:2" and len([1 for t, _ in rows if t == "hot"]) > 1
    assert sorted(e for (t, _), p in rows.items() if t == "hot" for e in p.split(",")) == [f"{d}:1" for d in range(7)]


def test_surface_rows_are_folded_without_windows(spark):
    pages = spark.createDataFrame([(1, "<p>one two</p> three <b>"), (2, ""), (3, None), (4, "x"), (None, "a b <i> c")], "page_id long, html string")
    out = H.surface_row_max(pages)
    assert "Window" not in _plan(out)
    bits = {r.page_id: r.bits for r in pages.select("page_id", H.X.page_bits("html").alias("bits")).collect()}
    want = set()
    for k, b in bits.items():
        s = np.concatenate([[0], np.cumsum([1 if c == "0" else -1 for c in b or ""])])
        want |= {(k, i, (b.count("1") + max(s[i + 1:len(b)]) - s[i])) for i in range(len(b or "") - 1)}
    assert want and {tuple(r) for r in out.collect()} == want


def test_core_points_find_the_pairs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long").mapInArrow(look, "a long, b long")
    rows = spark.createDataFrame([(1,), (2,), (3,), (4,)], "id long")
    got = {r.id: r.core for r in C.core_points(rows, pairs, "id", 3).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False} and seen.value == 2


@pytest.mark.parametrize("block", [1, 3, 128])
def test_neighbours_do_not_depend_on_the_block(spark, monkeypatch, block):
    monkeypatch.setattr(balltree, "BLOCK", block)
    x = np.random.default_rng(5).normal(size=(40, 3))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    want = {(i, j) for i in range(40) for j in range(i + 1, 40) if round(float(u[i] @ u[j]), 6) >= 0.5}
    assert {(r.a, r.b) for r in C.eps_pairs(rows, "id", "vec", 0.5).collect()} == want
    near = C.knn(rows.withColumnRenamed("id", "qid"), rows.withColumnRenamed("id", "bid"), 2, exclude_self=True).collect()
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) + np.diag([np.inf] * 40)
    assert {(r.qid, r.rank): r.bid for r in near} == {(i, k + 1): int(np.argsort(dist[i])[k]) for i in range(40) for k in range(2)}


def test_ranks_move_between_numbers(spark):
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, None)], "l long, r long")
    got = {r.node: r.pr for r in G.bipartite_rank(pairs, "l", "r", iters=2).collect()}
    pr = {n: 1 / 5 for n in ("L:1", "L:2", "R:1", "R:2", None)}
    edges = [("L:1", "R:1"), ("L:1", "R:2"), ("L:2", "R:2"), ("L:2", None)]
    edges += [(b, a) for a, b in edges]
    out = {n: sum(s == n for s, _ in edges) for n in pr}
    for _ in range(2):
        pr = {n: sum(pr[s] / out[s] for s, d in edges if d == n and n is not None and s is not None) for n in pr}
    assert got.keys() == pr.keys() and all(abs(got[n] - pr[n]) < 1e-12 for n in pr)
    cut = G.CutEdges(spark.createDataFrame([(1, 2, 1)], "src long, dst long, out long"), 2)
    assert "Sort [src" in cut.light._jdf.logicalPlan().toString()
    cut.release()


def test_texts_are_cut_into_terms_once_for_all_folds(spark):
    docs = spark.createDataFrame([(i, "apple pear" if i % 2 else "stone sand", float(i % 2), i % 3) for i in range(12)], "doc_id long, text string, label double, fold int")
    rows, rest = M.prepared(docs, M.text_stages(), ["label", "fold"])
    assert rows.columns == ["label", "fold", "_tf"] and len(rest) == 2
    rows, rest = M.prepared(docs.withColumn("x", docs.label), M.tabular_stages(["x"]), ["label"])
    assert rows.columns == ["label", "features"] and not rest
    out = M.cross_validate(docs, M.text_stages(), M.classifier("complement"), k=3)
    assert "text" not in _plan(out).split() and [r.accuracy for r in out.collect()] == [1.0] * 3


def test_heads_end_where_the_rest_is_short(spark):
    rows = spark.createDataFrame([(1, [0, 1, 2], [0.6, 0.64, 0.48])], "rep long, ids array<long>, ws array<double>")
    out = SP.postings(rows, 0.79)
    assert "Join" not in _plan(out)
    assert sorted((r.id, round(r.rest, 6)) for r in out.collect()) == [(0, 0.8), (1, 0.48)]
