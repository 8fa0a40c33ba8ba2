"""Metrics, features, page spans, similarity joins and models: goldens, brute force, invariants."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import cluster as C
from corpusmill.operators import features as FE
from corpusmill.operators import html as H
from corpusmill.operators import paragraphs as PG
from corpusmill.operators import stats as ST
from tests.conftest import SF01


def _pairs(spark, y, c):
    return spark.createDataFrame(list(zip(y, c)), "y long, c long")


@pytest.mark.parametrize("y,c,ari,comp,ami", [
    ([0, 0, 1, 1], [0, 0, 1, 2], 0.571429, 0.666667, 0.571429),
    ([0, 0, 0, 1, 1, 1, 2, 2], [0, 0, 1, 1, 1, 2, 2, 2], 0.238095, 0.558873, 0.319673),
])
def test_cluster_metric_goldens(spark, y, c, ari, comp, ami):
    df = _pairs(spark, y, c)
    assert ST.ari(df, "y", "c").first()[0] == pytest.approx(ari, abs=1e-6)
    assert ST.completeness(df, "y", "c").first()[0] == pytest.approx(comp, abs=1e-6)
    assert ST.ami(df, "y", "c").first()[0] == pytest.approx(ami, abs=1e-6)


def test_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice("abc"), float(rnd.randint(0, 40))) for _ in range(777)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.q): r.quantile for r in ST.quantiles(df, "x", [0.1, 0.25, 0.5, 0.9], ["g"]).collect()}
    for g in "abc":
        xs = np.array([x for gg, x in rows if gg == g])
        for q in (0.1, 0.25, 0.5, 0.9):
            assert got[(g, q)] == pytest.approx(float(np.quantile(xs, q)))
    glob = {r.q: r.quantile for r in ST.quantiles(df, "x", [0.25, 0.75]).collect()}
    allx = np.array([x for _, x in rows])
    assert glob[0.25] == pytest.approx(float(np.quantile(allx, 0.25)))
    assert glob[0.75] == pytest.approx(float(np.quantile(allx, 0.75)))


def test_prf_binary_pos_label(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (0, 0)], "y int, p int")
    r = ST.prf(df, average="binary", pos_label=0).first()
    assert (r.precision, r.recall) == (1.0, pytest.approx(2 / 3))


def test_confusion_is_dense(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "y string, p string")
    cm = ST.confusion(df)
    assert cm.count() == 9 and cm.agg(F.sum("n")).first()[0] == 3


def test_resampling_goldens(spark):
    lab = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "quality")
    over = dict(FE.oversample(lab, "quality", "doc_id").groupBy("quality").count().collect())
    under = dict(FE.undersample(lab, "quality", "doc_id").groupBy("quality").count().collect())
    assert over == {0: 341, 1: 341} and under == {0: 58, 1: 58}


def test_split_is_partition_independent(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r.k for r in FE.split(df, "k").filter("is_train").collect()}
    b = {r.k for r in FE.split(df.repartition(7), "k").filter("is_train").collect()}
    assert a == b and 700 < len(a) < 900


def _html_of(bits: str) -> str:
    return "".join("<b>" if c == "1" else " w " for c in bits)


def _brute_span(bits: str):
    n = len(bits)

    def f(i, j):
        return bits[:i].count("1") + bits[i:j].count("0") + bits[j:].count("1")

    best = (f(0, 1), 0, 1)
    for i in range(n):
        for j in range(i + 1, n):
            v = f(i, j)
            if v > best[0]:
                best = (v, i, j)
    return best


@pytest.mark.parametrize("bits,expected", [("1100010111", (9, 2, 5)), ("0011", (4, 0, 2)), ("10010001", (7, 1, 7)),
                                           ("1111", (3, 0, 1)), ("0000", (3, 0, 3))])
def test_main_content_goldens(spark, bits, expected):
    df = spark.createDataFrame([(0, _html_of(bits))], "page_id long, html string")
    r = H.main_content(df).first()
    assert (r.f, r.i, r.j) == expected


def test_main_content_brute_force(spark):
    rnd = random.Random(9)
    pages = ["".join(rnd.choice("01") for _ in range(rnd.randint(2, 40))) for _ in range(60)]
    df = spark.createDataFrame([(i, _html_of(b)) for i, b in enumerate(pages)], "page_id long, html string")
    got = {r.page_id: (r.f, r.i, r.j, r.len) for r in H.main_content(df).collect()}
    for i, b in enumerate(pages):
        f, bi, bj = _brute_span(b)
        assert got[i][:3] == (f, bi, bj)
        assert got[i][3] == b[bi:bj].count("0")


def test_block_classes(spark):
    good = "<p>" + " ".join(["the cat is on the mat and it is not in the house"] * 20) + "</p>"
    bad = "<div><a href='/x'>link one</a> <a href='/y'>link two</a></div>"
    df = spark.createDataFrame([(0, "<html><body>" + bad + good + bad + "</body></html>")], "page_id long, html string")
    cls = [r["class"] for r in PG.classified_blocks(df).orderBy("block").collect()]
    assert cls == ["bad", "good", "bad"]


def test_knn_matches_numpy(spark):
    rnd = np.random.default_rng(1)
    base = rnd.normal(size=(300, 8))
    qs = rnd.normal(size=(40, 8))
    b = spark.createDataFrame([(i, base[i].tolist()) for i in range(300)], "bid long, vec array<double>")
    q = spark.createDataFrame([(i, qs[i].tolist()) for i in range(40)], "qid long, vec array<double>")
    got = {}
    for r in C.knn(q, b, 5).collect():
        got.setdefault(r.qid, []).append((r.rank, r.bid))
    for i in range(40):
        d = np.sqrt(((base - qs[i]) ** 2).sum(axis=1))
        order = sorted(range(300), key=lambda j: (round(float(d[j]), 9), j))[:5]
        assert [bid for _, bid in sorted(got[i])] == order


def test_eps_pairs_and_dbscan_brute_force(spark):
    rnd = np.random.default_rng(2)
    centers = rnd.normal(size=(3, 6)) * 4
    pts = np.vstack([c + rnd.normal(scale=0.3, size=(25, 6)) for c in centers] + [rnd.normal(size=(5, 6)) * 8])
    df = spark.createDataFrame([(i, pts[i].tolist()) for i in range(len(pts))], "id long, v array<double>")
    got = {(r.a, r.b) for r in C.eps_pairs(df, "id", "v", 0.95).collect()}
    u = pts / np.linalg.norm(pts, axis=1, keepdims=True)
    exp = {(i, j) for i, j in itertools.combinations(range(len(pts)), 2) if round(float(u[i] @ u[j]), 6) >= 0.95}
    assert got == exp
    db = {r.id: r.cluster for r in C.dbscan(df, "id", "v", 0.95, 5).collect()}
    # brute-force DBSCAN with the same tie rules
    nb = {i: {j for j in range(len(pts)) if j != i and (min(i, j), max(i, j)) in exp} for i in range(len(pts))}
    core = {i for i in nb if len(nb[i]) + 1 >= 5}
    lab = {i: i for i in core}
    changed = True
    while changed:
        changed = False
        for i in core:
            m = min([lab[i]] + [lab[j] for j in nb[i] if j in core])
            if m < lab[i]:
                lab[i], changed = m, True
    for i in range(len(pts)):
        if i in core:
            assert db[i] == lab[i]
        else:
            cs = [lab[j] for j in nb[i] if j in core]
            assert db[i] == (min(cs) if cs else -1)


def test_text_model_invariants(spark):
    from corpusmill.plans.ml_queries import q_calibrated, q_nb_complement

    p = q_nb_complement(spark, SF01)
    assert p.count() > 0 and {r.prediction for r in p.select("prediction").distinct().collect()} <= {0.0, 1.0, 2.0,
                                                                                                      3.0}
    cal = q_calibrated(spark, SF01).select("prob_sum").collect()
    assert all(abs(r.prob_sum - 1.0) < 1e-9 for r in cal)


def test_rbf_svm_separable(spark):
    from pyspark.ml.classification import LinearSVC

    from corpusmill.operators import models as M

    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(400, 2))
    y = (np.linalg.norm(x, axis=1) < 1.0).astype(float)  # a ring: not linearly separable
    df = spark.createDataFrame([(x[i].tolist(), float(y[i])) for i in range(400)], "features array<double>, label double")
    z = M.rbf_features(df, "features", dim=200, gamma=1.0, n_in=2)
    acc = LinearSVC(regParam=1e-4, maxIter=100).fit(z).transform(z).select(
        F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc > max(y.mean(), 1 - y.mean()) + 0.05


def test_sentiment_rules(spark):
    from corpusmill.operators import sentiment as SE

    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, valence double")
    df = spark.createDataFrame([(0, "good"), (1, "not good"), (2, "very good"), (3, "not at all bad"),
                                (4, "nothing here"), (5, "")], "id long, text string")
    got = {r.id: r.compound for r in SE.sentiment(df, "text", lex).collect()}

    def norm(s):
        return s / math.sqrt(s * s + 15)

    assert got[0] == pytest.approx(norm(1.9))
    assert got[1] == pytest.approx(norm(1.9 * -0.74))
    assert got[2] == pytest.approx(norm(1.9 + 0.293))
    assert got[3] == pytest.approx(norm(-2.5 * -0.74))
    assert got[4] == 0.0 and got[5] == 0.0


PROFILE_HTML = """<html><body>
<img alt="x" id="gsc_prf_pup-img" src="https://img/p.jpg">
<div id="gsc_prf_in">Ada Lovelace</div>
<div class="gsc_prf_il">Professor of <b>Computing</b></div>
<div class="gsc_prf_il"><a class="gsc_prf_ila" href="/u">Analytical U</a></div>
<div class="gsc_prf_il" id="gsc_prf_int"><a class="gs_ibl" href="/k1">engines</a><a class="gs_ibl">notes</a></div>
<table id="gsc_rsb_st"><thead><tr><th></th><th>All</th><th>Since 2018</th></tr></thead><tbody>
<tr><td class="gsc_rsb_sc1">Citations</td><td class="gsc_rsb_std">120</td><td class="gsc_rsb_std">80</td></tr>
<tr><td>h-index</td><td>5</td><td>4</td></tr><tr><td>i10-index</td><td>3</td><td>2</td></tr></tbody></table>
<ul class="gsc_rsb_a"><li><span class="gsc_rsb_a_desc"><a href="/c1">Charles B</a><span class="gsc_rsb_a_ext">Engine U</span></span></li>
<li><span class="gsc_rsb_a_desc"><a href="/c2">Mary S</a><span class="gsc_rsb_a_ext">Math U</span></span></li></ul>
<table><tbody id="gsc_a_b"><tr class="gsc_a_tr"><td class="gsc_a_t"><a class="gsc_a_at" href="/p1">Notes on the engine</a>
<div class="gs_gray">A Lovelace</div><div class="gs_gray">Journal X, 1843</div></td>
<td class="gsc_a_c"><a href="/cites">42</a></td><td class="gsc_a_y"><span class="gsc_a_h">1843</span></td></tr>
</tbody></table></body></html>"""


def test_extract_profiles(spark):
    df = spark.createDataFrame([("https://scholar/x", PROFILE_HTML)], "url string, html string")
    r = H.extract_profiles(df).first()
    assert r.researcher_name == "Ada Lovelace" and r.researcher_caption == "Professor of Computing"
    assert r.researcher_institution == "Analytical U" and r.researcher_keywords == "engines,notes"
    assert r.researcher_imgURL == "https://img/p.jpg"
    assert (r.researcher_citations["all"], r.researcher_citations["since2018"]) == ("120", "80")
    assert (r.researcher_hindex["all"], r.researcher_i10index["since2018"]) == ("5", "2")
    assert [(c.coauthor_name, c.coauthor_title, c.coauthor_link) for c in r.researcher_coauthors] == [
        ("Charles B", "Engine U", "/c1"), ("Mary S", "Math U", "/c2")]
    p = r.researcher_papers[0]
    assert (p.paper_title, p.paper_authors, p.paper_journal, p.paper_citedby, p.paper_year) == (
        "Notes on the engine", "A Lovelace", "Journal X, 1843", "42", "1843")
