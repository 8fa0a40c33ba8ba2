"""Cases beyond the given tables: null keys, large domains, long chains, odd links, dates and bytes."""
import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import cluster as C
from corpusmill.operators import features as FE
from corpusmill.operators import html as H
from corpusmill.operators import paragraphs as PG
from corpusmill.operators import models as M
from corpusmill.operators import ordered as O
from corpusmill.operators import stats as ST
from corpusmill.operators import text as TX


def one(spark, col, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(col.alias("x")).first().x


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, None, 4.0), (4, "b", None)], "id long, k string, v double")
    assert {r.id: r.k_code for r in FE.label_encode(df, "k").collect()} == {1: 1, 2: 0, 3: 0, 4: 2}
    assert FE.stratified_folds(df, "k", "id", 2).count() == 4
    assert sum(r.n for r in ST.histogram(df.filter("v is not null"), "v", 2, ["k"]).collect()) == 3
    assert {r.k for r in ST.boxplot(df, "v", ["k"]).collect()} == {"a", None}
    assert sorted((r.k, r.quantile) for r in ST.quantiles(df, "v", [0.5], ["k"]).collect() if r.k is None) == [(None, 3.0)]
    assert FE.drop_all_zero(spark.createDataFrame([(1, None), (0, None)], "a int, b int"), ["a", "b"]).count() == 1
    assert {r.k: r["count"] for r in FE.oversample(df, "k", "id").groupBy("k").count().collect()} == {"a": 2, "b": 2, None: 2}
    assert {r.k: r["count"] for r in FE.undersample(df, "k", "id").groupBy("k").count().collect()} == {"a": 1, "b": 1, None: 1}


def test_one_hot_of_many_values(spark):
    df = spark.range(1500).select("id", F.concat(F.lit("c"), "id").alias("c"))
    assert len(FE.one_hot(df, "c").columns) == 1502
    assert FE.one_hot_long(df, "id", "c").agg(F.count_distinct("value"), F.sum("hot")).first()[:] == (1500, 1500)


def test_terms_beyond_the_old_slots(spark):
    df = spark.range(40).select(F.array_join(F.transform(F.sequence(F.col("id") * 2000, F.col("id") * 2000 + 1999), lambda i: F.concat(F.lit("word"), i)), " ").alias("text"))
    row = M.term_slots(df).first()
    assert row.terms == 80_000 and row.slots > 1 << 15
    wide = M.term_slots(df, n_features=1 << 22).first()
    assert wide.shared < row.shared


def test_a_fifth_class(spark):
    df = spark.createDataFrame([(i, "abcde"[i % 5], f"only{i % 5} word") for i in range(50)], "id long, lang string, text string")
    df = M.index_labels(df, "lang")
    assert M.class_names(df) == list("abcde")
    from pyspark.ml import Pipeline

    model = Pipeline(stages=[*M.text_stages(n_features=64), M.classifier("linear_ovr", maxIter=5)]).fit(df)
    scored = model.transform(df)
    coefs, score = M.calibrate(scored, "label", n_classes=len(M.class_names(df)))
    assert len(coefs) == 5 and abs(sum(score(scored).first().probs) - 1) < 1e-9


def test_dbscan_long_chain(spark):
    angle = [0.05 * i for i in range(60)]
    df = spark.createDataFrame([(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in enumerate(angle)], "id long, v array<double>")
    got = C.dbscan(df, "id", "v", float(np.cos(0.06)), 3).collect()
    assert {r.cluster for r in got} == {1} or {r.cluster for r in got} == {0, 1}
    assert sum(r.core for r in got) == 58 and len({r.cluster for r in got}) == 1


def test_neighbours_on_ties_and_blocks(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(70, 6)).round(1)
    v[10:20] = v[3]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, vec array<double>")
    q, b = df.withColumnRenamed("id", "qid"), df.withColumnRenamed("id", "bid")
    got = {}
    for r in C.knn(q, b, 4, exclude_self=True, leaf=16).collect():
        got.setdefault(r.qid, {})[r["rank"]] = (r.dist, r.bid)
    d = np.round(np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1)), 9)
    for i in range(70):
        assert [got[i][k] for k in range(1, 5)] == sorted((d[i, j], j) for j in range(70) if j != i)[:4]
    pairs = {(r.a, r.b) for r in C.eps_pairs(df, "id", "vec", 0.7, leaf=16).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    assert pairs == {(i, j) for i in range(70) for j in range(i + 1, 70) if round(float(u[i] @ u[j]), 6) >= 0.7}


def test_hot_term_chunks_are_dealt_out(spark):
    post = spark.range(200).select(F.when(F.col("id") >= 0, "hot").otherwise("cold").alias("token"), F.col("id").alias("doc_id"), F.lit(1).cast("long").alias("tf"))
    nested = TX.index_nested(post, max_postings=20)
    rows = nested.collect()
    assert len(rows) > 5 and sum(len(r.postings.split(",")) for r in rows) == 200
    plan = nested._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(token#\d+L?, chunk#\d+L?, \d+\), REPARTITION_BY_COL", plan)


def test_links(spark):
    html = """<a data-href="BAD" href="ok">x</a><a class=c href='q'>y</a><a href=bare>z</a><abbr href="no">w</abbr>"""
    assert one(spark, X.page_links("h"), h=html) == ["ok", "q", "bare"]
    base = "http://h.org/d/e/p.html?q=1#f"
    want = {"mailto:a@b.c": "mailto:a@b.c", "../x": "http://h.org/d/x", "../../../x": "http://h.org/x", "./x/./y": "http://h.org/d/e/x/y",
            "/r/../s": "http://h.org/s", "//o.org/a": "http://o.org/a", "": "http://h.org/d/e/p.html?q=1", "#z": "http://h.org/d/e/p.html?q=1#z",
            "?k=2": "http://h.org/d/e/p.html?k=2", "a..b/c?x=../y": "http://h.org/d/e/a..b/c?x=../y", "..": "http://h.org/d/", "https://z/a/../b": "https://z/a/../b"}
    for link, url in want.items():
        assert one(spark, X.resolve_link(F.col("l"), F.col("b")), l=link, b=base) == url, link


def test_collect_reaches_depth_one(spark):
    pages = spark.createDataFrame([(1, "http://a/s/", '<a href="x">1</a><a href="/other">2</a>'), (2, "http://a/s/x", "t"), (3, "http://a/other", "u")], "page_id long, url string, html string")
    seeds = spark.createDataFrame([("news", "http://a/s/")], "topic string, url string")
    got = {(r.url, r.depth) for r in H.collect(seeds, pages, prefix="url").collect()}
    assert got == {("http://a/s/", 0), ("http://a/s/x", 1)}
    got = {(r.url, r.depth) for r in H.collect(seeds, pages, prefix="origin").collect()}
    assert got == {("http://a/s/", 0), ("http://a/s/x", 1), ("http://a/other", 1)}


@pytest.mark.parametrize("raw", ["2024-03-05T10:00:00+0000", "2024-03-05T10:00:00Z", "Tue, 05 Mar 2024 10:00:00 GMT", "5 Mar 2024 12:00:00 +0200", "2024-03-05 10:00:00"])
def test_published_dates(spark, raw):
    html = f'<meta property="article:published_time" content="{raw}">'
    assert one(spark, X.published_at("h"), h=html) == dt.datetime(2024, 3, 5, 10)


def test_accents(spark):
    assert one(spark, X.strip_accents("t"), t="ő ş ł ř Ç é ø") == "o s l r C e o"


def test_bad_bytes_do_not_fail_a_corpus(spark, tmp_path):
    from corpusmill.sources.files import read_dir_corpus

    for label, name, raw in (("a", "1", b"fine"), ("b", "2", b"caf\xe9 bad")):
        (tmp_path / label).mkdir()
        (tmp_path / label / name).write_bytes(raw)
    got = {r.label: (r.text, r.label_id) for r in read_dir_corpus(spark, str(tmp_path)).collect()}
    assert got == {"a": ("fine", 0), "b": ("caf� bad", 1)}


def test_intake_numbers_go_on(spark, tmp_path):
    from corpusmill.streaming.intake import intake_batch

    for b, urls in enumerate((["u0"], ["u2", "u1"], ["u3"])):
        intake_batch(spark.createDataFrame([(u, "<p>x</p>") for u in urls], "url string, html string"), b, str(tmp_path))
    got = {r.url: r.doc_id for r in spark.read.parquet(f"{tmp_path}/doc_map").collect()}
    assert got == {"u0": 0, "u1": 1, "u2": 2, "u3": 3}


def test_frames_run_from_the_end(spark):
    pages = spark.createDataFrame([(1, "<a>x<b>yy zz")], "page_id long, html string")
    for df in (H.surface_row_max(pages), PG.classified_blocks(pages)):
        assert "unboundedfollowing" not in df._jdf.queryExecution().optimizedPlan().toString().lower()


def test_merged_sequences_with_a_hot_value(spark):
    a = spark.range(300).select(F.lit(5).cast("long").alias("v"))
    got = [tuple(r) for r in O.merge_sorted(a, spark.createDataFrame([(1,), (9,)], "v long")).orderBy("pos").collect()]
    assert got == list(enumerate([1, *[5] * 300, 9]))
