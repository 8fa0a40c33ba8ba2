"""One fold per page, and the weights of the text models."""
import math

from pyspark.ml import Pipeline

from corpusmill.operators import features as FE
from corpusmill.operators import html as H
from corpusmill.operators import models as M


def test_main_content_folds_a_page_once(spark):
    pages = spark.createDataFrame([(1, "<p>one two</p>"), (2, ""), (3, None), (4, "x")], "page_id long, html string")
    out = H.main_content(pages)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
    rows = {r.page_id: r for r in out.collect()}
    assert sorted(rows) == [1, 2, 3, 4] and rows[1].content == "one two"


def test_text_models_weigh_terms_as_tfidf_does(spark):
    texts = {1: "apple banana apple", 2: "banana cherry", 3: "cherry date banana"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    fitted = Pipeline(stages=M.text_stages(vocab=True)).fit(docs)
    words = fitted.stages[2].vocabulary
    got = {(r.doc_id, words[i]): v for r in fitted.transform(docs).collect() for i, v in zip(r.features.indices.tolist(), r.features.values.tolist())}
    raw = {(r.doc_id, r.term): r.weight for r in FE.tfidf_raw(FE.term_counts(docs)).collect()}
    length = {d: math.sqrt(sum(v * v for (k, _), v in raw.items() if k == d)) for d in texts}
    assert got.keys() == raw.keys()
    assert all(math.isclose(got[k], raw[k] / length[k[0]], rel_tol=1e-12) for k in raw)
