"""Joins of text whose disk grows with the texts, not with candidate pairs."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import features as FE
from corpusmill.operators import sparse as S
from tests.test_neighbours import brute_pairs, texts, weights


def long_rows(df):
    return sorted(((r.doc_id, r.term, r.n) for r in df.collect()), key=repr)


def test_packed_counts_equal_long_counts(spark, monkeypatch):
    rows = [(1, "apple apple pear the"), (1, "pear plum"), (2, None), (3, ""), (None, "apple fig"), (None, "fig fig kiwi"), (4, "Ápple pear"), (5, "the of")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = FE.term_counts(docs, packed=True)
    assert long_rows(packed.select("doc_id", F.inline(F.arrays_zip("term", "n")))) == long_rows(FE.term_counts(docs))
    assert packed.filter("doc_id = 1").count() == 1
    monkeypatch.setattr(FE, "LOOKUP", 2)  # several rounds
    many = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(texts(40))], "doc_id long, text string")
    want = {}
    for r in FE.tfidf_raw(FE.term_counts(many)).collect():
        want.setdefault(r.doc_id, []).append(round(r.weight, 9))
    monkeypatch.setattr(FE, "LOOKUP", 60)
    got = FE.tfidf_raw(FE.term_counts(many, packed=True)).collect()
    assert {r.doc_id: sorted(round(w, 9) for w in r.weight) for r in got} == {k: sorted(v) for k, v in want.items()}
    assert max(max(r.term) for r in got) > 60 and min(min(r.term) for r in got) == -1


@pytest.mark.parametrize("t", [0.875, 0.5])
def test_cosine_join_in_many_slabs(spark, monkeypatch, t):
    docs = texts() + [["only"], ["alone"]]
    rows, df = weights(spark, docs)
    monkeypatch.setattr(S, "SLAB", 400)
    members, pairs = S.cosine_join(df, "key", t)
    rep = {r.key: r.rep for r in members.collect()}
    want = {tuple(sorted((rep[a], rep[b]))) for a, b in brute_pairs(rows, len(docs), t) if rep[a] != rep[b]}
    got = [(r.a, r.b) for r in pairs.collect()]
    assert set(got) == want and len(got) == len(want)
    packed = FE.tfidf_raw(FE.term_counts(spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string"), stops=(), packed=True))
    members, pairs = S.cosine_join(packed, "doc_id", t)
    assert {r.doc_id: r.rep for r in members.collect()} == rep and {(r.a, r.b) for r in pairs.collect()} == want


def test_candidates_need_the_sum_of_their_heads(spark):
    rng = np.random.default_rng(4)
    docs = [[f"t{i}" for i in np.minimum(rng.zipf(1.3, 60), 3000)] for _ in range(150)]
    _, df = weights(spark, docs + [d[:-3] for d in docs[:20]])
    vectors = S.unit_vectors(df, "key")
    classes = vectors.groupBy("digest").agg(F.min("key").alias("rep"), F.first(F.struct("ids", "ws")).alias("v")).select("rep", "v.ids", "v.ws").cache()
    met = S.candidates(S.heads(classes, 0.875), 0.875)
    pairs = S.compared(met, classes, 0.875, 6)
    posted = S.postings(classes, 0.875).cache()
    x, y = posted.toDF("id", "a", "wa", "ra"), posted.toDF("id", "b", "wb", "rb")
    one = x.join(y, "id").filter("a < b and wa * wb + ra * rb >= 0.87499").select("a", "b").distinct().count()  # by one common term
    assert 20 <= pairs.count() <= met.count() < 0.5 * one


def test_meetings_in_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    ids = [sorted(rng.choice(30, rng.integers(1, 8), replace=False).tolist()) for _ in range(60)]
    ws = [(lambda x: (x / np.sqrt((x * x).sum())).tolist())(rng.random(len(i)) + 0.1) for i in ids]
    batch = pa.RecordBatch.from_pydict({"rep": list(range(60)), "ids": ids, "ws": ws, "whole": [1.0] * 60, "slab": pa.array([0] * 60, pa.int32())})
    slab = S._index(batch) | {"least": 0.3 - S.SLACK}
    found = []
    for cells, meetings in ((1 << 20, 1 << 19), (1 << 20, 7), (130, 3)):
        monkeypatch.setattr(S, "CELLS", cells)
        monkeypatch.setattr(S, "MEETINGS", meetings)
        found.append(sorted(p for b in S._met(slab, 0, batch) for p in zip(b["a"].to_pylist(), b["b"].to_pylist())))
    cos = {(a, b): sum(w * dict(zip(ids[b], ws[b])).get(i, 0) for i, w in zip(ids[a], ws[a])) for a in range(60) for b in range(a + 1, 60)}
    assert found[0] == found[1] == found[2] and set(found[0]) >= {p for p, c in cos.items() if c >= 0.3}


def test_packed_weights_give_the_same_kernel_rows(spark):
    from corpusmill.operators import kernels as KN

    docs = spark.createDataFrame([(i, " ".join(d), i % 3 != 0) for i, d in enumerate(texts(60) + [[], ["onlyhere"], ["onlythere"]])], "doc_id long, text string, is_train boolean")
    ids = docs.select("doc_id", "is_train")
    counts = FE.term_counts(docs.select("doc_id", "text"))
    plain = FE.tfidf_fitted(counts, counts.join(ids.filter("is_train").select("doc_id"), "doc_id"))
    packed = FE.tfidf_fitted(FE.term_counts(docs.select("doc_id", "text"), packed=True).join(ids, "doc_id"), "is_train")
    a, b = ({r.doc_id: r.features.toArray() for r in KN.rbf_rows(ids, w, dim=32).collect()} for w in (plain, packed))
    assert a.keys() == b.keys() and len(a) == docs.count()
    assert max(abs(a[k] - b[k]).max() for k in a) < 1e-12


def test_one_vs_rest_equals_the_library(spark):
    from pyspark.ml.classification import LinearSVC, OneVsRest
    from pyspark.ml.linalg import Vectors

    from corpusmill.operators import models as M

    rng = np.random.default_rng(6)
    rows = spark.createDataFrame([(float(i % 3), Vectors.dense((rng.normal(size=3) + 2 * np.eye(3)[i % 3]).tolist())) for i in range(90)], ["label", "features"])
    svc = LinearSVC(regParam=1e-3, maxIter=20)
    a, b = M.one_vs_rest(rows, svc), OneVsRest(classifier=svc).fit(rows)
    assert all(np.allclose(x.coefficients.toArray(), y.coefficients.toArray()) for x, y in zip(a.models, b.models, strict=True))
    assert [r.prediction for r in a.transform(rows).collect()] == [r.prediction for r in b.transform(rows).collect()]
