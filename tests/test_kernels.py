"""Hashed random Fourier features of sparse rows: kernel error, tasks agree, accuracy on text."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import kernels as KN
from corpusmill.plans import registry
from tests.conftest import SF001


def _sparse(n, seed, width=3000):
    rnd = np.random.default_rng(seed)
    terms = [np.sort(rnd.choice(width, size=rnd.integers(1, 60), replace=False)).astype(np.int64) for _ in range(n)]
    weights = [rnd.random(len(t)) for t in terms]
    return terms, [w / np.linalg.norm(w) for w in weights]


def test_kernel_error(monkeypatch):
    terms, weights = _sparse(60, 5)
    terms, weights = [*terms, terms[0][:-1]], [*weights, weights[0][:-1]]
    x = np.zeros((61, 3000))
    for i, (t, w) in enumerate(zip(terms, weights)):
        x[i, t] = w
    true = np.exp(-1.0 * ((x[:, None] - x[None]) ** 2).sum(-1))
    for dim, bound in ((512, 0.35), (16384, 0.06)):  # some five standard errors, 1 / sqrt(dim) each
        z = KN.fourier(terms, weights, dim, 1.0, 42)
        assert np.abs(z @ z.T - true).max() < bound
    monkeypatch.setattr(KN, "DRAWN", 4096)  # the same numbers however few are drawn at a time
    assert np.allclose(
        KN.fourier(terms, weights, 512, 1.0, 42)[7], KN.fourier(terms[7:8], weights[7:8], 512, 1.0, 42)[0])


def test_rows_of_any_partitioning_agree(spark):
    w = spark.createDataFrame([(1, "a", 0.6), (1, "b", 0.8), (2, "b", 0.8), (2, "a", 0.6), (3, "c", None)], "doc_id long, term string, weight double")
    docs = spark.createDataFrame([(i, i) for i in range(1, 6)], "doc_id long, extra int")
    one = {r.doc_id: r.features.toArray() for r in KN.rbf_rows(docs, w, dim=64).collect()}
    two = {r.doc_id: r.features.toArray() for r in KN.rbf_rows(docs.repartition(5), w.repartition(7), dim=64).collect()}
    assert all(np.array_equal(one[i], two[i]) for i in one) and np.array_equal(one[1], one[2])
    assert np.allclose(one[3], one[4]) and len(one) == 5
    assert one[1] @ one[1] == pytest.approx(1)
    assert KN.rbf_rows(docs.limit(0), w, dim=64).count() == 0
    with pytest.raises(ValueError):
        KN.rbf_rows(docs, w, dim=7)


def test_accuracy_on_text(spark):
    registry.load_all()
    pred = registry.QUERIES["svm_text"](spark, SF001).cache()
    n = pred.count()
    most = pred.groupBy("label").count().agg(F.max("count")).first()[0]
    assert n > 0 and pred.filter("label = prediction").count() > 1.5 * most
