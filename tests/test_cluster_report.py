"""Several clusterings in one report: perfect, merged and single clusters have known values."""
import pytest
from pyspark.ml.linalg import Vectors

from corpusmill.operators import cluster as C


def test_report_and_fits(spark):
    data = [(i, "abc"[i % 3] if i < 60 else None, Vectors.sparse(9, [i % 3, 3 + i % 3], [1.0, 0.01 * (i % 7)])) for i in range(63)]
    rows = spark.createDataFrame(data, ["doc_id", "lang", "features"])
    found = {(m, 3): C.fit_clusters(rows, "doc_id", m, 3, restarts=5) for m in ("kmeans", "bisecting")}
    found["one", None] = rows.selectExpr("doc_id", "0L AS cluster")
    got = {r.method: r for r in C.report(rows, found, "doc_id", "lang").collect()}
    for m in ("kmeans", "bisecting"):
        assert (got[m].k, got[m].clusters) == (3, 3)
        assert got[m].ari == pytest.approx(1) and got[m].completeness == pytest.approx(1) and got[m].ami == pytest.approx(1)
    assert (got["one"].k, got["one"].clusters) == (None, 1) and got["one"].ari == pytest.approx(0) and got["one"].ami == pytest.approx(0)
    with pytest.raises(ValueError):
        C.fit_clusters(rows, "doc_id", "ward", 3)
