"""Whitening against whole-number brute force."""
import math
from fractions import Fraction

import numpy as np
import pytest

from corpusmill.llm import whitening as W
from tests.conftest import SF01

SCHEMA = "vec_id long, embedding array<float>"


def fit_list(vectors):
    good = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in good})


def test_cross_products_of_bit_planes_are_exact():
    rng = np.random.default_rng(3)
    for high, rows in ((1, 1), (7, 63), (60, 64), (1 << 20, 65), (1 << 45, 500)):
        y = rng.integers(0, high, (rows, 5))
        want = [[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(5)] for i in range(5)]
        assert W.cross_products(y).tolist() == want
        x = y - (high // 2)
        n, s, p = W.block_sums(x)
        assert (n, s.tolist()) == (rows, [sum(map(int, x[:, i])) for i in range(5)])
        assert p.tolist() == [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(5)] for i in range(5)]
    assert W.cross_products(np.zeros((3, 2), np.int64)).tolist() == [[0, 0], [0, 0]]


def check(rows, got, components=16):
    fit = fit_list([v for _, v in rows])
    n, dims = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    x = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in fit])
    cov = np.array([[float(Fraction(sum((n * a[i] - sums[i]) * (n * a[j] - sums[j]) for a in fit), n**3)) for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes.T[::-1][:components]
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert {k: sorted(v) for k, v in by.items()} == {k: list(range(1, min(components, dims) + 1)) for k, v in rows if k in by}
    sign = {}
    for key, v in rows:
        point = tuple(math.floor(64 * c) + 1_000_000 for c in v)
        for c, r in by[key].items():
            assert r.n == n
            assert r.deviation == sum((n * a - s) ** 2 for a, s in zip(point, sums))
            want = float(axes[c - 1] @ [float(Fraction(n * a - s, n)) for a, s in zip(point, sums)]) / math.sqrt(values[c - 1])
            if abs(want) > 1e-3:
                assert sign.setdefault(c, np.sign(want * r.whitened)) == np.sign(want * r.whitened)
            assert abs(abs(want) - abs(r.whitened)) < 1e-7 * max(1, abs(want))
            assert abs(r.explained - values[c - 1] / np.trace(cov)) < 1e-9
            assert r.identity_error < 1e-9
    w = np.array([[by_c[c].whitened for c in sorted(by_c)] for by_c in by.values()])
    assert w.shape[1] == min(components, dims)


def test_whitened_against_brute_force(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(120, 6)) * [5, 3, 2, 1, 0.5, 0.2] + [0, 9, -4, 0, 0, 1]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # a hot vector counts once
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    check(rows, W.whitened(df).collect())
    check(rows, W.whitened(df, components=3).collect(), 3)


def test_registered_query(spark):
    from corpusmill.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    check(rows, QUERIES["op12_whitening"](spark, SF01).collect())


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    first = sorted(W.whitened(df).collect())
    monkeypatch.setattr(W, "BLOCK", 64)
    fit = W.grid(df.repartition(3)).select("x").distinct()
    assert W.scatter(fit, 4) == W.scatter(fit.repartition(1), 4)
    assert [r.deviation for r in first] == [r.deviation for r in sorted(W.whitened(df.repartition(7)).collect())]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (None, [3.0, -1.0]), (3, [0.0, 0.5])]
    odd = [(4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [1.0, inf]), (8, []), (9, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + odd], "vec_id long, embedding array<float>, n string, component string")
    got = W.whitened(df).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in got) == [(False, 0, 1), (False, 0, 1), (False, 0, 2), (False, 0, 2), (False, 3, 1), (False, 3, 2), (True, 0, 1), (True, 0, 2)]
    assert {r.n for r in got} == {3}


def test_no_variance_and_no_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in W.whitened(df).collect()] == [(1, 0, None, None, None)] * 4
    assert W.whitened(df.limit(0)).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], SCHEMA)
    got = W.whitened(line).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got) and max(r.identity_error for r in got) < 1e-9


def test_very_large_entries(spark):
    rows = [(i, [float(1 << (30 + i)), float(i)]) for i in range(8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.vec_id, r.component): r for r in W.whitened(df).collect()}
    fit = fit_list([v for _, v in rows])
    sums = [sum(c) for c in zip(*fit)]
    for i, v in rows:
        want = sum((8 * (math.floor(64 * c) + 1_000_000) - s) ** 2 for c, s in zip(v, sums))
        assert got[i, 1].deviation == (want if want < 1 << 63 else None)
    assert got[0, 1].identity_error == pytest.approx(0, abs=1e-6)
