"""Neighbours of vectors: disk grows with the rows, not with leaves or pairs."""
from __future__ import annotations

import numpy as np
import pytest

from corpusmill.operators import balltree as B
from corpusmill.operators import cluster as C


def test_rows_are_sent_once_a_block(spark, monkeypatch):
    x = np.random.default_rng(1).normal(size=(1500, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<float>")
    seen, plain = [], B.met

    def met(tree, visitors, placed, compare, schema):
        seen.append((tree.leaves, visitors.count(), visitors.groupBy("lo", "hi").count().count()))
        return plain(tree, visitors, placed, compare, schema)

    monkeypatch.setattr(B, "met", met)
    got = {(r.a, r.b): r.cos for r in C.eps_pairs(df, "id", "v", 0.3, leaf=32).collect()}
    u = x.astype(np.float32).astype(float)
    u /= np.sqrt((u * u).sum(1, keepdims=True))
    c = np.round(u @ u.T, 6)
    assert got == {(int(a), int(b)): c[a, b] for a, b in zip(*np.nonzero(np.triu(c >= 0.3, 1)))}
    leaves, sent, groups = seen[0]
    assert leaves >= 32 and sent <= len(x) * 10 and groups > 20  # no structure: all meet all
    plan = C.eps_pairs(df, "id", "v", 0.3, leaf=32)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_crowded_leaves_are_dealt_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_VALUES", 200)
    x = np.random.default_rng(2).normal(size=(60, 4))
    x = np.vstack([x, np.tile(x[0], (150, 1))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = {(r.a, r.b) for r in C.eps_pairs(df, "id", "v", 0.8, leaf=8).collect()}
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(np.round(u @ u.T, 6) >= 0.8, 1)))}


@pytest.mark.parametrize("step, points", [(1 << 20, 1 << 20), (7, 1 << 20), (7, 20)])
def test_dbscan_keeps_few_of_the_pairs(spark, monkeypatch, step, points):
    monkeypatch.setattr(C, "THIN_PAIRS", step)
    monkeypatch.setattr(C, "THIN_POINTS", points)
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=8) + 0.25 * rng.normal(size=(70, 8)) for _ in range(3)] + [rng.normal(size=(60, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    near = np.round(u @ u.T, 6) >= 0.8
    core = near.sum(1) >= 5
    label = np.where(core, np.arange(len(x)), len(x))
    for _ in x:
        label = np.where(core, np.where(near & core, label[None, :], len(x)).min(1), len(x))
    border = np.where(near & core[None, :], label[None, :], len(x)).min(1)
    want = {i: (int(border[i]) if border[i] < len(x) else -1, bool(core[i])) for i in range(len(x))}
    assert {r.id: (r.cluster, r.core) for r in C.dbscan(df, "id", "v", 0.8, 5).collect()} == want and {c for c, _ in want.values()} != {-1}
    pairs = C.eps_pairs(df, "id", "v", 0.8).select("a", "b").coalesce(1)
    if step > 7:
        assert C.thinned(pairs, 5).count() < 4 * len(x) < pairs.count() / 2


def test_dbscan_gives_a_row_for_each_row_of_a_repeated_key(spark):
    x = np.vstack([np.ones(4) + 0.01 * np.random.default_rng(7).normal(size=(9, 4)), -np.ones((1, 4))])
    df = spark.createDataFrame([(i % 9 if i < 12 else 9, x[i % 9 if i < 12 else 9].tolist()) for i in range(13)], "id long, v array<double>")
    got = sorted((r.id, r.cluster, r.core) for r in C.dbscan(df, "id", "v", 0.8, 5).collect())
    assert got == sorted([(i % 9, 0, True) for i in range(12)] + [(9, -1, False)])
