"""Ball tree, sparse cosine join and symmetric-delete spelling against brute force."""
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import balltree as B
from corpusmill.operators import cluster as C
from corpusmill.operators import sparse as S
from corpusmill.operators import text as TX
from corpusmill.sources.files import load_spell_index, store_spell_index


# ------------------------------------------------------------------ ball tree
def clustered(n=600, groups=12, dims=5, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims)) * 20
    return centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dims)) * 0.5


def vectors(spark, x, name="id"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} long, v array<double>")


def brute_knn(x, q, k, skip_self):
    d = np.round(np.sqrt(((q[:, None] - x[None]) ** 2).sum(-1)), 9)
    return {(i, r + 1): (j, e) for i in range(len(q)) for r, (e, j) in enumerate(sorted((d[i, j], j) for j in range(len(x)) if not (skip_self and i == j))[:k])}


@pytest.mark.parametrize("leaf,skip_self", [(32, True), (100, False), (2048, True)])
def test_nearest_equals_brute_force(spark, leaf, skip_self):
    x = clustered()
    x[50:90] = x[3]  # a hot vector
    df = vectors(spark, x)
    got = {(r.id, r["rank"]): (r.bid, r.dist) for r in B.nearest(df, df, 6, exclude_self=skip_self, leaf=leaf).collect()}
    assert got == brute_knn(x, x, 6, skip_self)


def test_clustered_queries_skip_most_leaves(spark, monkeypatch):
    x = clustered(2000, 16)
    df, seen = vectors(spark, x), []
    plain = B.met

    def met(tree, visitors, placed, compare, schema):
        visitors = visitors.cache()
        seen.append((tree.leaves, visitors.count()))
        return plain(tree, visitors, placed, compare, schema)

    monkeypatch.setattr(B, "met", met)
    B.nearest(df, df, 5, leaf=64).count()
    assert len(seen) == 2 and seen[0][0] >= 16
    assert sum(n for _, n in seen) < 0.3 * len(x) * seen[0][0]  # of all (query, leaf) pairs
    seen.clear()
    B.within(df, 0.99, leaf=64).count()
    assert seen[0][1] < 0.4 * len(x) * seen[0][0] / 2


def test_every_ball_holds_its_rows():
    x = clustered(500, 7)
    tree = B.grow(x, 16)
    at = tree.route(x)
    assert at.min() >= 0 and at.max() < tree.leaves == 16 and len(set(at.tolist())) > 8
    far = np.sqrt(((x - tree.centres[at]) ** 2).sum(1))
    near = tree.from_centres(x)
    assert (near[np.arange(len(x)), at] <= far + 1e-9).all()
    assert B.grow(x[:1], 16).leaves == 1 and B.grow(np.ones((40, 3)), 8).route(np.ones((2, 3))).tolist() == [0, 0]


def test_few_rows_and_odd_rows(spark):
    schema = "id long, v array<double>"
    rows = [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [float("nan"), 1.0]), (None, [1.0, 2.0]), (5, [0.0, 0.0]), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, schema)
    got = sorted((r.id, r["rank"], r.bid) for r in B.nearest(df, df, 5, exclude_self=True).collect())
    assert got == [(1, 1, 2), (1, 2, 5), (2, 1, 1), (2, 2, 5), (5, 1, 1), (5, 2, 2)]
    assert [(r.a, r.b) for r in B.within(df, 0.5).collect()] == [(1, 2)]
    assert B.nearest(df, df.limit(0), 3).count() == 0 and B.nearest(df.limit(0), df, 3).count() == 0
    assert B.within(df.limit(0), 0.5).count() == 0
    ragged = df.union(spark.createDataFrame([(9, [1.0, 2.0, 3.0])], schema))
    with pytest.raises(ValueError, match="2 to 3 components"):
        C.eps_pairs(ragged, "id", "v", 0.5)
    with pytest.raises(ValueError, match="components"):
        C.knn(df.withColumnRenamed("id", "qid"), ragged.withColumnRenamed("id", "bid"), 2, vec="v")


def test_pairs_of_a_hot_vector(spark):
    x = clustered(200, 5, seed=4)
    x[:60] = x[0] * np.linspace(1, 2, 60)[:, None]  # one direction
    got = {(r.a, r.b) for r in B.within(vectors(spark, x), 0.999, leaf=16).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = np.round(u @ u.T, 6)
    assert got == {(i, j) for i in range(200) for j in range(i + 1, 200) if c[i, j] >= 0.999}


# ---------------------------------------------------------------- sparse join
def texts(n=160, seed=3):
    rng = random.Random(seed)
    vocab = [f"t{i}" for i in range(300)]
    odds = [1 / (i + 1) for i in range(300)]
    out = [rng.choices(vocab, odds, k=rng.randrange(1, 40)) for _ in range(n)]
    for i in range(0, n, 4):  # near copies
        out.append(out[i] + [rng.choice(vocab)])
    return out + [out[5]] * 30 + [["t0"]] * 8


def weights(spark, docs, top=None):
    df = {}
    for d in docs:
        for t in set(d):
            df[t] = df.get(t, 0) + 1
    rows = [(i, t, d.count(t) * (math.log((1 + len(docs)) / (1 + df[t])) + 1)) for i, d in enumerate(docs) for t in sorted(set(d))]
    return rows, spark.createDataFrame(rows, "key long, term string, weight double")


def brute_pairs(rows, n, t):
    v = [{} for _ in range(n)]
    for k, term, w in rows:
        v[k][term] = w
    norm = [math.sqrt(sum(w * w for w in d.values())) for d in v]
    return {(a, b) for a in range(n) for b in range(a + 1, n) if v[a] and v[b] and round(sum(w * v[b].get(x, 0) for x, w in v[a].items()) / norm[a] / norm[b], 6) >= t}


@pytest.mark.parametrize("t", [0.875, 0.5, 0.2])
def test_cosine_join_equals_brute_force(spark, t):
    docs = texts()
    rows, df = weights(spark, docs)
    members, pairs = S.cosine_join(df, "key", t)
    rep = {r.key: r.rep for r in members.collect()}
    want = brute_pairs(rows, len(docs), t)
    assert {(a, b) for a, b in want if rep[a] == rep[b]} == {(a, b) for a in rep for b in rep if a < b and rep[a] == rep[b]}
    assert {(r.a, r.b) for r in pairs.collect()} == {(rep[a], rep[b]) if rep[a] < rep[b] else (rep[b], rep[a]) for a, b in want if rep[a] != rep[b]}
    keys = spark.createDataFrame([(i,) for i in range(len(docs) + 1)], "key long")
    got = {r.key: (r.rep, r.links) for r in S.links(keys, "key", members, pairs).collect()}
    assert got == {i: (rep[i], sum(i in p for p in want)) for i in range(len(docs))} | {len(docs): (None, 0)}


def test_candidates_stay_far_below_all_pairs(spark):
    docs = texts(400, 8)
    _, df = weights(spark, docs)
    v = S.unit_vectors(df, "key")
    classes = v.groupBy("digest").agg(F.min("key").alias("rep"), F.first(F.struct("ids", "ws")).alias("v")).select("rep", "v.*").cache()
    n = classes.count()
    posted = S.postings(classes, 0.875).cache()
    assert posted.count() < 0.5 * df.count()
    assert S.candidates(posted, 0.875).count() < 0.05 * n * (n - 1) / 2
    plan = S.candidates(posted, 0.875)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_dbscan_sparse(spark):
    docs = texts(80, 5) + [[]] * 6 + [["x", "y"], ["x", "y", "y"], ["q"]]
    rows, df = weights(spark, docs)
    n, t, least = len(docs), 0.8, 4
    near = {i: {i} for i in range(n)}
    for a, b in brute_pairs(rows, n, t):
        near[a].add(b)
        near[b].add(a)
    blank = {i for i in range(n) if not docs[i]}
    for i in blank:
        near[i] = blank
    core = {i for i in near if len(near[i]) >= least}
    label = {i: i for i in core}
    for _ in range(n):
        label = {i: min(label[j] for j in near[i] & core) for i in core}
    want = {i: (label[i] if i in core else min((label[j] for j in near[i] & core), default=-1), i in core) for i in range(n)}
    keys = spark.createDataFrame([(i,) for i in range(n)], "key long")
    got = {r.key: (r.cluster, r.core) for r in S.dbscan_sparse(keys, "key", *S.cosine_join(df, "key", t), least).collect()}
    assert got == want and any(c for _, c in want.values())


def test_sparse_odd_rows(spark):
    schema = "key long, term string, weight double"
    df = spark.createDataFrame([(None, "a", 1.0), (1, None, 1.0), (2, "a", 0.0), (3, "a", None), (4, "a", 2.0), (5, "a", -3.0), (6, "a", 1.0)], schema)
    members, pairs = S.cosine_join(df, "key", 0.5)
    assert sorted((r.key, r.rep) for r in members.collect()) == [(4, 4), (5, 5), (6, 4)] and pairs.count() == 0
    members, pairs = S.cosine_join(df.limit(0), "key", 0.5)
    assert members.count() == pairs.count() == 0
    with pytest.raises(ValueError):
        S.cosine_join(df, "key", 0.0)


# ------------------------------------------------------------ symmetric delete
def edits(w):
    a = [chr(c) for c in range(97, 123)]
    cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    return {x + y[1:] for x, y in cut if y} | {x + y[1] + y[0] + y[2:] for x, y in cut if len(y) > 1} | {x + c + y[1:] for x, y in cut if y for c in a} | {x + c + y for x, y in cut for c in a}


def test_deletions_find_exactly_the_one_edit_terms(spark, tmp_path):
    rng = random.Random(6)
    words = {"".join(rng.choice("abé1") for _ in range(rng.randrange(0, 5))) for _ in range(120)} | {"11", "12", "a", "", "aa", "ab", "ba"}
    vocab = sorted({"".join(rng.choice("abcé1") for _ in range(rng.randrange(0, 6))) for _ in range(600)} | words)
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(vocab)], "token string, n long")
    w = spark.createDataFrame([(x,) for x in words], "word string")
    want = {(x, t) for x in words for t in edits(x) & set(vocab)}
    got = [(r.word, r.candidate) for r in TX.spell_candidates(w, df).collect()]
    assert set(got) == want and len(got) == len(want)
    store_spell_index(df, f"{tmp_path}/index")
    assert {(r.word, r.candidate) for r in TX.spell_candidates(w, *load_spell_index(spark, f"{tmp_path}/index")).collect()} == want


def test_join_input_shrinks_tenfold(spark):
    w = spark.createDataFrame([(x,) for x in ("spelling", "word", "correction")], "word string")
    new = w.select(F.explode(X.deletions("word"))).count()
    old = w.select(F.explode(X.edit1_candidates("word"))).count()
    assert new == sum(len(x) + 1 for x in ("spelling", "word", "correction")) and old > 10 * new
