"""Ordered-sequence and graph jobs: goldens, brute force and partition-count invariance."""
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import graph as G
from corpusmill.operators import ordered as O
from tests.conftest import SF01


def _col(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_block_split_sizes(spark):
    df = spark.range(20).withColumnRenamed("id", "k")
    b = O.block_split(df, ["k"], 3)
    sizes = sorted(((r.block, r.n) for r in b.groupBy("block").agg(F.count("*").alias("n")).collect()))
    assert [n for _, n in sizes] == [7, 7, 6]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dense_id_equals_row_number(spark, parts):
    rnd = random.Random(parts)
    vals = rnd.sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    got = {r.v: r.id for r in O.dense_id(df, ["v"], parts=parts).collect()}
    assert got == {v: i for i, v in enumerate(sorted(vals))}


def test_asof_floor_golden_small(spark):
    b = spark.createDataFrame([(x,) for x in [1, 2, 5, 6, 7, 8]], "x long")
    a = spark.createDataFrame([(3,), (6,)], "x long")
    got = dict((r.x, r.idx) for r in O.asof_index(a, b, "x", "floor").collect())
    assert got == {3: 1, 6: 3}


def test_asof_floor_ceil_golden(spark):
    b = spark.createDataFrame([(x,) for x in [8, 9, 11, 51, 56, 64, 82, 84, 88, 97]], "x long")
    xs = [26, 68, 93, 1, 99]
    a = spark.createDataFrame([(x,) for x in xs], "x long")
    fl = dict((r.x, r.idx) for r in O.asof_index(a, b, "x", "floor").collect())
    ce = dict((r.x, r.idx) for r in O.asof_index(a, b, "x", "ceil").collect())
    assert [fl[x] for x in xs] == [2, 5, 8, -1, 9]
    assert [ce[x] for x in xs] == [3, 6, 9, 0, None]


def test_asof_with_duplicates_brute_force(spark):
    rnd = random.Random(3)
    bv = [rnd.randint(0, 50) for _ in range(300)]
    av = [rnd.randint(-5, 55) for _ in range(100)]
    b = spark.createDataFrame([(x,) for x in bv], "x long")
    a = spark.createDataFrame([(i, x) for i, x in enumerate(av)], "i long, x long")
    sb = sorted(bv)
    fl = {r.i: r.idx for r in O.asof_index(a, b, "x", "floor").collect()}
    ce = {r.i: r.idx for r in O.asof_index(a, b, "x", "ceil").collect()}
    for i, x in enumerate(av):
        assert fl[i] == sum(1 for v in sb if v <= x) - 1
        c = sum(1 for v in sb if v < x)
        assert ce[i] == (c if c < len(sb) else None)


def test_merge_sorted_golden(spark):
    a = spark.createDataFrame([(x,) for x in [2, 4, 22, 26, 29, 36, 47, 68, 87, 93]], "v long")
    b = spark.createDataFrame([(x,) for x in [8, 9, 11, 51, 56, 64, 82, 84, 88, 97]], "v long")
    got = [r.v for r in O.merge_sorted(a, b).orderBy("pos").collect()]
    assert got == sorted([2, 4, 22, 26, 29, 36, 47, 68, 87, 93, 8, 9, 11, 51, 56, 64, 82, 84, 88, 97])


def _primes(n):
    sieve = [True] * n
    sieve[:2] = [False, False]
    for i in range(2, int(n**0.5) + 1):
        if sieve[i]:
            sieve[i * i::i] = [False] * len(sieve[i * i::i])
    return [i for i, p in enumerate(sieve) if p]


@pytest.mark.parametrize("n,gap,left,right", [(10, 2, 3, 5), (100, 8, 89, 97), (1000, 20, 887, 907), (10_000, 36, 9551, 9587)])
def test_max_gap_of_primes(spark, n, gap, left, right):
    r = O.max_gap(spark.createDataFrame([(p,) for p in _primes(n)], "p long"), "p").first()
    assert (r.gap, r.left, r.right) == (gap, left, right)


@pytest.mark.parametrize("parts", [1, 4])
def test_max_gap_beyond_double_precision(spark, parts):
    base = 1 << 60
    rows = [(k, base + v) for k in range(6) for v in (1, 4, 6, 6)] + [(9, base + 5), (9, None), (None, 3), (None, 8)]
    df = spark.createDataFrame(rows, "k long, v long")
    got = {r.k: (r.gap, r.left, r.right) for r in O.max_gap(df, "v", ["k"], parts=parts).collect()}
    assert got == {**{k: (3, base + 1, base + 4) for k in range(6)}, 9: (None, None, None), None: (5, 3, 8)}
    r = O.max_gap(df.filter("k is not null"), "v", parts=parts).first()
    assert (r.gap, r.left, r.right) == (3, base + 1, base + 4)


def test_asof_keeps_null_keys(spark):
    b = spark.createDataFrame([(1,), (None,), (5,)], "x long")
    a = spark.createDataFrame([(0, None), (1, 3)], "i long, x long")
    assert {r.i: r.idx for r in O.asof_index(a, b, "x", "floor").collect()} == {0: None, 1: 0}


def test_products_and_paired_loads(spark):
    df = spark.createDataFrame([(i, j) for i in range(1, 11) for j in range(1, i + 1)], "i long, j long")
    assert tuple(O.distinct_products(df, "i", "j").first()) == (55, 42)
    rows = spark.createDataFrame([(w,) for w in range(1, 17)], "w long")
    load = {r.bucket: (r.n_rows, r.load) for r in O.balanced_load(rows, ["w"], "w", 4).collect()}
    assert load == {k: (4, 34) for k in range(4)}


@pytest.mark.parametrize("parts", [1, 5, 13])
def test_max_gap_per_key_brute_force(spark, parts):
    rnd = random.Random(11)
    rows = [(rnd.randint(0, 5), rnd.randint(0, 400)) for _ in range(600)] + [(9, 7), (9, 7), (10, 3)]
    df = spark.createDataFrame(rows, "k long, v long")
    got = {r.k: (r.gap, r.left, r.right) for r in O.max_gap(df, "v", ["k"], parts=parts).collect()}
    for k in {k for k, _ in rows}:
        vs = sorted(v for kk, v in rows if kk == k)
        if len(vs) == 1:
            assert got[k] == (None, None, None)
            continue
        best = max(((vs[i + 1] - vs[i], -vs[i]) for i in range(len(vs) - 1)))
        assert got[k] == (best[0], -best[1], -best[1] + best[0])


def test_max_gap_events_golden(spark):
    from corpusmill.plans.sequence_queries import _events_us

    r = O.max_gap(_events_us(spark, SF01), "us").first()
    assert (r.gap, r.left, r.right) == (2412869133, 1704584171082206, 1704586583951339)


# --------------------------------------------------------------------------- graph
EDGES = [(1, 2), (1, 3), (2, 1), (2, 3), (3, 4), (4, 1), (4, 2), (4, 3)]


def _ranks(spark, edges, n, iters, dup="distinct"):
    e = spark.createDataFrame(edges, "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in range(1, n + 1)], "node long")
    r = G.pagerank(e, nodes, lam=0.25, max_iter=iters, dup=dup).ranks
    return [x.pr for x in r.orderBy("node").collect()]


def test_degrees_golden(spark):
    d = G.degrees(spark.createDataFrame(EDGES, "src long, dst long")).filter("node = 1").first()
    assert (d.out_degree, d.in_links) == (2, 2)


@pytest.mark.parametrize("iters,expected", [
    (1, [0.21875, 0.21875, 0.3125, 0.25]),
    (2, [0.20703125, 0.20703125, 0.2890625, 0.296875]),
    (20, [0.2127659575, 0.2127659575, 0.2925531915, 0.2819148936]),
])
def test_pagerank_goldens(spark, iters, expected):
    assert _ranks(spark, EDGES, 4, iters) == pytest.approx(expected, abs=1e-9)


def test_pagerank_duplicate_edge_modes(spark):
    e = [(1, 2), (1, 2), (1, 3), (2, 3)]
    assert _ranks(spark, e, 3, 1, "distinct") == pytest.approx([0.08333333, 0.20833333, 0.45833333], abs=1e-7)
    assert _ranks(spark, e, 3, 1, "reference") == pytest.approx([0.08333333, 0.16666667, 0.41666667], abs=1e-7)


def test_pagerank_stop_any(spark):
    e = spark.createDataFrame(EDGES, "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in range(1, 5)], "node long")
    res = G.pagerank(e, nodes, max_iter=20, thr=0.01, stop="any")
    assert res.stopped_at is not None and res.iterations < 20


def test_bipartite_rank_sums_to_one(spark):
    pairs = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (3, 12)], "u long, j long")
    r = G.bipartite_rank(pairs, "u", "j", iters=10)
    assert sum(x.pr for x in r.collect()) == pytest.approx(1.0)


def test_hot_value_third_of_rows(spark):
    """A value holding a third of all rows: gaps, as-of indexes and dense ids stay whole and exact."""
    rnd = random.Random(21)
    vals = [777] * 400 + [rnd.randint(0, 2000) for _ in range(800)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i long, v long")
    s = sorted(set(vals))
    best = max((s[k + 1] - s[k], -s[k]) for k in range(len(s) - 1))
    r = O.max_gap(df, "v", parts=7).first()
    assert (r.gap, r.left) == (best[0], -best[1])
    b = df.select(F.col("v").alias("x"))
    a = spark.createDataFrame([(777,), (5000,)], "x long")
    fl = {x.x: x.idx for x in O.asof_index(a, b, "x", "floor").collect()}
    sv = sorted(vals)
    assert fl == {777: sum(1 for v in sv if v <= 777) - 1, 5000: len(sv) - 1}
    ids = O.dense_id(df, ["v", "i"], parts=7)
    assert ids.count() == 1200 and ids.agg(F.countDistinct("id")).first()[0] == 1200
