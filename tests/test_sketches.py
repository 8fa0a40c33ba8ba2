"""Stored summaries: exact moments, bounded errors of quantiles and distinct counts, parts taken again."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import sketches as SK
from corpusmill.operators import stats as ST


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(8)
    data = []
    for i in range(30_000):
        day = 0 if i % 3 == 0 else rnd.randrange(1, 20)  # one day holds a third
        data.append((day, rnd.choice(["a", None]), 1e9 + rnd.lognormvariate(0, 1) if i % 50 else None, rnd.randrange(4000)))
    return spark.createDataFrame(data, "day int, g string, x double, n long").cache()


def _parts(spark, rows, path):
    SK.store(SK.summarise(rows, ["x", "n"], F.col("day"), ["g"]), path)
    return SK.stored(spark, path)


def test_moments_are_exact(spark, rows, tmp_path):
    parts = _parts(spark, rows, str(tmp_path / "s"))
    got = {(r.g, r.column): r for r in SK.describe_sketch(parts, ["g"]).collect()}
    for r in rows.groupBy("g").agg(F.count("x").alias("c"), F.sum(F.isnull("x").cast("int")).alias("miss"), F.avg("x").alias("m"), F.stddev_samp("x").alias("s"),
                                   F.min("x").alias("lo"), F.max("x").alias("hi")).collect():
        x = got[(r.g, "x")]
        assert (x["count"], x["missing"], x["min"], x["max"]) == (r.c, r.miss, r.lo, r.hi)
        assert x["mean"] == pytest.approx(r.m, rel=1e-12) and x["std"] == pytest.approx(r.s, rel=1e-6)


def test_estimates_within_their_bounds(spark, rows, tmp_path):
    parts = _parts(spark, rows, str(tmp_path / "s"))
    assert parts.count() == 20 * 2 * 2
    got = {r.column: r for r in SK.describe_sketch(parts).collect()}
    exact = {r.column: r for r in ST.describe(rows, ["x", "n"]).collect()}
    for c in ("x", "n"):
        v = np.sort([r[0] for r in rows.select(c).filter(F.col(c).isNotNull()).collect()])
        for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            lo, hi = np.searchsorted(v, got[c][name], "left") / len(v), np.searchsorted(v, got[c][name], "right") / len(v)
            assert lo - 2 * SK.rank_error() <= q <= hi + 2 * SK.rank_error()
        assert got[c]["count"] == exact[c]["count"]
        assert got[c]["distinct"] == pytest.approx(len(set(v)), rel=4 * 1.04 / 2 ** (SK.LG_REGISTERS / 2))


def test_outliers(spark, rows, tmp_path):
    got = {r.column: r for r in SK.boxplot_sketch(_parts(spark, rows, str(tmp_path / "s"))).collect()}
    v = np.array([r.x for r in rows.select("x").collect() if r.x is not None])
    q1, q3 = np.quantile(v, [0.25, 0.75])
    true = int(((v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))).sum())
    assert got["n"].outliers == 0 and abs(got["x"].outliers - true) <= 2 * (2 * SK.rank_error() + 1 / SK.GRID) * len(v)


def test_a_part_taken_again_replaces_itself(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    before = _parts(spark, rows, path).count()
    SK.store(SK.summarise(rows.filter("day = 3"), ["x", "n"], F.col("day"), ["g"]), path)
    assert SK.stored(spark, path).count() == before
    late = spark.createDataFrame([(99, "a", 5.0, 1), (99, "a", float("nan"), None)], rows.schema)
    SK.store(SK.summarise(late, ["x", "n"], F.col("day"), ["g"]), path)
    d = {r.column: r for r in SK.describe_sketch(SK.stored(spark, path).filter("part = '99'")).collect()}
    assert (d["x"]["count"], d["x"].missing, d["x"]["q50"], d["x"]["std"], d["x"].distinct) == (1, 1, 5.0, None, 1)
    assert SK.stored(spark, path).count() == before + 2
    plan = SK.stored(spark, path).filter("part = '99'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(cast(part" in plan or "(cast(part" in plan


def test_nothing_to_sum_up(spark, rows):
    none = spark.createDataFrame([(1, "a", None, None)], rows.schema)
    d = {r.column: r for r in SK.describe_sketch(SK.summarise(none, ["x", "n"], F.col("day"), ["g"]), ["g"]).collect()}
    assert (d["x"]["count"], d["x"].missing, d["x"]["mean"], d["x"].q50, d["x"].distinct) == (0, 1, None, None, 0)
    assert SK.boxplot_sketch(SK.summarise(none, ["x"], F.col("day"))).first().outliers is None
    assert SK.describe_sketch(SK.summarise(none.limit(0), ["x"], F.col("day"))).count() == 0
    with pytest.raises(ValueError):
        SK.summarise(none, ["x"], F.col("day"), ["mean"])
