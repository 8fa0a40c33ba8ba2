"""The rows of the network's query are hashed and labelled once."""
from pyspark.sql import functions as F

from corpusmill.plans import ml_queries as Q


def test_mlp_prepares_its_rows_once(spark, tmp_path, monkeypatch):
    rows = [(i, i % 7, float(i % 50), float(i * 37 % 1000), i % 11 / 100, i % 9 / 100, "ANR"[i % 3]) for i in range(600)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string")
    lines.repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    hashed, plain = spark.sparkContext.accumulator(0), Q._lines

    def counted(spark, sf):
        @F.udf("boolean")
        def seen(x):
            hashed.add(1)
            return x

        return plain(spark, sf).withColumn("is_train", seen("is_train"))

    monkeypatch.setattr(Q, "_lines", counted)
    got = Q.q_mlp(spark, str(tmp_path)).collect()
    train = plain(spark, str(tmp_path)).filter("is_train").count()
    assert hashed.value == 600 and len(got) == 600 - train > 0
    assert {r.label for r in got} == {0.0, 1.0, 2.0}
