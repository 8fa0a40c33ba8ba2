"""The second join of op5 covers what the first one leaves out."""
from fractions import Fraction

from pyspark.sql import functions as F

from corpusmill.llm import line_dedup


def test_words_with_more_pairs_are_told(spark):
    """Of the pairs of a word that the first join leaves out, the word is told, and a join of these words finds all pairs."""
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*base[: i % 40], f"x{i}", *base[i % 40 + 1 :]])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = line_dedup.frequent_words(docs)
    c = line_dedup.prefixes(docs, known).withColumnRenamed("doc_id", "d").withColumnRenamed("line", "l").withColumn("open", F.lit(True))
    t = Fraction(3, 4)
    some = line_dedup.met(c, known, t)
    words = line_dedup.bitmap(some.filter("word is not null").select(F.expr("word & 4294967295L").alias("id")).distinct())
    ends = ["ad", "al", "bd", "bl"]
    found = some.select(*ends).distinct().unionByName(line_dedup.met(c, known, t, words=words)).distinct()
    assert {(r.ad, r.bd) for r in found.collect()} == {(a, b) for b in range(60) for a in range(b)}
