"""Porter stemmer: published examples and the distributed vocabulary path."""
import pytest
from pyspark.sql import functions as F

from corpusmill.functions.stem import porter, stem_tokens

# (word, full-algorithm stem)
CASES = [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "ti"), ("cats", "cat"), ("feed", "feed"),
    ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"), ("sized", "size"),
    ("hopping", "hop"), ("tanned", "tan"), ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"),
    ("failing", "fail"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("connection", "connect"),
    ("connected", "connect"), ("connecting", "connect"), ("connections", "connect"),
    ("generalizations", "gener"), ("oscillators", "oscil"), ("relational", "relat"), ("agreed", "agre"),
    ("hopefulness", "hope"), ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"),
    ("airliner", "airlin"), ("adjustable", "adjust"), ("replacement", "replac"), ("adoption", "adopt"),
    ("communism", "commun"), ("effective", "effect"), ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"),
    ("controll", "control"), ("roll", "roll"),
]


@pytest.mark.parametrize("word,stem", CASES)
def test_porter_cases(word, stem):
    assert porter(word) == stem


def test_stem_tokens_joins_back(spark):
    toks = spark.createDataFrame([(1, "connected"), (2, "connecting"), (3, "cats")], "doc_id long, token string")
    got = {r.doc_id: r.stem for r in stem_tokens(toks).collect()}
    assert got == {1: "connect", 2: "connect", 3: "cat"}
