"""Porter stemming (Porter, 1980, "An algorithm for suffix stripping").

The stemmer is a small per-word helper. It runs on the *distinct* vocabulary in
Arrow batches and the stems are joined back to the tokens, so each word is
stemmed once however often it occurs.
"""
from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The suffix rules of the published algorithm, steps 2, 3 and 4.
STEP2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"),
    ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
    ("iviti", "ive"), ("biliti", "ble"),
]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
         "iti", "ous", "ive", "ize"]


def _cons(w: str, i: int) -> bool:
    c = w[i]
    if c in "aeiou":
        return False
    if c == "y":
        return i == 0 or not _cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, prev_vowel = 0, False
    for i in range(len(stem)):
        v = not _cons(stem, i)
        if prev_vowel and not v:
            m += 1
        prev_vowel = v
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    return (len(w) >= 3 and _cons(w, len(w) - 3) and not _cons(w, len(w) - 2) and _cons(w, len(w) - 1)
            and w[-1] not in "wxy")


def _longest(w: str, rules):
    for suf, rep in sorted(rules, key=lambda r: -len(r[0])):
        if w.endswith(suf):
            return suf, rep
    return None


def porter(word: str) -> str:
    w = word
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and _has_vowel(w[:-1]):
        w = w[:-1] + "i"
    # steps 2 and 3
    for rules in (STEP2, STEP3):
        hit = _longest(w, rules)
        if hit and _measure(w[: -len(hit[0])]) > 0:
            w = w[: -len(hit[0])] + hit[1]
    # step 4
    hit = _longest(w, [(s, "") for s in STEP4])
    if hit:
        stem = w[: -len(hit[0])]
        if _measure(stem) > 1 and (hit[0] != "ion" or stem.endswith(("s", "t"))):
            w = stem
    # step 5a
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _cvc(w[:-1])):
            w = w[:-1]
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w


def _stem_series(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else porter(x))


def stem_col(c):
    """Arrow-batched Porter stem of a string column."""
    return F.pandas_udf(_stem_series, "string")(c)


def stem_tokens(tokens: DataFrame, col: str = "token", out: str = "stem") -> DataFrame:
    """Stem every token: distinct vocabulary -> stems -> equi join back."""
    # the distinct vocabulary is small enough for AQE to coalesce it into one
    # partition; a fixed repartition keeps the Python work spread over all cores
    par = tokens.sparkSession.sparkContext.defaultParallelism
    vocab = tokens.select(col).distinct().repartition(par)
    stems = vocab.select(col, stem_col(F.col(col)).alias(out))
    return tokens.join(stems, col)
