"""Lexicon sentiment with negation and intensity rules (after Hutto &
Gilbert 2014): each text's words, told apart by what stands before them, are counted and joined with the lexicon,
which may be of any size. Equal texts are scored once.

Each lexicon word contributes its valence; a preceding booster (dampener) moves
it by +0.293 (-0.293) away from zero; a negation among the three previous tokens
multiplies it by -0.74; the row score s is normalised to s / sqrt(s^2 + 15).
Capitalisation and punctuation emphasis are not modelled (punctuation is
stripped by the shared tokenizer).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.session import small_side

# Rule constants of the published method.
BOOST = 0.293
NEGATION_SCALAR = -0.74
ALPHA = 15.0
# Small default word lists (callers pass their own).
NEGATIONS = ("not", "no", "never", "nor", "none", "nothing", "without", "cannot", "dont", "isnt", "wasnt")
BOOSTERS = ("very", "really", "extremely", "so", "too", "most", "absolutely", "completely")
DAMPENERS = ("slightly", "barely", "somewhat", "hardly", "little")


def word_uses(toks: Column, negations=NEGATIONS, boosters=BOOSTERS, dampeners=DAMPENERS) -> Column:
    """Array of (word, lift, negated) of a token-array *column*: lift is 1 after a booster, -1 after a dampener, else 0."""
    neg, up, down = (F.array(*[F.lit(w) for w in ws]) for ws in (negations, boosters, dampeners))

    def prev(i, k):
        return F.when(i >= k, F.get(toks, i - k))

    def member(words, x):
        return F.coalesce(F.array_contains(words, x), F.lit(False))

    def use(i):
        lift = F.when(member(up, prev(i, 1)), 1).when(member(down, prev(i, 1)), -1).otherwise(0)
        negated = member(neg, prev(i, 1)) | member(neg, prev(i, 2)) | member(neg, prev(i, 3))
        return F.struct(F.get(toks, i).alias("word"), lift.alias("lift"), negated.alias("negated"))

    return F.when(F.size(toks) > 0, F.transform(F.sequence(F.lit(0), F.size(toks) - 1), use))


def sentiment(df: DataFrame, text: str, lexicon: DataFrame, out: str = "compound") -> DataFrame:
    """One compound score per row of ``df``; null and empty texts score 0.

    A word that the lexicon (word, valence) repeats has its mean valence; null words and valences are left out."""
    key = "__text"
    while key in df.columns:
        key += "_"
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    valence = small_side(lexicon.select("word", F.col("valence").cast("double").alias("v")).dropna().groupBy("word").agg(F.avg("v").alias("v")))
    toks = df.select(digest.alias("d"), X.split_words(X.normalize_text(text)).alias("toks"))
    copies = df.select(digest.alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("copies"))
    # words outside the lexicon go before the uses are dealt out
    uses = toks.select("d", F.inline(word_uses(F.col("toks")))).join(valence, "word").groupBy("d", "word", "lift", "negated", "v").agg(F.count(F.lit(1)).alias("n"))
    lifted = F.col("v") + F.col("lift") * F.signum("v") * BOOST
    each = F.when(F.col("negated"), lifted * NEGATION_SCALAR).otherwise(lifted)
    sums = uses.groupBy("d").agg(F.sum(F.col("n") * each).alias("s"))
    scores = sums.join(copies, "d").select(F.col("d").alias(key), (F.col("s") / F.col("copies")).alias(f"{key}s"))
    s = F.coalesce(f"{key}s", F.lit(0.0))
    j = df.withColumn(key, digest).join(scores, key, "left")
    return j.withColumn(out, s / F.sqrt(s * s + F.lit(ALPHA))).drop(key, f"{key}s")
