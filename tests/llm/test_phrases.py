"""Phrase collocations against a plain count of all n-grams."""
import random
import re
from collections import Counter, defaultdict

import pytest

from corpusmill.llm import phrases as P

SCHEMA = "doc_id long, text string, lang string, n string, w1 long, p string"


def brute(rows, least, share=100, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min(((1000 * a * n[lang]) // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i % 7, t, g, "n", 5, "p") for i, (t, g) in enumerate(rows)], SCHEMA)


def run(df, **k):
    return sorted(tuple(r) for r in P.collocations(df, **k).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(30)] + ["Ünï", "ÉA", "x" * 300]
    fixed = ["New York city hall", "of the same kind as", "a b a b a b"]
    out = []
    for i in range(400):
        parts = [rng.choice(words) if rng.random() < 0.8 else rng.choice(fixed) for _ in range(rng.randrange(1, 40))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b", "!?", " "]) for p in parts)
        out.append((text, rng.choice(["en", "en", "en", "de", None])))
    return out


def test_matches_brute_force(spark, rows):
    want = brute(rows, 8)
    assert len(want) > 50
    assert run(frame(spark, rows).repartition(6), least=8) == want
    assert run(frame(spark, rows).repartition(1), least=8, share=60, top=10) == brute(rows, 8, 60, 10)


def test_hot_phrase_long_text_and_repeats(spark):
    hot = "the quick brown fox jumps over"
    rows = [(f"{hot} {i}", "en") for i in range(300)] + [("same text again", "en")] * 200 + [("z y " * 30_000, "fr")]
    assert run(frame(spark, rows).repartition(4), least=100) == brute(rows, 100)


def test_odd_rows(spark):
    rows = [(None, "en"), ("", None), ("...", "en"), ("one", "en"), ("a b", None), ("A B", "und"), ("\x0bb\x0c", None), ("a\x00b a\x00b", "en")]
    assert run(frame(spark, rows), least=1) == brute(rows, 1)
    assert run(frame(spark, rows).limit(0), least=1) == []


def test_same_word_in_two_languages_is_two_words(spark):
    rows = [("a b", "x")] * 3 + [("a b", "y")] * 2
    assert run(frame(spark, rows), least=3) == [("x", 1, "a b", 3, 3, 3, 6, 2000)]


def test_no_false_hit_changes_a_count(spark, rows, monkeypatch):
    monkeypatch.setattr(P, "FILTER", 8)  # nearly all bits set
    assert run(frame(spark, rows), least=8) == brute(rows, 8)


def test_a_second_seed_gives_the_same_result(spark, rows, monkeypatch):
    plain, tried = P.vocabulary, []

    def collide(docs, seed):
        tried.append(seed)
        v = plain(docs, seed)
        return v if seed else v.withColumn("id", v.id.bitwiseAND(7))

    monkeypatch.setattr(P, "vocabulary", collide)
    assert run(frame(spark, rows), least=8) == brute(rows, 8) and tried == [0, 1]


def test_scores_beyond_64_bits(spark):
    a, n, left, right = 3 * 10**15, 7 * 10**16, 10**16 + 7, 9 * 10**15 + 1
    words = spark.createDataFrame([(1, "x", "u", left), (2, "x", "v", right)], "id long, lang string, word string, f long")
    cand = spark.createDataFrame([([1, 2], a)], "p array<long>, a long")
    totals = spark.createDataFrame([("x", n)], "lang string, n long")
    r = P.scored(cand, words, totals).first()
    assert (r.l, r.r, r.score) == (left, right, 1000 * a * n // (left * right))


def test_plan_sums_with_rollup(spark, rows):
    wins = spark.createDataFrame([(1, 2, 0, 0, 0, 4)], "w1 long, w2 long, w3 long, w4 long, w5 long, n long")
    plan = P.prefix_counts(wins, least=1)._jdf.queryExecution().toString()
    assert "Expand" in plan and [(r.p, r.f) for r in P.prefix_counts(wins, least=1).collect()] == [([1, 2], 4)]
