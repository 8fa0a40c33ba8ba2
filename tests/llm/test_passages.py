"""Substring dedup against a plain count of all windows."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import common
from corpusmill.llm import passages as P

SCHEMA = "doc_id long, text string, h string, ranges string, m int, __new int"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]


def brute(rows, window):
    """[(doc_id, words, removed, kept text)]"""
    docs = [words_of(t) for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in docs for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, docs):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((key, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def digested(rows):
    return sorted(((k, n, g, hashlib.sha256(t.encode()).hexdigest()) for k, n, g, t in rows), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "h", "r", 1, 2) for k, t in rows], SCHEMA)


def run(df, **k):
    return sorted((tuple(r) for r in P.repeated_passages(df, **k).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)] + ["Ünï", "a\x00b", "B" * 200, "b" * 200]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    passage, other = text(60), text(12)
    out = []
    for i in range(150):
        w = text(rng.randrange(0, 120))
        for p in (passage, other):
            if rng.random() < 0.3:
                at, a = rng.randrange(len(w) + 1), rng.randrange(0, len(p) // 2)
                w[at:at] = p[a : a + rng.randrange(1, len(p))]
        out.append((i, "".join(x + rng.choice([" ", "  ", "\n", "\t "]) for x in w)))
    out += [(200 + i, out[3][1]) for i in range(20)] + [(300, "same " * 100), (301, "again and " * 50)]
    return out


@pytest.mark.parametrize("window,gram,hot", [(8, 2, 2048), (8, 3, 2), (12, 5, 2048), (35, 8, 2048), (35, 5, 1), (3, 1, 4), (6, 6, 1)])
def test_matches_brute_force(spark, rows, window, gram, hot):
    want = brute(rows, window)
    assert sum(g for _, _, g, _ in want) > 100
    assert run(frame(spark, rows).repartition(6), window=window, gram=gram, hot=hot) == digested(want)


def test_full_bitmaps_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(common, "FILTER", 7)
    assert run(frame(spark, rows), window=8, gram=2) == digested(brute(rows, 8))


def test_odd_rows(spark):
    long = " ".join(f"x{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c d e"), (None, "a b c d e"), (4, "a b c d e f"), (4, "a b c d e f"), (5, "one two"), (6, long), (7, "q" * 3_000_000 + " a b c d"), (8, "A b c d e")]
    assert run(frame(spark, rows), window=4, gram=2) == digested(brute(rows, 4))
    assert run(frame(spark, rows).limit(0)) == []


def test_removal_keeps_rows_and_columns(spark, rows):
    some = rows[:60] + rows[200:] + [(900, None), (901, "kept  as\tit is")]
    df = frame(spark, some)
    got = P.drop_passages(df, window=8, gram=2)
    assert got.columns == df.columns
    plain = {k: t for k, t in some}
    for r, (k, _, gone, kept) in zip(sorted(got.collect(), key=lambda r: r.doc_id), sorted(brute(some, 8))):
        assert (r.doc_id, r.text, r["__new"], r.ranges) == (k, kept if gone else plain[k], 2, "r")
    assert P.drop_passages(df.limit(0), window=8, gram=2).count() == 0


def test_super_kmers_hold_every_window_once():
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcde") * rng.randrange(1, 3) for _ in range(n)) for n in (0, 3, 50, 7, 8, 200)]
    words = P.Words(pa.array(texts))
    text, head, count, m = P.super_kmers(words, 8, 3)
    seen = [(t, h - words.first[t] + i) for t, h, c in zip(text, head, count) for i in range(c)]
    assert sorted(seen) == [(t, i) for t, s in enumerate(texts) for i in range(len(s.split()) - 7)]
    assert len(head) < len(seen)
    by = {}  # equal windows have equal minimisers
    for t, h, c, k in zip(text, head, count, m):
        for i in range(c):
            w = tuple(texts[t].split()[h - words.first[t] + i :][:8])
            assert by.setdefault(w, k) == k


def test_leftmost_minimiser():
    g = np.array([5, 3, 9, 3, 1, 1, 7, 0], np.uint64)
    assert P.minimisers(g, 3).tolist() == [1, 1, 4, 4, 4, 7]
    assert P.minimisers(g, 1).tolist() == list(range(8))
    assert P.minimisers(g, 8).tolist() == [7]


def test_lone_minimisers_do_not_travel(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(str(rng.random()) for _ in range(100))) for i in range(40)]
    rows += [(100, rows[0][1]), (101, rows[0][1])]
    counts = P.minimiser_counts(frame(spark, rows))
    assert counts.filter("n > 1").count() < counts.count() / 20
    assert run(frame(spark, rows)) == digested(brute(rows, 35))
