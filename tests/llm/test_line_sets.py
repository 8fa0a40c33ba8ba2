"""Lines, words and their order in op5, by hashes of eight bytes at a time."""
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import line_dedup


def _texts(rng, n):
    parts = ["a", "B", "zz", "É", " ", "\n", "\t", "\r", "\x0b", "x" * 7, "y" * 8, "q" * 9, "W" * 64, "w" * 65, "\x00", "Z@[`{"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_words_of_lines():
    rng, of = random.Random(3), {}
    for n in range(60):
        texts = _texts(rng, n % 6)
        text, number, line, words = line_dedup.line_sets(pa.array(["left out", *texts], pa.string())[1:])
        lines = [(i, k, x) for i, t in enumerate(texts) for k, x in enumerate(t.split("\n"))]
        want = [re.findall(rb"[^\x20\x09-\x0D]+", re.sub(b"[A-Z]", lambda m: m.group().lower(), x.encode())) for *_, x in lines]
        assert list(zip(text.tolist(), number.tolist())) == [x[:2] for x in lines]
        assert line.tolist() == [i for i, x in enumerate(want) for _ in x]
        assert all(of.setdefault(w, h) == h for w, h in zip((w for x in want for w in x), words.tolist()))
    assert len(set(of.values())) == len(of) > 200


@pytest.mark.parametrize("bits", [line_dedup.RARITY_BITS, 3, 1])
@pytest.mark.parametrize("slots", [line_dedup.SLOTS, 1])
def test_order_by_rarity(monkeypatch, bits, slots):
    """The same order, whether or not one number tells the words apart."""
    monkeypatch.setattr(line_dedup, "SLOTS", slots)
    _, _, line, words = line_dedup.line_sets(pa.array(_texts(random.Random(5), 50)))
    known = np.unique(words)[::2]
    counts = np.arange(len(known)) % 3 + 1
    rank = np.array([dict(zip(known.tolist(), counts.tolist())).get(w, 0) for w in words.tolist()])
    order = np.lexsort((words, rank, line))
    got = line_dedup.Rarity(known, counts, bits).sort(line, words)
    assert got[0].tolist() == line[order].tolist() and got[1].tolist() == words[order].tolist()


def test_classes_are_counted_once(spark, monkeypatch):
    """Both joins post the same classes, so their words are counted once, not once a join."""
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*base[: i % 40], f"x{i}", *base[i % 40 + 1 :]])) for i in range(30)]
    calls, joins, plain, met = [], [], line_dedup.crowded, line_dedup.met
    monkeypatch.setattr(line_dedup, "crowded", lambda *a, **k: calls.append(1) or plain(*a, **k))
    monkeypatch.setattr(line_dedup, "met", lambda *a, **k: joins.append(1) or met(*a, **k))
    monkeypatch.setattr(line_dedup, "_verified", lambda *a: spark.createDataFrame([], "d long, l int"))  # so the second join is needed
    got = line_dedup.later_matches(spark.createDataFrame(rows, "doc_id long, text string"), rounds=0)
    assert got.count() == 30 and len(joins) == 2 and len(calls) == 1
