"""Exact, near and line dedup against brute force, with hot groups and odd rows."""
import hashlib
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import exact_dedup, line_dedup, near_dedup

SCHEMA = "doc_id long, text string, digest string, n long, row string"


def ascii_lower(t):
    return "".join(c.lower() if c.isascii() else c for c in t or "")


def words(t):
    return ascii_lower(t).encode().split()


def frame(spark, pairs, parts=5):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in pairs], SCHEMA).repartition(parts)


def corpus(seed=0, hot=60):
    """Documents with a hot group of copies, near copies of any closeness, a shared passage and odd rows."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(vocab) for _ in range(60)]
    out = []
    base = [rng.choice(vocab) for _ in range(120)]
    for _ in range(hot):
        out.append(" ".join(base))
    for k in range(hot):
        t = list(base)
        for _ in range(k % 12):
            t[rng.randrange(len(t))] = rng.choice(vocab)
        out.append(" ".join(t))
    for _ in range(40):
        b = [rng.choice(vocab) for _ in range(rng.randint(1, 80))]
        out.append(" ".join(b + (passage if rng.random() < 0.5 else [])))
        if rng.random() < 0.6:
            t = list(b)
            t[rng.randrange(len(t))] = "Changed"
            out.append(" ".join(t + (passage if rng.random() < 0.5 else [])))
    out += ["", None, " \n\t", "Short text", "short TEXT", "short", "É b c d e f", "é b c d e f", "a b c d e " * 400]
    return list(enumerate(out))


def components(rows, linked):
    comp = {i: i for i, _ in rows}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for x, (i, a) in enumerate(rows):
        for j, b in rows[:x]:
            if linked(a, b):
                u, v = find(i), find(j)
                comp[max(u, v)] = min(u, v)
    return {i: find(i) for i, _ in rows}


def shingles(t):
    w = words(t)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


@pytest.mark.parametrize("rounds", [0, 2])
def test_near_duplicates_equal_brute_force(spark, rounds):
    rows = corpus()
    sets = {i: shingles(t) for i, t in rows}
    want = components([(i, sets[i]) for i, _ in rows], lambda a, b: bool(a & b) and 100 * len(a & b) >= 75 * len(a | b))
    got = near_dedup.near_duplicates(frame(spark, rows), rounds=rounds).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_rows_and_columns(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(5, t), (5, t), (3, t + " x"), (None, t), (9, None), (9, "")]
    got = near_dedup.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, -1, True), (3, 3, True), (5, 3, False), (5, 3, False), (9, 9, True), (9, 9, True)]
    kept = near_dedup.drop_near_duplicates(frame(spark, rows))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 9]
    assert near_dedup.near_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert near_dedup.drop_near_duplicates(frame(spark, [(1, "a b"), (2, "c d")])).count() == 2


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 400)] + [(7, 7), (1, 2)], "a long, b long")
    got = {r.id: r.comp for r in near_dedup.components(edges).collect()}
    assert got == {**{i: 100 for i in range(100, 401)}, 1: 1, 2: 1}


def test_tensored_keys_share_minhashes():
    import numpy as np

    a = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    both = near_dedup.collections([a, a.copy(), a[:380]])
    assert both.shape == (3, 32) and (both[0] == both[1]).all() and 8 < (both[0] == both[2]).sum() < 32


@pytest.mark.parametrize("keep,fan", [("largest", 16), ("smallest", 2)])
def test_exact_duplicates(spark, keep, fan):
    rows = corpus(1)
    groups = {}
    for i, t in rows:
        groups.setdefault(ascii_lower(t), []).append(i)
    pick = max if keep == "largest" else min
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(frame(spark, rows, 9), fan, keep).collect()}
    for i, t in rows:
        g, r = groups[ascii_lower(t)], got[i]
        assert (r.keep_id, r.group_size, r.kept) == (pick(g), len(g), i == pick(g))
        assert r.text_sha256 == hashlib.sha256(ascii_lower(t).encode()).hexdigest()
    assert {r.doc_id for r in exact_dedup.drop_exact_duplicates(frame(spark, rows), fan, keep).collect()} == {pick(g) for g in groups.values()}


def test_exact_repeated_rows_and_nulls(spark):
    rows = [(4, "A"), (4, "a"), (4, "b"), (None, "a"), (None, None), (None, ""), (2, "B")]
    out = exact_dedup.exact_duplicates(frame(spark, rows)).collect()
    assert len(out) == 7 and sum(r.kept for r in out) == 3
    assert sorted((r.keep_id or -1, r.group_size) for r in out if r.kept) == [(-1, 2), (4, 2), (4, 3)]
    kept = exact_dedup.drop_exact_duplicates(frame(spark, rows))
    assert sorted((r.doc_id or -1, ascii_lower(r.text)) for r in kept.collect()) == [(-1, ""), (4, "a"), (4, "b")]
    assert kept.columns[2:] == ["digest", "n", "row"]
    assert exact_dedup.exact_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert exact_dedup.drop_exact_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_exact_dedup_is_native_and_verifies(spark):
    plan = exact_dedup.exact_duplicates(frame(spark, corpus(2)))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    rows = exact_dedup.digest_rows(frame(spark, [(1, "a"), (2, "b")])).withColumn("digest", F.unhex(F.lit("00")))
    with pytest.raises(Exception, match="one digest"):
        exact_dedup.tree_merge(rows).collect()


def brute_lines(rows, t=0.75):
    seen, gone, first = [], set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for k, line in enumerate((text or "").split("\n")):
            w = frozenset(words(line))
            if not w:
                continue
            if any(len(w & v) >= t * len(w | v) for v in seen):
                gone.add((i, k))
            first.setdefault(w, (i, k))
            seen.append(w)
    return gone, first


def lines_corpus(seed=0):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    hot = [rng.choice(vocab) for _ in range(24)]
    out = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            kind = rng.random()
            if kind < 0.2:
                lines.append("the SAME line, everywhere")
            elif kind < 0.55:
                t = list(hot)
                for _ in range(rng.randint(0, 4)):
                    t[rng.randrange(len(t))] = rng.choice(vocab)
                lines.append(" ".join(t))
            elif kind < 0.65:
                lines.append("")
            else:
                lines.append(" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 12))))
        out.append("\n".join(lines))
    return list(enumerate([*out, None, "", "\n\n", "The same  line, everywhere\r"]))


@pytest.mark.parametrize("rounds,most", [(3, 1 << 16), (1, 5)])
def test_line_dedup_equals_brute_force(spark, rounds, most):
    rows = lines_corpus()
    gone, first = brute_lines(rows)
    got = line_dedup.later_matches(frame(spark, rows), rounds=rounds, most=most).collect()
    assert {(r.doc_id, r.line) for r in got if r.gone} == gone
    assert {(r.first_doc, r.first_line) for r in got} == set(first.values())


def test_line_dedup_texts(spark):
    rows = [(2, "one two\nThree four\n\nend"), (1, "three FOUR\nother"), (None, "one TWO"), (3, None)]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame(spark, rows)).collect()}
    assert got == {None: "one TWO", 1: "three FOUR\nother", 2: "\nend", 3: None}
    assert line_dedup.dedup_lines(frame(spark, rows).limit(0)).count() == 0


CLASHES = "doc_id long, text string, gone int, __id int, __digest int, __d int, __hit int, __k int, __gone int, __w int"


def test_clashing_columns(spark):
    rows = [(1, "one two three four five six"), (2, "ONE two three four five six"), (3, "x y"), (None, "x z"), (4, None), (4, None), (3, "x y")]
    df = spark.createDataFrame([(*r, *range(8)) for r in rows], CLASHES)
    for name, fn, kept in (("lines", line_dedup.dedup_lines, 7), ("exact", exact_dedup.drop_exact_duplicates, 4), ("near", near_dedup.drop_near_duplicates, 4)):
        out = fn(df)
        assert out.columns == df.columns and out.count() == kept, name
        assert all(tuple(r)[2:] == tuple(range(8)) for r in out.collect()), name
        assert fn(df.limit(0)).count() == 0, name


def test_very_long_texts(spark):
    long = [f"line {i} of {i * 7919 % 20011} words {i % 13} end{i}" for i in range(20_000)]
    other = [x if i % 2 else x + " more" for i, x in enumerate(long)]
    df = spark.createDataFrame([(1, "\n".join(long)), (2, "\n".join(other)), (3, "short")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()}
    assert got[1] == "\n".join(long) and got[2] == "" and got[3] == "short"
    assert {r.doc_id for r in near_dedup.drop_near_duplicates(df).collect()} == {1, 2, 3}
    twice = df.unionByName(df.select((df.doc_id + 10).alias("doc_id"), "text"))
    assert {r.doc_id for r in exact_dedup.drop_exact_duplicates(twice).collect()} == {11, 12, 13}
    assert {r.doc_id for r in near_dedup.drop_near_duplicates(twice).collect()} == {1, 2, 3}


@pytest.mark.parametrize("crowd", [2, 1 << 14])
def test_line_dedup_crowded_words(spark, crowd):
    """Words that many classes post are dealt out in parts; the result stays that of brute force."""
    rows = lines_corpus(5)
    gone, first = brute_lines(rows)
    got = line_dedup.later_matches(frame(spark, rows), rounds=0, crowd=crowd).collect()
    assert {(r.doc_id, r.line) for r in got if r.gone} == gone
    assert {(r.first_doc, r.first_line) for r in got} == set(first.values())


def test_line_postings_make_a_row_a_class(spark):
    """A group of variants makes rows in proportion to its lines, not to their pairs; a posting's bytes are a few, not a row."""
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join([*base[: i % 40], f"x{i}", *base[i % 40 + 1 :]])) for i in range(200)]
    docs = frame(spark, rows)
    frequent = line_dedup.frequent_words(docs)
    c = line_dedup.prefixes(docs, frequent).withColumnRenamed("doc_id", "d").withColumnRenamed("line", "l").withColumn("open", F.lit(True))
    assert line_dedup.met(c, frequent, Fraction(3, 4)).count() <= 200 * 12 * line_dedup.KEPT < 200 * 199 // 2
    posts = line_dedup.postings(c, 4, line_dedup.crowded(c, frequent))
    assert posts.select("bucket").distinct().count() <= 4 and posts.count() <= 4 * c.rdd.getNumPartitions()
