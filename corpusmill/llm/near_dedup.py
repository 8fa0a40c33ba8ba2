"""Operator 2: MinHash near-dedup with tensored banding.

A document's set holds the hashes of its distinct 5-word shingles. ``SIDE`` left and
``SIDE`` right collections of ``ROWS`` minhashes each are computed once; a table key
is a pair (left collection i, right collection j), so SIDE**2 tables of 2 * ROWS
hashes cost 2 * SIDE * ROWS minhashes instead of 2 * ROWS * SIDE**2. With 16 and 3,
96 minhashes serve 256 tables, and a pair at similarity 0.75 fails to meet with
probability 2 * (1 - 0.75**3)**16 = 3e-4; at 0.8 with 3e-5.

All candidates are confirmed on full sets, in integers:
100 * |A & B| >= 75 * |A | B|. Links make components; the smallest doc_id stays.

Scale. Documents of equal sets are one vertex. Rows that share no left (or no right)
collection value with any other document have no table key in common with one and
leave early. Pairs are never emitted for a
whole bucket: in rounds each document is compared with one member of another
component that shares most of its collections, at first the bucket's most central
member, which joins large groups of near copies at linear cost; rounds go on while they
still find links. Then only pairs of *different* components that share a table
key remain, found from the smaller components' side. Those meet on the key's left value,
its right value is compared there, a pair counts at its first common left value only,
and a parity sketch of the sets (each shingle flips one of 1024 bits, so differing bits
are a lower bound of the symmetric difference) drops pairs that cannot be similar.
All others are compared in full. Nothing is capped. Links and components stay distributed.

Defined results: null text or no words: empty set, linked with nothing; null
doc_id: never linked, component_id null, kept; rows that repeat a doc_id are one
vertex and all get its component; texts are read whole, whatever their length; empty table: empty result.
Other columns are not read; ``drop_near_duplicates`` returns them unchanged, whatever their names.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import TEXT_BYTES, discard, free_name, map_slices, parted, stored, strings
from corpusmill.llm.shingles import distinct, shingle_hashes

WIDTH = 5
SIMILARITY = 75
SIDE, ROWS = 16, 3
#: Least rounds of joining components by single comparisons, before all remaining pairs are
#: compared. More follow while a round finds a link for one in ENOUGH candidates.
ROUNDS, ENOUGH = 2, 50
#: Longs of the parity sketch.
SKETCH = 16
#: Shingles that one step of the minhash loop takes, so that they stay in the CPU cache.
_STEP = 1 << 15
#: Bytes of text whose shingles a task holds at once.
SLICE = TEXT_BYTES >> 2


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(77_003))
    return rng.integers(0, 1 << 63, n, dtype=np.uint64), rng.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def collections(sets: list[np.ndarray], side: int = SIDE, rows: int = ROWS) -> np.ndarray:
    """(documents, 2 * side) int64: the values of the left, then of the right collections of non-empty sets."""
    xor, mul = _seeds(2 * side * rows)
    out = np.empty((len(sets), 2 * side), dtype=np.int64)
    at = 0
    while at < len(sets):
        end, total = at, 0
        while end < len(sets) and (end == at or total + len(sets[end]) <= _STEP):
            total += len(sets[end])
            end += 1
        h = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *(len(s) for s in sets[at : end - 1])])
        for c in range(2 * side):
            v = np.full(end - at, c + 1, dtype=np.uint64)
            for k in range(c * rows, (c + 1) * rows):
                low = np.minimum.reduceat((h ^ xor[k]) * mul[k], starts)
                v = (v ^ low) * np.uint64(0xD6E8FEB86659FD93)
                v ^= v >> np.uint64(32)
            out[at:end, c] = v.view(np.int64)
        at = end
    return out


def sketches(sets: list[np.ndarray], longs: int = SKETCH) -> np.ndarray:
    """(documents, longs) int64: bit i tells whether an odd number of a set's hashes fall into bin i."""
    bits = 64 * longs
    bins = np.concatenate(sets) >> np.uint64(64 - (bits.bit_length() - 1))
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    odd = np.bincount(doc * bits + bins.astype(np.int64), minlength=bits * len(sets)).astype(np.uint8) & 1
    return np.packbits(odd.reshape(len(sets), bits), axis=1).view(np.int64)


def signatures(docs: DataFrame, width: int = WIDTH, side: int = SIDE, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles; of non-empty sets also digest, sig (the 2 * side collection values) and sketch."""

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            sets = distinct(*shingle_hashes(strings(part, "text"), width))
            full = [i for i, s in enumerate(sets) if len(s)]
            sig: list = [None] * len(sets)
            dig: list = [None] * len(sets)
            odd: list = [None] * len(sets)
            if full:
                some = [sets[i] for i in full]
                for i, row, bits in zip(full, collections(some, side, rows), sketches(some)):
                    sig[i], odd[i] = row, bits
                    dig[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(dig, pa.binary()), pa.array(sig, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "sig", "sketch"],
            )

        return one

    return map_slices(docs.select("doc_id", "text"), "text", make, "doc_id long, n_shingles long, digest binary, sig array<long>, sketch array<long>", SLICE)


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar; texts: (id, text)."""

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            sa = distinct(*shingle_hashes(strings(part, "ta"), width))
            sb = distinct(*shingle_hashes(strings(part, "tb"), width))
            ok = []
            for x, y in zip(sa, sb):
                small, large = sorted((len(x), len(y)))
                good = small > 0 and 100 * small >= similarity * large
                if good:
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good = 100 * both >= similarity * (small + large - both)
                ok.append(good)
            return part.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        return one

    t = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    t = t.join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return map_slices(t.select("a", "b", "ta", "tb"), "ta", make, "a long, b long", SLICE)


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """(id, comp) for the ends of edges (a, b): comp is the smallest id reachable.

    Alternates large-star and small-star steps until the edges no longer change;
    every intermediate is a table of edges in the shared folder.
    """
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        j = large.join(low, "u")
        small = j.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        new = stored(small, label)
        mark = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 40))).first())
        discard(e)
        e = new
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    out = e.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())
    out.stored_path = e.stored_path  # to be discarded with it
    return out


def _moved(rows: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Rows (id, ...) with their current component."""
    if comps is None:
        return rows.withColumn("comp", F.col("id"))
    return rows.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _mixed(rows: DataFrame, order: Column) -> DataFrame:
    """The buckets (c, v) whose rows lie in two or more components, with the last members by ``order`` of two: x, its component, y."""
    each = rows.groupBy("c", "v", "comp").agg(F.max(F.struct(order.alias("h"), "id")).alias("m"))
    two = each.select("c", "v", F.struct("m.h", "m.id", "comp").alias("s")).groupBy("c", "v").agg(F.max("s").alias("x"), F.min("s").alias("y"))
    return two.filter("x.comp <> y.comp").select("c", "v", F.col("x.id").alias("x"), F.col("x.comp").alias("xc"), F.col("y.id").alias("y"))


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out |= t
    return out


def _could_be_similar(side: int, similarity: int) -> Column:
    """For rows a and b that meet at left collection c: a table key in common, first met here, and sizes and sketches that allow a link."""
    sig_a, sig_b = F.col("a.sig"), F.col("b.sig")
    same = [sig_a[i] == sig_b[i] for i in range(2 * side)]
    before = _any([(F.lit(i) < F.col("a.c")) & same[i] for i in range(side)])
    na, nb = F.col("a.n"), F.col("b.n")
    differ = sum((F.bit_count(F.col("a.sketch")[i].bitwiseXOR(F.col("b.sketch")[i])) for i in range(SKETCH)), F.lit(0))
    sizes = 100 * F.least(na, nb) >= similarity * F.greatest(na, nb)
    # |A & B| / |A | B| >= s  <=>  |A ^ B| * (1 + s) <= (|A| + |B|) * (1 - s)
    return sizes & (differ * (100 + similarity) <= (na + nb) * (100 - similarity)) & _any(same[side:]) & ~before


def links_by_tables(classes: DataFrame, texts_of, side: int = SIDE, width: int = WIDTH, similarity: int = SIMILARITY, rounds: int = ROUNDS) -> DataFrame | None:
    """Components (id, comp) of classes (id, n, sig, sketch), or None if no two are candidates."""
    coll = classes.select("id", F.posexplode("sig").alias("c", "v"))
    shared = coll.groupBy("c", "v").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.count(F.lit(1)).alias("m")).filter("x <> y").select("c", "v", "m")
    hits = coll.join(shared, ["c", "v"])
    left = F.sum(F.when(F.col("c") < side, 1).otherwise(0))
    per = hits.groupBy("id").agg(left.alias("l"), F.count(F.lit(1)).alias("k"), F.sum("m").alias("central"), F.collect_list(F.struct("c", "v")).alias("cv"))
    hits = stored(per.filter("l > 0 and l < k").select("id", "central", "cv"), "op2-hits")  # at most 2 * side values a row
    total = hits.count()
    if not total:
        return None
    texts = stored(texts_of(hits.select("id")), "op2-texts")
    flat = hits.select("id", "central", F.inline("cv"))
    comps, done = None, 0

    def grown(found: DataFrame) -> DataFrame:
        """Components joined by new links between their members: only the components are links from then on."""
        ends = found
        if comps is not None:
            ends = found.unionByName(comps.filter("id <> comp").select(F.col("id").alias("a"), F.col("comp").alias("b")))
        each = components(ends)
        new = stored(each, "op2-comps")
        discard(each, found, *([] if comps is None else [comps]))
        return new

    while True:
        rows = _moved(flat, comps)
        mixed = _mixed(rows, F.col("central") if done == 0 else F.xxhash64("id", F.lit(done)))
        if done >= rounds and (not rounds or ENOUGH * new < total):
            break
        offers = rows.join(mixed, ["c", "v"]).select("id", F.when(F.col("comp") != F.col("xc"), F.col("x")).otherwise(F.col("y")).alias("p"))
        best = offers.groupBy("id", "p").agg(F.count(F.lit(1)).alias("k")).groupBy("id").agg(F.max(F.struct("k", "p")).alias("o"))
        found = stored(verified(best.select(F.least("id", "o.p").alias("a"), F.greatest("id", "o.p").alias("b")).distinct(), texts, width, similarity), "op2-links")
        new = found.count()
        done += 1
        if new:
            comps = grown(found)
        elif done >= rounds:
            break

    # all pairs that share a table key and lie in different components
    open_ = _moved(flat.filter(F.col("c") < side), comps).join(mixed.select("c", "v"), ["c", "v"])
    sizes = open_.groupBy("c", "v", "comp").agg(F.count(F.lit(1)).alias("k")).groupBy("c", "v").agg(F.max(F.struct("k", "comp")).alias("t"))
    rows = open_.join(sizes.select("c", "v", F.col("t.comp").alias("top")), ["c", "v"]).join(classes, "id")
    rows = stored(rows.select("c", "v", "id", "n", "comp", "top", "sig", "sketch"), "op2-open")
    few, many = rows.filter("comp <> top").alias("a"), rows.alias("b")
    cross = (F.col("a.comp") != F.col("b.comp")) & ((F.col("b.comp") == F.col("b.top")) | (F.col("a.id") < F.col("b.id")))
    met = few.join(many, (F.col("a.c") == F.col("b.c")) & (F.col("a.v") == F.col("b.v")) & cross & _could_be_similar(side, similarity))
    found = stored(verified(met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct(), texts, width, similarity), "op2-links")
    if not found.isEmpty():
        comps = grown(found)
    discard(hits, texts, rows)
    return comps


def near_duplicates(docs: DataFrame, side: int = SIDE, rows: int = ROWS, width: int = WIDTH, similarity: int = SIMILARITY, rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    sig = stored(signatures(docs, width, side, rows), "op2-sig")
    full = sig.filter("digest is not null and doc_id is not null")
    classes = full.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "sig", "sketch")).alias("s")).select("digest", F.col("s.doc_id").alias("id"), F.col("s.n_shingles").alias("n"), "s.sig", "s.sketch")
    classes = stored(classes, "op2-classes")

    def texts_of(ids: DataFrame) -> DataFrame:
        texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
        maybe, _ = parted(texts, F.xxhash64("id"), ids.select(F.xxhash64("id").alias("key")))
        return maybe.join(ids, "id", "left_semi")

    comps = links_by_tables(classes.select("id", "n", "sig", "sketch"), texts_of, side, width, similarity, rounds)
    named = _moved(classes.select("digest", "id"), comps).select("digest", "comp")
    out = sig.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(named, "digest", "left")
    comp: Column = F.coalesce("comp", "doc_id")
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), (F.col("doc_id").isNull() | (comp == F.col("doc_id"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, all columns unchanged."""
    found = stored(near_duplicates(docs, **options), "op2-result")
    ids = free_name("__id", docs)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias(ids)).distinct()
    twice = found.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(ids))
    twice = stored(twice, "op2-twice")
    # texts whose doc_id surely is neither go straight on; only the rest is joined
    maybe, rest = parted(docs, F.xxhash64(F.col("doc_id").cast("long")), gone.unionByName(twice).select(F.xxhash64(ids).alias("key")))
    on = F.col("doc_id") == F.col(ids)
    kept = maybe.join(gone, on, "left_anti")
    if not twice.isEmpty():
        kept = kept.join(twice, on, "left_anti").unionByName(kept.join(twice, on, "left_semi").dropDuplicates(["doc_id"]))
    return rest.unionByName(kept)
