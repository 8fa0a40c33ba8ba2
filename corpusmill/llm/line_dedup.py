"""Operator 5: line dedup by an exact set-similarity join.

A line's set holds its distinct words (A-Z lower-cased). Lines of equal sets are one class, placed at
its first line in the order of (doc_id, line number). A line goes if an
earlier line of its class, or of a class at Jaccard similarity ``threshold`` or more, exists,
whether or not that one goes itself.

Words are ordered by rarity, and of a set of n only the first n - ceil(t n) + 1 are posted:
two similar sets share one of these. Posted pairs must pass
the length filter, the positional filter and a 128-bit parity filter (each word flips one of 128 bits, so bits that
differ are a lower bound of the symmetric difference), none of which loses a similar pair; what is left is verified on
the full texts. Word counts cover all lines; the counts of the ``FREQUENT`` most frequent words
are sent to the tasks (the bound of that broadcast), others rank as rarer. Any fixed order gives the same result.

Hot groups. A class needs one earlier similar class to go. So classes are first compared with
the earliest class that shares their rarest and second rarest word, which settles large groups of
variants at linear cost; then every class not settled is joined with all
classes before it over all posted words. At first a class keeps ``KEPT`` pairs of each word it
posts, so a group makes rows in proportion to its postings; its likeliest pair is verified first, then the others if that is none. For
the classes that these do not settle, the words by which they met more are joined again and all pairs are taken. Nothing is capped.

The join is dealt out by word to buckets, whose number grows with the postings. A task packs its postings of
a bucket column by column into one row, so the exchange holds bytes and few rows; a bucket sorts them by (word, size) and
compares a posting only with those of the word that are small enough and not too small, ``PAIRS`` at a time. A word
that more than ``CROWD`` classes post (looked for among the frequent ones; all others are rarer) is cut into parts, and each two
parts meet in a bucket of their own.

Texts for verification are fetched by document: a bitmap of hashed doc_ids of fixed size, 8 MB at most
whatever the input, is broadcast to leave out most others before the join on doc_id.

Defined results: null or empty text is one empty line; lines without words never go;
texts of any length are cut whole, once; other columns are not read (``dedup_lines`` returns them unchanged, whatever their names); rows without doc_id come first in the order; rows that repeat a doc_id are compared like
one document, and lines at the same place of them never remove each other unless their sets are equal: then one copy stays in each row; an
empty table gives an empty result.
"""
from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import TEXT_BYTES, discard, free_name, map_slices, parted, stored, strings
from corpusmill.llm.phrases import _has, bitmap
from corpusmill.llm.shingles import chunk_hashes, mix, word_hashes

THRESHOLD = 0.75
FREQUENT = 1 << 16
#: A word is counted for rarity if a slice of text has it in so many lines.
COMMON = 4
ROUNDS = 2
#: Bits of the parity sketch by which pairs are tested before their texts are.
SKETCH = 512
#: Classes that post a word, above which their pairs are dealt out to several buckets.
CROWD = 1 << 14
#: Postings a bucket holds about, and buckets there are at least.
BUCKET, BUCKETS = 1 << 18, 256
#: Postings a task holds before it hands them on, and pairs that a bucket looks at in one step.
HELD, PAIRS = 1 << 19, 1 << 21
#: Pairs that a class keeps of each word it posts, before all are taken of those classes that these do not settle.
KEPT = 4
#: Bits of the bitmap of wanted documents, as a power of two.
BITMAP = 26
#: Bits of a word's hash or place by which the words of a line are sorted at first.
RARITY_BITS = 41
#: Beginnings of hashes by which known words are looked up, as a power of two.
SLOTS = 20


def line_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, number, line, word hash) as arrays: text and number of each line; line and hash of each word, repeated ones too."""
    wide = texts.cast(pa.large_binary())
    off = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    feeds = np.flatnonzero(data == 10)
    n = np.diff(np.searchsorted(feeds, off)) + 1
    text = np.repeat(np.arange(len(n)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    begins = np.sort(np.concatenate([off[:-1], feeds + 1]), kind="stable")
    # words end where a text does, too: a line feed after each text
    data, shift = np.insert(data, off[1:], 10), np.arange(len(n))
    space = (data == 32) | (data - np.uint8(9) < 5)
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(data) and not space[0]:
        edge = np.concatenate([[0], edge])
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    line = np.repeat(np.arange(len(text)), np.diff(np.append(np.searchsorted(starts, begins + shift[text]), len(starts))))
    return text, number, line, chunk_hashes(data, starts, lengths)


def _first(line: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Of sorted (line, word), which are the first of their kind."""
    new = np.ones(len(words), dtype=bool)
    new[1:] = (line[1:] != line[:-1]) | (words[1:] != words[:-1])
    return new


def frequent_words(docs: DataFrame, most: int = FREQUENT, common: int = COMMON) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts) of the most frequent words, sorted by hash."""

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            _, _, line, words = line_sets(strings(part, "text"))
            # one number a word; what it fails to bring together counts twice, which changes the order only
            order = np.argsort(line.astype(np.uint64) << np.uint64(RARITY_BITS) | words >> np.uint64(64 - RARITY_BITS), kind="stable")
            line, words = line[order], words[order]
            words, n = np.unique(words[_first(line, words)], return_counts=True)
            some = n >= common
            return pa.RecordBatch.from_arrays([pa.array(words[some].view(np.int64)), pa.array(n[some])], names=["w", "n"])

        return one

    counts = map_slices(docs.select("text"), "text", make, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "w").limit(most).toArrow()
    w, n = top["w"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(w)
    return w[order], n[order]


class Rarity:
    """The order of words by rarity: unknown ones by hash, then the known ones by count and hash."""

    def __init__(self, known: np.ndarray, counts: np.ndarray, bits: int = RARITY_BITS):
        self.known, self.bits = known, bits
        self.place = np.empty(len(known), np.uint64)
        self.place[np.lexsort((known, counts))] = np.arange(1, len(known) + 1, dtype=np.uint64)
        # where the known words of each beginning (``SLOTS`` bits) stand
        self.first = np.searchsorted(known >> np.uint64(64 - SLOTS), np.arange((1 << SLOTS) + 1, dtype=np.uint64)).astype(np.int32)

    def places(self, words: np.ndarray) -> np.ndarray:
        """Places of the words from 1 on; 0: not known."""
        out = np.zeros(len(words), np.uint64)
        slot = (words >> np.uint64(64 - SLOTS)).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        left = np.flatnonzero(at < end)
        at, end, own = at[left], end[left], words[left]
        while len(left):
            hit = self.known[at] == own
            out[left[hit]] = self.place[at[hit]]
            more = ~hit & (at + 1 < end)
            left, at, end, own = left[more], at[more] + 1, end[more], own[more]
        return out

    def sort(self, line: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(line, word) by line, which ascends already, then rarity: sorted by one number a word, that holds its line and ``bits`` of its
        place or hash; in full where that does not tell words apart."""
        place, bits = self.places(words), self.bits
        if not len(line) or (int(line[-1]) < 1 << (63 - bits) and len(self.known) < 1 << bits):
            of = np.where(place > 0, place | np.uint64(1 << bits), words >> np.uint64(64 - bits))
            key = line.astype(np.uint64) << np.uint64(bits + 1) | of
            order = np.argsort(key, kind="stable")
            key, w = key[order], words[order]
            if not np.any((key[1:] == key[:-1]) & (w[1:] != w[:-1])):
                return line[order], w
        order = np.lexsort((words, place, line))
        return line[order], words[order]


def prefixes(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """One row a line with words: doc_id, line, digest (d1, d2) of its set, size n, parity bits (low, high), prefix (posted words, rarest first)."""
    t = Fraction(threshold).limit_denominator(1000)
    known, counts = frequent

    def make():
        rarity = Rarity(known, counts)

        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            text, number, line, words = line_sets(strings(part, "text"))
            line, words = rarity.sort(line, words)
            new = _first(line, words)
            line, words = line[new], words[new]
            has, starts, n = np.unique(line, return_index=True, return_counts=True)
            if not len(has):
                return None
            posted = n - -(-n * t.numerator // t.denominator) + 1
            place = np.arange(len(words)) - np.repeat(starts, n)
            keep = place < np.repeat(posted, n)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(posted)]).astype(np.int32), (words[keep] >> np.uint64(32)).astype(np.uint32).view(np.int32))
            bins = (words >> np.uint64(57)).astype(np.int64)
            low, high = (np.bitwise_xor.reduceat(np.where(bins >> 6 == k, np.uint64(1) << (words >> np.uint64(57) & np.uint64(63)), np.uint64(0)), starts) for k in (0, 1))
            d1, d2 = (np.add.reduceat(mix(words ^ np.uint64(s)), starts).view(np.int64) for s in (0xA5A5, 0x5A5A5A))
            docs_of = part.column("doc_id").take(pa.array(text[has]))
            return pa.RecordBatch.from_arrays(
                [docs_of, pa.array(number[has].astype(np.int32)), pa.array(d1), pa.array(d2), pa.array(n.astype(np.int32)), pa.array(low.view(np.int64)), pa.array(high.view(np.int64)), lists],
                names=["doc_id", "line", "d1", "d2", "n", "low", "high", "prefix"],
            )

        return one

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", make, "doc_id long, line int, d1 long, d2 long, n int, low long, high long, prefix array<int>")


def _filters(t: Fraction, a: str, b: str) -> Column:
    """Length and parity filter of rows prefixed a and b."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    ok = F.least(na, nb) * t.denominator >= F.greatest(na, nb) * t.numerator
    # overlap needed: (na + nb) * t / (1 + t); symmetric difference allowed: (na + nb) * (1 - t) / (1 + t)
    differ = sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in ("low", "high")), F.lit(0))
    return ok & (differ * (t.denominator + t.numerator) <= (na + nb) * (t.denominator - t.numerator))


#: A posting: word, part (of a crowded word), doc_id, line, size, place in the prefix, parity bits (low, high), flags (1: doc_id is not null, 2: open).
_POSTING = [np.dtype(x) for x in ("u4", "i4", "i8", "i4", "i4", "i4", "i8", "i8", "u1")]


def _packed(columns: list[np.ndarray]) -> bytes:
    """The columns of some postings, byte plane by byte plane (high bytes are mostly zero)."""
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)


def _unpacked(rows: list[bytes]) -> list[np.ndarray]:
    """The columns of the postings of several ``_packed``."""
    out: list[list[np.ndarray]] = [[] for _ in _POSTING]
    for row in rows:
        data, n = np.frombuffer(row, np.uint8), len(row) // sum(d.itemsize for d in _POSTING)
        at = 0
        for column, d in zip(out, _POSTING):
            planes = data[at : at + n * d.itemsize].reshape(d.itemsize, n)
            column.append(np.ascontiguousarray(planes.T).view(d).reshape(n))
            at += n * d.itemsize
    return [np.concatenate(c) for c in out]


def crowded(classes: DataFrame, frequent: tuple[np.ndarray, np.ndarray], crowd: int = CROWD) -> tuple[np.ndarray, np.ndarray]:
    """(posted words, parts) of the words that more than ``crowd`` classes post, sorted; only frequent words can be."""
    hashes, counts = frequent
    some = np.unique((hashes[counts > crowd] >> np.uint64(32)).astype(np.uint32))
    if not len(some):
        return some, np.zeros(0, np.int64)

    def run(batches):
        n = np.zeros(len(some), np.int64)
        for batch in batches:
            w = batch.column("prefix").flatten().to_numpy().view(np.uint32)
            i = np.minimum(np.searchsorted(some, w), len(some) - 1)
            n += np.bincount(i[some[i] == w], minlength=len(some))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["i", "n"])

    found = classes.select("prefix").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).filter(F.col("n") > crowd).orderBy("i").toArrow()
    return some[found["i"].to_numpy()], -(-found["n"].to_numpy() // crowd)


def posted(classes: DataFrame, frequent: tuple[np.ndarray, np.ndarray], crowd: int = CROWD) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
    """How many words the classes post in all, and those that are ``crowded``."""
    return classes.agg(F.sum(F.size("prefix"))).first()[0] or 0, crowded(classes, frequent, crowd)


def postings(classes: DataFrame, buckets: int, crowds: tuple[np.ndarray, np.ndarray], words: np.ndarray | None = None) -> DataFrame:
    """(bucket, posts) from classes (d, l, n, low, high, open, prefix): their postings, packed; those of a word and part share a bucket.

    words: bitmap; postings of words that it has not are left out."""
    hot, parts = crowds

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        prefix = batch.column("prefix")
        m = np.diff(prefix.offsets.to_numpy())
        w = prefix.flatten().to_numpy().view(np.uint32)
        at = np.arange(len(w)) - np.repeat(np.cumsum(m) - m, m)
        d, l, n, low, high = (pc.fill_null(batch.column(c), 0).to_numpy() for c in ("d", "l", "n", "low", "high"))
        flags = batch.column("d").is_valid().to_numpy(zero_copy_only=False) + 2 * batch.column("open").to_numpy(zero_copy_only=False).astype(np.uint8)
        row = np.repeat(np.arange(len(m)), m)
        if words is not None:
            some = _has(words, w.astype(np.uint64))
            w, at, row = w[some], at[some], row[some]
        part = np.zeros(len(w), np.int64)
        if len(hot):
            i = np.minimum(np.searchsorted(hot, w), len(hot) - 1)
            k = np.where(hot[i] == w, parts[i], 1)
            own = (mix(d.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + l.astype(np.uint64))[row] % k.astype(np.uint64)).astype(np.int64)
            # a crowded word's posting goes to one bucket for each part that its own part meets
            again = np.repeat(np.arange(len(w)), k)
            other = np.arange(len(again)) - np.repeat(np.cumsum(k) - k, k)
            w, at, row, own, k = w[again], at[again], row[again], own[again], k[again]
            part = np.where(k > 1, np.minimum(own, other) * k + np.maximum(own, other) + 1, 0)
        return [c.astype(t, copy=False) for c, t in zip((w, part, d[row], l[row], n[row], at, low[row], high[row], flags[row]), _POSTING)]

    def out(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        cols = [np.concatenate(c) for c in zip(*held)]
        bucket = (mix(cols[0].astype(np.uint64) + (cols[1].astype(np.uint64) << np.uint64(32))) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((cols[0], bucket))
        bucket, cols = bucket[order], [c[order] for c in cols]
        has, starts = np.unique(bucket, return_index=True)
        ends = np.append(starts[1:], len(bucket))
        rows = [_packed([c[i:j] for c in cols]) for i, j in zip(starts.tolist(), ends.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(has), pa.array(rows, pa.binary())], names=["bucket", "posts"])

    def run(batches):
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append(columns(batch))
            if sum(len(c[0]) for c in held) > HELD:
                yield out(held)
                held = []
        if sum(len(c[0]) for c in held):
            yield out(held)

    return classes.select("d", "l", "n", "low", "high", "open", "prefix").mapInArrow(run, "bucket int, posts binary")


def _meet(rows: list[bytes], t: Fraction, every: bool, step: int = PAIRS):
    """Yields (ad, al, bd, bl, score, word) from a bucket's postings of the same word whose b is open, a stands before b, and
    that pass the filters; score: share of parity bits that differ. All such pairs, or ``KEPT`` for each b and then, for those
    that met more, the pair of the least score once more with the word (else null)."""
    w, part, d, l, n, at, bits, more, flags = _unpacked(rows)
    order = np.lexsort((n, part, w))
    w, part, d, l, n, at, bits, more, flags = (c[order] for c in (w, part, d, l, n, at, bits, more, flags))
    n, at = n.astype(np.int64), at.astype(np.int64)
    known, open_ = (flags & 1).astype(bool), flags > 1
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (part[1:] != part[:-1])
    group = np.cumsum(new) << 32
    both = t.denominator + t.numerator
    # of two similar sets, the smaller one's place leaves room for the overlap with a set of its own size at least
    small = np.flatnonzero((n - at) * both >= 2 * n * t.numerator)
    low = np.searchsorted((group + n)[small], group - (-n * t.numerator // t.denominator))
    high = np.searchsorted(small, np.arange(len(w)))
    reach = np.maximum(high - low, 0)
    total = np.cumsum(reach)
    least, of, found = np.full(len(w), np.inf), np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)

    def columns(a: np.ndarray, b: np.ndarray, score: np.ndarray, more: bool) -> list[pa.Array]:
        return [pa.array(d[a], mask=~known[a]), pa.array(l[a]), pa.array(d[b], mask=~known[b]), pa.array(l[b]), pa.array(score), pa.array(w[b].view(np.int32), mask=np.full(len(b), not more))]

    start = 0
    while start < len(w):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + step, side="right")))
        r = reach[start:end]
        i = np.repeat(np.arange(start, end), r)
        j = small[np.arange(len(i)) - np.repeat(np.cumsum(r) - r, r) + np.repeat(low[start:end], r)]
        start = end
        # holds at the first word that two similar sets share, which is enough
        ok = np.minimum(n[i] - at[i], n[j] - at[j]) * both >= (n[i] + n[j]) * t.numerator
        i, j = i[ok], j[ok]
        differ = sum(np.bitwise_count((x[i] ^ x[j]).view(np.uint64)).astype(np.int64) for x in (bits, more))
        ok = differ * both <= (n[i] + n[j]) * (t.denominator - t.numerator)
        i, j, score = i[ok], j[ok], differ[ok] / (n[i] + n[j])[ok]
        same = (known[i] == known[j]) & (d[i] == d[j])
        before = np.where(same, l[i] < l[j], ~known[i] & known[j] | (known[i] == known[j]) & (d[i] < d[j]))
        after = np.where(same, l[j] < l[i], ~before)
        a, b = np.where(before, i, j), np.where(before, j, i)
        ok = (before | after) & open_[b]
        a, b, score = a[ok], b[ok], score[ok]
        if not every and len(a):
            order = np.lexsort((score, b))
            a, b, score = a[order], b[order], score[order]
            first = np.flatnonzero(_first(b, b))
            m = np.diff(np.append(first, len(b)))
            place = np.arange(len(b)) - np.repeat(first, m) + found[b]
            low_b = b[first]
            found[low_b] += m
            better = score[first] < least[low_b]
            least[low_b[better]], of[low_b[better]] = score[first][better], a[first][better]
            few = place < KEPT
            a, b, score = a[few], b[few], score[few]
        if len(a):
            yield columns(a, b, score, False)
    b = np.flatnonzero(found > KEPT)
    if len(b):
        yield columns(of[b], b, least[b], True)


def met(classes: DataFrame, frequent: tuple[np.ndarray, np.ndarray], t: Fraction, crowd: int = CROWD, words: np.ndarray | None = None,
        sizes: tuple[int, tuple[np.ndarray, np.ndarray]] | None = None) -> DataFrame:
    """Of classes (d, l, n, low, high, open, prefix), those that may be similar, a before b, b open, by posted words.

    Without words: pairs ad, al, bd, bl, score (share of parity bits that differ) and word: ``KEPT`` of each posting of a b, and with a word
    (else null) one of each word by which it met more.
    With words (a bitmap): all pairs ad, al, bd, bl that share a posted word in it.
    sizes: what ``posted`` tells of the classes, if that is known."""
    total, crowds = sizes or posted(classes, frequent, crowd)
    types = [("ad", pa.int64()), ("al", pa.int32()), ("bd", pa.int64()), ("bl", pa.int32()), ("score", pa.float64()), ("word", pa.int32())]
    schema, every = pa.schema(types), words is not None

    def run(bucket: pa.Table) -> pa.Table:
        return pa.Table.from_batches([pa.RecordBatch.from_arrays(p, schema=schema) for p in _meet(bucket["posts"].to_pylist(), t, every)], schema)

    posts = postings(classes, max(BUCKETS, total // BUCKET), crowds, words)
    found = posts.groupBy("bucket").applyInArrow(run, "ad long, al int, bd long, bl int, score double, word int")
    if every:
        return found.select("ad", "al", "bd", "bl").distinct()
    return found.groupBy("ad", "al", "bd", "bl", "word").agg(F.min("score").alias("score"))


def _wanted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents (d, text) that may be among ``ids`` (d): all of those, few others, no shuffle of texts."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << BITMAP))
    word = ids.select(bit("d").alias("h")).distinct().groupBy(F.shiftright("h", 6).alias("__w")).agg(F.bit_or(F.expr("shiftleft(1L, int(h % 64))")).alias("__bits"))
    t = docs.select(F.col("doc_id").cast("long").alias("d"), "text").withColumn("h", bit("d"))
    j = t.join(F.broadcast(word), F.shiftright("h", 6) == F.col("__w"))  # 2 ** (BITMAP - 6) rows at most
    return j.filter(F.expr("shiftright(__bits, int(h % 64)) & 1L") == 1).select("d", "text")


def _distinct_words(lines: pa.Array) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """How many distinct words each line has, and (line, word) of all of them."""
    off, words = word_hashes(lines)
    line = np.repeat(np.arange(len(lines)), np.diff(off))
    order = np.lexsort((words, line))
    line, words = line[order], words[order]
    new = _first(line, words)
    return np.bincount(line[new], minlength=len(lines)), (line[new], words[new])


def _verified(pairs: DataFrame, docs: DataFrame, t: Fraction) -> DataFrame:
    """The ends (d, l) of b of the pairs (ad, al, bd, bl) whose lines are similar."""
    ends = pairs.select(F.col("ad").alias("d"), F.col("al").alias("l")).unionByName(pairs.select(F.col("bd").alias("d"), F.col("bl").alias("l"))).distinct()
    per_doc = stored(ends.groupBy(F.col("d").alias("e")).agg(F.collect_list("l").alias("ls")), "op5-ends")  # at most a document's lines
    known = _wanted(docs, per_doc.select(F.col("e").alias("d"))).join(per_doc, F.col("d").eqNullSafe(F.col("e")))

    def pick():
        """Each text is cut into lines once, however many of them are wanted."""

        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            out: list[tuple] = []
            for d, ls, text in zip(part.column("d").to_pylist(), part.column("ls").to_pylist(), strings(part, "text").to_pylist()):
                own = text.split("\n")
                out += [(d, i, own[i]) for i in ls if i < len(own)]
            d, at, x = zip(*out) if out else ((), (), ())
            x = pa.array(x, pa.string())
            n, (line, words) = _distinct_words(x)
            odd = np.bincount(line * SKETCH + (words >> np.uint64(32)).astype(np.int64) % SKETCH, minlength=SKETCH * len(x)).astype(np.uint8) & 1
            sketch = np.packbits(odd.reshape(len(x), SKETCH), axis=1).view(np.int64).ravel()
            sketch = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * (SKETCH // 64), sketch)
            return pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(at, pa.int32()), x, pa.array(n.astype(np.int32)), sketch], names=["d", "l", "x", "n", "s"])

        return one

    lines = stored(map_slices(known.select("d", "ls", "text"), "text", pick, "d long, l int, x string, n int, s array<long>", TEXT_BYTES >> 1), "op5-texts")

    def make():
        def one(part: pa.RecordBatch) -> pa.RecordBatch:
            (na, ka), (nb, kb) = _distinct_words(strings(part, "x")), _distinct_words(strings(part, "y"))
            row, word = np.concatenate([ka[0], kb[0]]), np.concatenate([ka[1], kb[1]])
            order = np.lexsort((word, row))
            row, word = row[order], word[order]
            both = np.bincount(row[1:][~_first(row, word)[1:]], minlength=part.num_rows)
            ok = (both * t.denominator >= (na + nb - both) * t.numerator) & (both > 0)
            return part.select(["d", "l"]).filter(pa.array(ok, pa.bool_()))

        return one

    x = lines.select(F.col("d").alias("xd"), F.col("l").alias("xl"), "x", F.col("n").alias("xn"), F.col("s").alias("xs"))
    y = lines.select(F.col("d").alias("yd"), F.col("l").alias("yl"), F.col("x").alias("y"), F.col("n").alias("yn"), F.col("s").alias("ys"))
    # again a lower bound of the symmetric difference, by more bits
    differ = sum((F.bit_count(F.col("xs")[i].bitwiseXOR(F.col("ys")[i])) for i in range(SKETCH // 64)), F.lit(0))
    ok = differ * (t.denominator + t.numerator) <= (F.col("xn") + F.col("yn")) * (t.denominator - t.numerator)
    j = pairs.join(x, _same("ad", "al", "xd", "xl")).join(y, _same("bd", "bl", "yd", "yl") & ok)
    out = stored(map_slices(j.select(F.col("bd").alias("d"), F.col("bl").alias("l"), "x", "y"), "x", make, "d long, l int").distinct(), "op5-settled")
    discard(per_doc, lines)
    return out


def later_matches(docs: DataFrame, threshold: float = THRESHOLD, most: int = FREQUENT, rounds: int = ROUNDS, crowd: int = CROWD) -> DataFrame:
    """One row a line with words: doc_id, line, first_doc, first_line (its class's first line), gone."""
    t = Fraction(threshold).limit_denominator(1000)
    frequent = frequent_words(docs, most)
    wide = stored(prefixes(docs, frequent, threshold), "op5-prefixes")
    first = F.min(F.struct("doc_id", "line"))
    classes = wide.groupBy("d1", "d2").agg(first.alias("p"), *(F.first(c).alias(c) for c in ("n", "low", "high", "prefix")))
    classes = stored(classes.select("d1", "d2", F.col("p.doc_id").alias("d"), F.col("p.line").alias("l"), "n", "low", "high", "prefix"), "op5-classes")
    lines = stored(wide.select("doc_id", "line", "d1", "d2"), "op5-lines")
    discard(wide)
    settled: list[DataFrame] = []

    def left_over(frame: DataFrame, d: str = "d", l: str = "l") -> DataFrame:
        for s in settled:
            known = s.select(F.col("d").alias("__d"), F.col("l").alias("__l"))
            frame = frame.join(known, _same(d, l, "__d", "__l"), "left_anti")
        return frame

    for k in range(rounds):
        open_ = left_over(classes.select(F.get("prefix", F.lit(k)).alias("w"), "d", "l", "n", "low", "high")).filter("w is not null")
        leader = open_.groupBy("w").agg(F.min(F.struct("d", "l", "n", "low", "high")).alias("a"), F.count(F.lit(1)).alias("m")).filter("m > 1").select("w", "a")
        near = open_.alias("b").join(leader, "w").filter(_before("a", "b") & _filters(t, "a", "b"))
        pairs = stored(near.select(F.col("a.d").alias("ad"), F.col("a.l").alias("al"), F.col("b.d").alias("bd"), F.col("b.l").alias("bl")), "op5-pairs")
        settled.append(_verified(pairs, docs, t))
        discard(pairs)

    marked = classes.withColumn("open", F.lit(True))
    if settled:
        # classes whose place surely is not settled go straight on; only the rest is joined
        place = F.xxhash64("d", "l")
        maybe, rest = parted(classes, place, _union(settled).select(F.xxhash64("__d", "__l").alias("key")))
        there = maybe.join(_union(settled), _same("d", "l", "__d", "__l"), "left").withColumn("open", F.col("__l").isNull()).drop("__d", "__l")
        marked = rest.withColumn("open", F.lit(True)).unionByName(there)
    sizes = posted(classes, frequent, crowd)  # both joins post the words of the same classes
    pairs = stored(met(marked, frequent, t, crowd, sizes=sizes), "op5-pairs")
    best = pairs.groupBy("bd", "bl").agg(F.min(F.struct("score", "ad", "al")).alias("o")).select("o.ad", "o.al", "bd", "bl")
    settled.append(_verified(stored(best, "op5-best"), docs, t))
    others = stored(left_over(pairs, "bd", "bl"), "op5-others")
    discard(pairs)
    settled.append(_verified(others.select("ad", "al", "bd", "bl").distinct(), docs, t))
    left = left_over(others.filter("word is not null"), "bd", "bl").select(F.col("bd").alias("__d"), F.col("bl").alias("__l"), "word")
    left = stored(left.distinct(), "op5-left")
    if not left.isEmpty():
        # all pairs of the classes that are still open, by the words that have more
        words = bitmap(left.select(F.expr("word & 4294967295L").alias("id")).distinct())
        place = F.xxhash64("d", "l")
        maybe, rest = parted(classes, place, left.select(F.xxhash64("__d", "__l").alias("key")))
        there = maybe.join(left.select("__d", "__l").distinct(), _same("d", "l", "__d", "__l"), "left").withColumn("open", F.col("__l").isNotNull()).drop("__d", "__l")
        pairs = stored(met(rest.withColumn("open", F.lit(False)).unionByName(there), frequent, t, crowd, words, sizes), "op5-pairs")
        settled.append(_verified(pairs, docs, t))
        discard(pairs)
    discard(others, left)
    named = classes.join(_union(settled), _same("d", "l", "__d", "__l"), "left").select("d1", "d2", "d", "l", F.col("__l").isNotNull().alias("match"))
    out = lines.join(named, ["d1", "d2"])
    later = ~(F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line") == F.col("l")))
    return out.select("doc_id", "line", F.col("d").alias("first_doc"), F.col("l").alias("first_line"), (F.col("match") | later).alias("gone"))


def _before(a: str, b: str) -> Column:
    """a's line comes before b's; a null doc_id is the first of all."""
    ad, bd = F.col(f"{a}.d"), F.col(f"{b}.d")
    earlier = F.coalesce(ad < bd, ad.isNull() & bd.isNotNull())
    return earlier | (ad.eqNullSafe(bd) & (F.col(f"{a}.l") < F.col(f"{b}.l")))


def _same(d: str, l: str, d2: str, l2: str) -> Column:
    return F.col(d).eqNullSafe(F.col(d2)) & (F.col(l) == F.col(l2))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct().select(F.col("d").alias("__d"), F.col("l").alias("__l"))


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per doc_id that loses lines: doc_id, gone (their numbers, sorted)."""
    gone = later_matches(docs, threshold).filter("gone")
    return gone.groupBy("doc_id").agg(F.sort_array(F.collect_list("line")).alias("gone"))


def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """The texts without the lines of these numbers."""
    out = []
    for text, numbers in zip(texts, gone):
        lost = set() if numbers is None else set(numbers.tolist())
        out.append(text if not lost or text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in lost))
    return pd.Series(out, dtype=object)


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the lines that go cut out of ``text``; other columns unchanged; null text stays null."""
    ids, gone = free_name("__id", docs), free_name("__gone", docs)
    lost = removed_lines(docs, threshold).select(F.col("doc_id").alias(ids), F.col("gone").alias(gone))
    j = docs.join(lost, F.col("doc_id").cast("long").eqNullSafe(F.col(ids)), "left")
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.pandas_udf(_without, "string")("text", gone))
    return j.select(*(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns))
