"""Operator 13: phrase collocations by marginalising the longest windows.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and pieces into words
``[^\\x20\\x09]+``. Each word leads one window: lead columns w1..w5 hold it and the four
words after it, padded where the piece ends. Only these longest windows are
counted; every shorter phrase starts exactly one window, so Spark's ROLLUP over (w1, ..., w5) sums them
to the counts of all prefixes, that is of all phrases, in one aggregate.

A word is the 64-bit hash of (language, word), so the key of a phrase holds its language. The vocabulary
is counted by the words themselves; if two of its rows share a hash, another seed is
taken, so counts are exact.

Windows are thinned before they are counted, without changing any count that matters: a phrase
counted ``least`` times holds only words, pairs and triples of words counted ``least`` times. So a
window is padded from its first triple on that is rarer. Which words, pairs and triples are frequent is
told to the tasks by bitmaps of fixed size (2 ** FILTER bits each, 8 MB). Pairs and triples are counted by a 40-bit
hash: what shares one only looks more frequent, and a false hit only leaves a longer window.
Words are summed in a slice of text, pairs, triples and windows in the whole task before they are shuffled, and by Spark's partial
aggregates, so a hot one is a few rows a task.

Every cut of a candidate has parts that are at least as frequent, so all counts needed are at hand.
Scores are floor(1000 * a * n / (l * r)) in DECIMAL(38); counts up to 10 ** 17 fit.

Defined results: null text is empty; null language is ``und``; doc_id is not read, so repeated rows count again;
a text is always read whole, a piece may be as long as it; ties in rank go by score, count, then phrase in byte order;
an empty table gives an empty result; other columns are not read, whatever their names.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.common import discard, map_slices, stored, strings, text_slices
from corpusmill.llm.passages import word_steps
from corpusmill.llm.shingles import mix

LONGEST = 5
LEAST = 100
SHARE = 100
TOP = 2000
#: Windows are thinned by frequent runs of up to so many words.
THINNED = 3
#: Bits of a bitmap, as a power of two.
FILTER = 26
#: Bytes of text whose words are summed before they leave the task.
SLICE = 4 << 20
#: Rows of counts that a task holds and adds up before it hands them on.
HELD = 1 << 20
#: Bytes that end a piece, and those that separate its words.
PIECE_END, WORD_END = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(WORD_END)] = 1
_KIND[list(PIECE_END)] = 2
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, dtype=np.uint64))


@lru_cache(4)
def _byte_values(seed: int) -> np.ndarray:
    values = np.random.Generator(np.random.PCG64(40_013 + seed)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[_KIND > 0] = 0
    return values


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = texts.cast(pa.large_binary())
    off = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def _hashes(data: np.ndarray, starts: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the words that begin at ``starts``; bytes that separate them add nothing."""
    values, out = _byte_values(seed), np.zeros(len(starts), np.uint64)
    edge = np.append(starts, len(data))
    for i, j in word_steps(starts, len(data)):
        at = edge[i:j]
        place = np.arange(edge[i], edge[j]) - np.repeat(at, np.diff(edge[i : j + 1]))
        out[i:j] = np.add.reduceat(values[data[edge[i] : edge[j]]] * _POWER[place & 0xFFFF], at - edge[i])
    return mix(out)


class Words:
    """The words of a slice of documents, in order."""

    def __init__(self, batch: pa.RecordBatch, seed: int):
        raw, off = _bytes_of(strings(batch, "text"))
        # a line feed after each text ends its last piece
        self.data = _LOWER[np.insert(raw, off[1:], 0x0A)]
        off = off + np.arange(len(off))
        kind = _KIND[self.data]
        apart = kind > 0
        before = np.ones(len(apart), bool)
        before[1:] = apart[:-1]
        self.starts = np.flatnonzero(before & ~apart)
        self.lengths = np.flatnonzero(apart & ~before) - self.starts
        text = np.searchsorted(off, self.starts, side="right") - 1
        langs = strings(batch, "lang").dictionary_encode()
        salt = np.array([hash_of(g, seed) for g in langs.dictionary.to_pylist()], np.uint64)
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy()[text]
        self.ids = _salted(_hashes(self.data, self.starts, seed), salt, self.lang)
        # whether the next word follows in the same piece
        piece = np.searchsorted(np.flatnonzero(kind == 2), self.starts)
        self.joined = np.zeros(len(text), bool)
        self.joined[:-1] = piece[1:] == piece[:-1]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()


def hash_of(name: str, seed: int) -> int:
    """A language's share of its words' ids."""
    return int.from_bytes(hashlib.blake2b(f"{seed} {name}".encode(), digest_size=8).digest())


def _salted(hashes: np.ndarray, salt: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Ids of words; 0 is left for the pad."""
    ids = mix(hashes ^ salt[lang]) if len(hashes) else np.zeros(0, np.uint64)
    ids[ids == 0] = 1
    return ids


def word_ids(langs: pa.Array, words: pa.Array, seed: int) -> np.ndarray:
    """The ids that ``Words`` gives to these words."""
    coded = langs.dictionary_encode()
    salt = np.array([hash_of(g, seed) for g in coded.dictionary.to_pylist()], np.uint64)
    data, off = _bytes_of(words)
    return _salted(_hashes(data, off[:-1], seed), salt, coded.indices.to_numpy())


def run_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """40-bit hashes of all runs of ``size`` ids; used to thin windows only."""
    h = ids[: len(ids) - size + 1].copy()
    for k in range(1, size):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + ids[k : len(ids) - size + 1 + k])
    return h >> np.uint64(24)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def _summed(columns: list[np.ndarray], n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of the columns, where each stands first (by sort), and the sum of its n (else how often it stands)."""
    order = np.lexsort(columns[::-1])
    rows = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in rows])
    at = np.flatnonzero(new)
    total = np.diff(np.append(at, len(order))) if n is None else np.add.reduceat(n[order], at) if len(at) else n
    return [c[at] for c in rows], order[at], total


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def _slices(docs: DataFrame, seed: int, one: Callable[[Words], pa.RecordBatch], schema: str) -> DataFrame:
    return map_slices(_source(docs), "text", lambda: lambda batch: one(Words(batch, seed)), schema, SLICE)


def _task_sums(docs: DataFrame, seed: int, one: Callable[[Words], list[np.ndarray]], names: list[str]) -> DataFrame:
    """(names..., n): the rows that ``one`` makes of each slice, counted over the whole task; about ``HELD`` rows are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list[np.ndarray], np.ndarray]] = []

        def merged() -> tuple[list[np.ndarray], np.ndarray]:
            columns, _, n = _summed([np.concatenate(c) for c in zip(*(c for c, _ in held))], np.concatenate([n for _, n in held]))
            return columns, n

        def out() -> pa.RecordBatch:
            (columns, n), = held
            return pa.RecordBatch.from_arrays([*(_signed(c) for c in columns), pa.array(n)], names=[*names, "n"])

        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                columns, _, n = _summed(one(Words(part, seed)))
                held.append((columns, n))
                if sum(len(n) for _, n in held) > HELD:
                    held = [merged()]
                    if len(held[0][1]) > HELD // 2:
                        yield out()
                        held = []
        if held:
            held = [merged()]
            yield out()

    return _source(docs).mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "n"]))


def vocabulary(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(lang, word, f, id) of all words."""

    def one(words: Words) -> pa.RecordBatch:
        _, at, n = _summed([words.ids])
        names = pa.array([words.word(i) for i in at.tolist()], pa.binary()).cast(pa.string())
        langs = words.langs.take(pa.array(words.lang[at]))
        return pa.RecordBatch.from_arrays([langs, names, pa.array(n)], names=["lang", "word", "n"])

    def named(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _signed(word_ids(batch.column("lang"), batch.column("word"), seed))], names=["lang", "word", "f", "id"])

    rows = _slices(docs, seed, one, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    return rows.mapInArrow(named, "lang string, word string, f long, id long")


def bitmap(ids: DataFrame) -> np.ndarray:
    """The bits ``id mod 2 ** FILTER`` of all ids, as 64-bit words: of fixed size, whatever the number of ids."""
    bit = F.col("id").bitwiseAND(F.lit((1 << FILTER) - 1))
    words = ids.select(F.shiftright(bit, 6).alias("w"), F.expr("shiftleft(1L, int(id & 63))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (FILTER - 6), np.uint64)
    out[words["w"].to_numpy()] = words["b"].to_numpy().view(np.uint64)
    return out


def _has(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    low = ids & np.uint64(64 * len(bits) - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) > 0


def _near(words: Words, maps: list[np.ndarray]) -> list[np.ndarray]:
    """For runs of 1, 2, ... words: which of them, by where they begin, stand in one piece and may be frequent.

    maps: the bitmaps of the frequent words, pairs, ...; one level more than maps is told, from its parts."""
    out = [_has(maps[0], words.ids)]
    for size in range(2, len(maps) + 2):
        last = out[-1]
        new = np.zeros_like(last)
        new[:-1] = last[:-1] & last[1:]
        if size == 2:
            new &= words.joined
        if size <= len(maps):
            h = run_hashes(words.ids, size)
            new[: len(h)] &= _has(maps[size - 1], h)
        out.append(new)
    return out


def frequent_runs(docs: DataFrame, maps: list[np.ndarray], seed: int = 0, least: int = LEAST) -> DataFrame:
    """(id) of the runs, one word longer than those of the last map, whose hash is counted ``least`` times."""
    size = len(maps) + 1

    def one(words: Words) -> list[np.ndarray]:
        h = run_hashes(words.ids, size) if len(words.ids) >= size else np.zeros(0, np.uint64)
        return [h[_near(words, maps)[-1][: len(h)]]]

    return _task_sums(docs, seed, one, ["id"]).groupBy("id").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("id")


def windows(docs: DataFrame, maps: list[np.ndarray], seed: int = 0, longest: int = LONGEST) -> DataFrame:
    """(w1, ..., w5, n): the padded longest windows of two words or more and how often they stand in a task's texts."""

    def one(words: Words) -> list[np.ndarray]:
        near = _near(words, maps[:-1])  # as told by the maps below, then by the last one itself
        if len(words.ids) >= len(maps):
            h = run_hashes(words.ids, len(maps))
            near[-1][: len(h)] &= _has(maps[-1], h)
        at = np.flatnonzero(near[1])
        lead, alive = [words.ids[at]], np.ones(len(at), bool)
        for k in range(1, longest):
            size = min(k + 1, len(maps))  # the last run of this many words must be frequent; false where the slice ends
            alive = alive & near[size - 1][np.minimum(at + k + 1 - size, len(words.ids) - 1)]
            lead.append(np.where(alive, words.ids[np.minimum(at + k, len(words.ids) - 1)], np.uint64(0)))
        return lead

    return _task_sums(docs, seed, one, _columns(longest))


def _columns(longest: int) -> list[str]:
    return [f"w{i + 1}" for i in range(longest)]


def prefix_counts(wins: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """(p: ids, f) of the phrases of two words or more counted ``least`` times: ROLLUP over the windows."""
    cols = _columns(longest)
    summed = wins.groupBy(*cols).agg(F.sum("n").alias("n"))
    up = summed.rollup(*cols).agg(F.sum("n").alias("f"), F.grouping_id().alias("g")).filter(F.col("f") >= least)
    size: Column = F.lit(longest) - F.bit_count("g")
    ids = F.slice(F.array(*cols), 1, F.greatest(size, F.lit(1)))
    # the level's last word is a pad: the window is shorter, and counted at its own level
    return up.filter(size >= 2).select(ids.alias("p"), "f").filter(F.element_at("p", -1) != 0)


def scored(candidates: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates (p, a) with lang, n and their lowest-scoring cut (l, r, score); words: (id, lang, word, f)."""
    counts = candidates.select("p", F.col("a").alias("f")).unionByName(words.select(F.array("id").alias("p"), "f"))
    cut = candidates.select("p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    cut = cut.select("p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("x"), F.slice("p", F.col("k") + 1, F.size("p") - F.col("k")).alias("y"))
    cut = cut.join(counts.select(F.col("p").alias("x"), F.col("f").alias("l")), "x").join(counts.select(F.col("p").alias("y"), F.col("f").alias("r")), "y")
    cut = cut.join(words.select(F.col("id").alias("first"), "lang"), F.get("p", F.lit(0)) == F.col("first")).join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.withColumn("top", (F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(17,0)")).cast("decimal(20,0)") * F.col("n").cast("decimal(17,0)"))
    cut = cut.withColumn("below", big("l") * big("r")).withColumn("score", F.expr("top div below"))
    return cut.groupBy("p").agg(F.min(F.struct("score", "k", "l", "r", "a", "n", "lang")).alias("c")).select("p", "c.lang", "c.a", "c.l", "c.r", "c.n", "c.score")


def inside_longer(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """(p) of candidates that lie in a longer one with 100 * f(longer) >= share * a."""
    n = F.size("p")
    size = candidates.filter(n > 2).select("p", "a", F.explode(F.expr("sequence(2, size(p) - 1)")).alias("m"))
    part = size.select("a", F.explode(F.expr("transform(sequence(1, size(p) - m + 1), i -> slice(p, i, m))")).alias("q"))
    most = part.groupBy("q").agg(F.max("a").alias("most"))
    return candidates.join(most, F.col("p") == F.col("q")).filter(100 * F.col("most") >= share * F.col("a")).select("p")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    seed = 0
    while True:
        known = stored(vocabulary(docs, seed), "op13-words")
        if known.groupBy("id").count().filter("count > 1").isEmpty():
            break
        discard(known)
        seed += 1
    totals = known.groupBy("lang").agg(F.sum("f").alias("n"))
    words = known.filter(F.col("f") >= least)
    maps = [bitmap(words)]
    for _ in range(2, THINNED + 1):
        maps.append(bitmap(frequent_runs(docs, maps, seed, least)))
    wins = windows(docs, maps, seed, longest)
    candidates = stored(prefix_counts(wins, longest, least).withColumnRenamed("f", "a"), "op13-candidates")
    best = scored(candidates, words, totals).join(inside_longer(candidates, share), "p", "left_anti")
    named = best.select("*", F.posexplode("p").alias("at", "id")).join(words.select("id", "word"), "id")
    keys = ["lang", "a", "l", "r", "n", "score"]
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ")
    named = named.groupBy("p", *keys).agg(text.alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
