"""Operator 3: vector bin packing of tokenised examples.

An example demands a vector of tokens, one segment, and loss-bearing tokens (those
after its prompt); a sequence has a limit for each. Sequences are filled one after
another: of the pooled pieces that still fit, the one whose demand has the largest
dot product with the room left is placed next (both as shares of the limits,
each dimension weighted by the pool's mean demand). When none fits, the piece of largest
dot product is cut to the room left, if cutting is on. A sequence that stays short of
its limit can be cut into lengths that are powers of two, which need no padding.

Every task packs what it tokenises, from a pool of bounded size: no shuffle, no hot
key, and at most one unfilled sequence a task. Sequence ids are unique: the task's
partition number and a running number.

Ids come from a ``tokenizers`` file; words are tokenised once and remembered. The
text is cut at ASCII white space only, which the pre-tokeniser drops, so the ids are those
of the whole text. New words of printable ASCII and Latin-1 letters, for which lower-casing
and splitting by the file's pattern are plain and composition changes nothing, go to the file's BPE model directly, any other word through
the whole tokeniser. A string of a special token in the text becomes that token's id, as the library does it.

Defined results: texts of any length are tokenised whole; pieces of equal demand go in the order they came; null text or prompt counts as empty; an empty example is its end id
alone; repeated rows are separate examples; a null id passes through; only the named
columns are read; an empty table gives an empty result.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import release, strings, text_slices

#: Text that a task tokenises at once; a task's memory grows with it.
SLICE = 2 << 20
#: Words remembered before the memory is emptied; no effect on results.
WORDS = 400_000
#: Pieces a task pools; more gives the heuristic more choice and costs more time a piece.
POOL = 1024
_MARK = "\x01"
#: Words that need no normaliser but lower-casing, and the file's pattern for these (fixed by that file).
PLAIN = "^[\\x21-\\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
_LETTER = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PIECES = re.compile(f"{_MARK}|'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^{_MARK}0-9{_LETTER}]+")
SCHEMA = "doc_id long, start long, length long, ids binary, loss_tokens long, doc_tokens long, sequence_id long, offset long"


class WordCoder:
    """Ids of texts by a tokenizers file whose pre-tokeniser splits at and drops white space."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        #: strings that the file takes as one token wherever they stand
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(re.search(r"\s", t) for t in self.added):
            raise ValueError("a token that holds white space cannot be found in single words")
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.mark = np.array(self._plain(_MARK), np.uint32)
        self._clear()

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0

    def _direct(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of plain words, by the model alone."""
        pieces = _PIECES.findall(_MARK.join(words).lower())
        index: dict[str, int] = {_MARK: 0}
        which = np.fromiter((index.setdefault(p, len(index)) for p in pieces), np.int64, len(pieces))
        distinct, ids, lengths = list(index)[1:], [], [np.zeros(1, np.int64)]
        for at in range(0, len(distinct), 10_000):
            part = distinct[at : at + 10_000]
            got = self.model.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(got.ids, np.uint32))
            lengths.append(np.bincount(np.array(got.word_ids, np.int64), minlength=len(part)))
        flat, n = np.concatenate([*ids, np.zeros(0, np.uint32)]), np.concatenate(lengths)
        starts, each = np.cumsum(n) - n, n[which]
        ends = np.cumsum(each)
        out = flat[np.repeat(starts[which] - ends + each, each) + np.arange(each.sum())]
        word = np.cumsum(which == 0)
        return out, np.bincount(word, weights=each, minlength=len(words)).astype(np.int64)

    def _learn(self, words: list[str], plain: np.ndarray) -> np.ndarray:
        """Slots of new words; ``plain`` tells which can go to the model directly."""
        order = np.argsort(~plain, kind="stable")
        direct = int(plain.sum())
        words = [words[i] for i in order.tolist()]
        ids, lengths = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        if direct:
            got = self._direct(words[:direct])
            ids.append(got[0])
            lengths.append(got[1])
        slots = self._remember(words, *self._whole(words[direct:], ids, lengths))
        out = np.empty(len(words), np.int64)
        out[order] = slots
        return out

    def _whole(self, words: list[str], ids: list, lengths: list) -> tuple[np.ndarray, np.ndarray]:
        """The same, after what is in ``ids`` and ``lengths``, by the whole tokeniser."""
        odd = len(self.mark) != 1
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            if odd or any(_MARK in w for w in part):
                each = [np.array(self._plain(w), np.uint32) for w in part]
                ids += each
                lengths.append(np.array([len(x) for x in each], np.int64))
                continue
            got = np.array(self._plain(f" {_MARK} ".join([*part, ""])), np.uint32)
            ends = np.flatnonzero(got == self.mark[0])
            ids.append(np.delete(got, ends))
            lengths.append(np.diff(ends, prepend=-1) - 1)
        return np.concatenate(ids), np.concatenate(lengths)

    def _remember(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, first = len(words), len(self.known)
        while first + n > len(self.starts):
            self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.lengths[first : first + n] = lengths
        self.starts[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.known.update(zip(words, range(first, first + n)))
        return np.arange(first, first + n)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): the ids of text i are ids[offsets[i]:offsets[i + 1]]."""
        split = pc.ascii_split_whitespace(texts)
        words = split.values.dictionary_encode()
        if len(self.known) + len(words.dictionary) > WORDS:
            self._clear()
        names = words.dictionary.to_pylist()
        slots = np.fromiter((self.known.get(w, -1) for w in names), np.int64, len(names))
        new = np.flatnonzero(slots < 0)
        if len(new):
            fresh = words.dictionary.take(pa.array(new))
            plain = pc.match_substring_regex(fresh, PLAIN).to_numpy(zero_copy_only=False)
            for token in self.added:
                plain = plain & ~pc.match_substring(fresh, token, ignore_case=True).to_numpy(zero_copy_only=False)
            slots[new] = self._learn([names[i] for i in new.tolist()], plain)
        at = slots[words.indices.to_numpy()]
        n = self.lengths[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[np.repeat(self.starts[at] - ends[:-1], n) + np.arange(ends[-1])]
        return ends[split.offsets.to_numpy() - split.offsets[0].as_py()], ids


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


@dataclass
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    prompt: int  # tokens of the example that bear no loss
    doc_tokens: int

    def loss(self) -> int:
        return max(0, self.start + len(self.ids) - max(self.start, self.prompt))

    def head(self, tokens: int, loss: int) -> int:
        """The longest prefix within both limits."""
        free = max(0, self.prompt - self.start)
        return min(len(self.ids), tokens, free + loss)

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc_id, self.start, self.ids[:n], self.prompt, self.doc_tokens),
            Piece(self.doc_id, self.start + n, self.ids[n:], self.prompt, self.doc_tokens),
        )


class Packer:
    """A pool of pieces and the sequences made of it. Examples that no empty sequence can hold are cut, always."""

    def __init__(self, limits: Limits, cut: bool = True, powers: bool = True, pool: int = POOL) -> None:
        self.limits, self.cut, self.powers, self.pool = limits, cut, powers, pool
        self.caps = np.array([limits.tokens, limits.segments, max(1, limits.loss)], float)
        self.pieces: list[Piece] = []
        self.demand = np.zeros((2 * pool, 3))

    def _put(self, p: Piece) -> None:
        n = len(self.pieces)
        if n == len(self.demand):
            self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
        self.pieces.append(p)
        self.demand[n] = (len(p.ids), 1, p.loss())

    def _take(self, i: int) -> Piece:
        last = len(self.pieces) - 1
        p, self.pieces[i] = self.pieces[i], self.pieces[last]
        self.demand[i] = self.demand[last]
        self.pieces.pop()
        return p

    def add(self, p: Piece) -> Iterator[list[Piece]]:
        """Pool an example; yields the sequences that are done."""
        while (n := p.head(self.limits.tokens, self.limits.loss)) < len(p.ids):
            if n == 0:
                raise ValueError("a sequence has no room for loss-bearing tokens")
            part, p = p.cut(n)
            if n == self.limits.tokens:
                yield [part]
            else:
                self._put(part)
        if len(p.ids):
            self._put(p)
        while len(self.pieces) >= self.pool:
            yield from self._split(self._fill())

    def finish(self) -> Iterator[list[Piece]]:
        while self.pieces:
            yield from self._split(self._fill())

    def _fill(self) -> list[Piece]:
        weights = self.demand[: len(self.pieces)].mean(axis=0) / self.caps
        room, out = self.caps.copy(), []
        room[2] = self.limits.loss
        while self.pieces and room[0] > 0 and room[1] > 0:
            d = self.demand[: len(self.pieces)]
            score = d @ (weights * room / (self.caps * self.caps))
            fits = (d[:, 0] <= room[0]) & (d[:, 2] <= room[2])
            if fits.any():
                p = self._take(int(np.argmax(np.where(fits, score, -1.0))))
            elif self.cut:
                i = int(np.argmax(score))
                n = self.pieces[i].head(int(room[0]), int(room[2]))
                if n == 0:
                    break
                p, rest = self._take(i).cut(n)
                self._put(rest)
            else:
                break
            room -= (len(p.ids), 1, p.loss())
            out.append(p)
        return out

    def _split(self, seq: list[Piece]) -> Iterator[list[Piece]]:
        """A short sequence as sequences of powers of two, if wanted."""
        total = sum(len(p.ids) for p in seq)
        if not (self.cut and self.powers) or total == self.limits.tokens:
            yield seq
            return
        while total:
            want = left = 1 << (total.bit_length() - 1)
            part = []
            while left:
                p = seq.pop(0)
                if len(p.ids) > left:
                    p, rest = p.cut(left)
                    seq.insert(0, rest)
                part.append(p)
                left -= len(p.ids)
            total -= want
            yield part


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.binary() if n == "ids" else pa.int64() for n in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def pack(examples: DataFrame, tokenizer: str, end_id: int, limits: Limits | None = None, id_col: str = "doc_id", text_col: str = "text", prompt_col: str | None = None, cut: bool = True, powers: bool = True, pool: int = POOL) -> DataFrame:
    """One row a piece: doc_id, start, length, ids (little-endian unsigned 32-bit), loss_tokens, doc_tokens, sequence_id, offset.

    An example's ids are those of its prompt, if it has one (no loss), of its text, and ``end_id``.
    """
    limits = limits or Limits()
    prompt = F.coalesce(F.col(prompt_col), F.lit("")) if prompt_col else F.lit("")
    chosen = examples.select(F.col(id_col).cast("long").alias("doc_id"), prompt.alias("prompt"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer)
        packer = Packer(limits, cut, powers, pool)
        first = TaskContext.get().partitionId() << 33
        rows: list[tuple] = []
        made = held = 0

        def note(sequences: Iterator[list[Piece]]) -> None:
            nonlocal made, held
            for seq in sequences:
                at = 0
                for p in seq:
                    rows.append((p.doc_id, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.loss(), p.doc_tokens, first + made, at))
                    at += len(p.ids)
                made, held = made + 1, held + at

        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                off, ids = code.encode(strings(part, "text"))
                has_prompt = prompt_col is not None
                p_off, p_ids = code.encode(strings(part, "prompt")) if has_prompt else (np.zeros(len(off), np.int64), ids[:0])
                for i, doc in enumerate(part.column("doc_id").to_pylist()):
                    own = [p_ids[p_off[i] : p_off[i + 1]], ids[off[i] : off[i + 1]], np.array([end_id], np.uint32)]
                    all_ids = np.concatenate(own)
                    note(packer.add(Piece(doc, 0, all_ids, len(own[0]), len(all_ids))))
                    if held > 1 << 19:
                        yield _batch(rows)
                        rows, held = [], 0
        note(packer.finish())
        if rows:
            yield _batch(rows)
        release()

    return chosen.mapInArrow(run, SCHEMA)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, limits: Limits | None = None) -> DataFrame:
    """Whole documents as examples without prompt, with the check sum of each piece's ids."""
    pieces = pack(docs, tokenizer, end_id, limits)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "loss_tokens")
