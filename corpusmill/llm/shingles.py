"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

Words are runs of bytes other than space and \\x09-\\x0D, after lower-casing A-Z.
The hash of a word is a polynomial of its bytes, mixed; that of a shingle combines
its words by place. With 64 bits, two of the shingles of one text share a hash with
probability below 1e-10 for a million shingles.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

#: Bytes up to which ``chunk_hashes`` takes a word by chunks.
CHUNKED = 64

_RNG = np.random.Generator(np.random.PCG64(20_071))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[_SPACE] = 0
_BYTE = _BYTE[_LOWER]
with np.errstate(over="ignore"):
    _POWER = np.cumprod(np.full(1 << 16, 0x9E3779B97F4A7C15, dtype=np.uint64))
_PLACE = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LENGTH = _RNG.integers(1, 1 << 63, CHUNKED + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes one after another, where each text begins in them, where each word begins."""
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    size = int(off[-1] - off[0])
    if size == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), np.zeros(0, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]]
    off = off - off[0]
    space = _SPACE[data]
    first = np.ones(size, dtype=bool)
    first[1:] = space[:-1]
    first[off[:-1][off[:-1] < size]] = True
    return data, off, np.flatnonzero(first & ~space)


def prefix_hashes(texts: pa.Array, length: int) -> np.ndarray:
    """For each word of ``word_hashes``, the hash of its first ``length`` bytes; of all of it, if shorter."""
    data, _, starts = _words(texts)
    ends = np.append(starts[1:], len(data))  # with what separates the words, which adds nothing
    h = np.zeros(len(starts), np.uint64)
    inside = np.ones(len(starts), dtype=bool)
    for j in range(length):
        at = starts + j
        inside &= at < ends
        at = np.minimum(at, max(0, len(data) - 1))
        h += np.where(inside, _BYTE[data[at]] * _POWER[j], np.uint64(0))
    return mix(h)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes): the words of text i are hashes[offsets[i]:offsets[i + 1]]. Nulls have none."""
    data, off, starts = _words(texts)
    size = len(data)
    if not len(starts):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.uint64)
    place = np.arange(size, dtype=np.int64)
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, size)))
    part = _BYTE[data] * _POWER[place & 0xFFFF]
    return np.searchsorted(starts, off), mix(np.add.reduceat(part, starts))


def _chunks(wide: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of the bytes that ``wide`` holds as 64-bit words."""
    i, shift = at >> 3, (at & 7).astype(np.uint64) << np.uint64(3)
    return wide[i] >> shift | wide[i + 1] << np.uint64(1) << (np.uint64(63) - shift)


def chunk_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words data[start : start + length], A-Z lower-cased, taken eight bytes at a time. They are others than
    those of ``word_hashes``; long words are digested one by one."""
    lower = np.zeros(len(data) // 8 * 8 + 16, np.uint8)
    lower[: len(data)] = data | (data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5)
    wide = lower.view("<u8")
    h = mix((_chunks(wide, starts) & _MASK[np.minimum(lengths, 8)]) + _LENGTH[np.minimum(lengths, CHUNKED)])
    more = np.flatnonzero((lengths > 8) & (lengths <= CHUNKED))
    for k in range(8, CHUNKED, 8):
        if not len(more):
            break
        left = lengths[more] - k
        h[more] = mix((h[more] ^ _chunks(wide, starts[more] + k) & _MASK[np.minimum(left, 8)]) * _PLACE[k >> 3])
        more = more[left > 8]
    for i in np.flatnonzero(lengths > CHUNKED).tolist():
        word = lower[starts[i] : starts[i] + lengths[i]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return h


def shingle_hashes(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, hashes) of all shingles in order, repeated ones too.

    A text of fewer than ``width`` words, but at least one, has its whole sequence as its only shingle.
    """
    off, w = word_hashes(texts)
    count = np.diff(off)
    n_sh = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_off = np.concatenate([[0], np.cumsum(n_sh)])
    first = np.repeat(off[:-1], n_sh) + (np.arange(out_off[-1]) - np.repeat(out_off[:-1], n_sh))
    words = np.concatenate([w, np.zeros(width, np.uint64)])
    short = np.repeat(count < width, n_sh)
    n_words = np.repeat(np.minimum(count, width), n_sh)
    h = np.zeros(len(first), np.uint64)
    for j in range(width):
        term = words[first + j] * _PLACE[j]
        if short.any():
            term = np.where(j < n_words, term, np.uint64(0))
        h += term
    return out_off, mix(h ^ n_words.astype(np.uint64))


def distinct(off: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    return [np.unique(h[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
