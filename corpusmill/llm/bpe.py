"""Operator 1: byte-level BPE with the tiktoken library and a local rank file.

``encode`` adds the ids of whole texts, ``decode`` turns ids back into raw bytes.
A text longer than ``SEGMENT`` characters is cut at safe boundaries first: between
a character that is no white space and one that is. No match of the pattern holds
such a pair, and no look-ahead reaches across it, so the ids of the segments in a
row are the ids of the whole text. A long run of white space, on which the
library's regex engine overflows its stack, is one match apart from its last
character, and its bytes are merged without the regex.

Nulls count as empty text (no ids); repeated rows stay; other columns pass through
untouched; an empty table gives an empty table.
"""
from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.common import strings, text_slices

#: Characters after which a long text is cut at the next safe boundary.
SEGMENT = 50_000
#: White-space runs from this length on are encoded without the regex.
LONG_RUN = 5_000
#: Fixed: white space as the pattern's engine sees it (the Unicode property).
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = regex.compile(f"[{WHITE}]{{{LONG_RUN},}}")
_SAFE = regex.compile(f"[^{WHITE}](?=[{WHITE}])")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file (lines of base64 token and rank); one per worker."""
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def segments(text: str, limit: int = SEGMENT) -> Iterator[str]:
    """Cut a text at the first safe boundary after each ``limit`` characters."""
    start = 0
    while len(text) - start > limit:
        m = _SAFE.search(text, start + limit - 1)
        if not m:
            break
        yield text[start : m.end()]
        start = m.end()
    yield text[start:]


def encode_text(enc: tiktoken.Encoding, text: str) -> list[int]:
    """The ids of one text, as ``encode_ordinary`` would give them."""
    if len(text) < min(SEGMENT, LONG_RUN):
        return enc.encode_ordinary(text)
    ids: list[int] = []

    def plain(part: str) -> None:
        for s in segments(part):
            ids.extend(enc.encode_ordinary(s))

    done = 0
    for m in _RUN.finditer(text):
        plain(text[done : m.start()])
        # at the end of the text the run is one match, else its last character belongs to what follows
        done = m.end() if m.end() == len(text) else m.end() - 1
        ids.extend(enc._core_bpe.encode_single_piece(text[m.start() : done].encode("utf-8")))
    plain(text[done:])
    return ids


def _as_columns(df: DataFrame, name: str) -> T.StructType:
    if name in df.columns:
        raise ValueError(f"column {name} exists; choose another output name")
    return df.schema


def encode(df: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add ``ids_col`` (array of int) with the ids of ``text_col``; a name in use is an error."""
    schema = T.StructType([*_as_columns(df, ids_col).fields, T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for part in text_slices(batch, text_col):
                ids = [np.asarray(encode_text(enc, t), dtype=np.int32) for t in strings(part, text_col).to_pylist()]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                col = pa.ListArray.from_arrays(offsets, np.concatenate([*ids, np.zeros(0, np.int32)]))
                yield pa.RecordBatch.from_arrays([*part.columns, col], names=[*part.schema.names, ids_col])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col`` (binary) with the raw bytes of the ids; ids need not end at a character."""
    schema = T.StructType([*_as_columns(df, bytes_col).fields, T.StructField(bytes_col, T.BinaryType())])

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = [enc.decode_bytes(x or []) for x in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, bytes_col])

    return df.mapInArrow(run, schema)


def ids_as_bytes(df: DataFrame, ids_col: str = "ids", bytes_col: str = "id_bytes") -> DataFrame:
    """Add the ids as little-endian unsigned 32-bit integers (binary)."""
    schema = T.StructType([*_as_columns(df, bytes_col).fields, T.StructField(bytes_col, T.BinaryType())])

    def run(batches):
        for batch in batches:
            col = batch.column(ids_col)
            offsets = col.offsets.to_numpy()
            raw = np.ascontiguousarray(col.values.to_numpy(zero_copy_only=False), dtype="<u4")[offsets[0] : offsets[-1]]
            offs = ((offsets - offsets[0]) * 4).astype(np.int32)
            out = pa.BinaryArray.from_buffers(pa.binary(), len(col), [None, pa.py_buffer(offs), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, bytes_col])

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Digest of encoding and decoding: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = encode(df.select("doc_id", "text"), rank_file, pattern).drop("text")
    both = decode(ids_as_bytes(coded), rank_file, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("id_bytes", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
