"""BPE, packing, token files: round trips against the libraries."""
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusmill.llm import bpe, packing, token_scan
from corpusmill.llm.common import shared_path, strings, text_slices

RANKS, WORDS = P.path("byte_bpe_multi_50k.tiktoken"), P.path("word_bpe_49k.json")
TEXTS = ["Hello  world, it's\n\nme 123!", "", None, "a", " \t\n ", "naïve façade 漢字 😀 don't", "x" * 3000, "<|endoftext|> it́s H̱ \x01 K"]
SCHEMA = "doc_id long, text string, lang string"


def docs(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], SCHEMA)


alphabet = st.sampled_from(list("ab'sZ1 \n\t.,!é漢 \x1c\x85"))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet, max_size=120), st.integers(1, 12))
def test_segments_are_safe(text, limit):
    enc = bpe.encoding(RANKS, P.PATTERN)
    parts = list(bpe.segments(text, limit))
    assert "".join(parts) == text
    assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


@pytest.mark.parametrize("tail", ["", "a", " a", "\n"])
def test_long_white_space(tail, monkeypatch):
    enc = bpe.encoding(RANKS, P.PATTERN)
    text = "start " + " \n" * 3000 + tail + " and \t" + " " * 6000 + tail
    assert bpe.encode_text(enc, text) == enc.encode_ordinary(text)
    huge = "a" + " " * 1_500_000 + "b"  # the library itself fails on this one
    assert enc.decode_bytes(bpe.encode_text(enc, huge)) == huge.encode()


def test_very_long_text_round_trip():
    enc = bpe.encoding(RANKS, P.PATTERN)
    rng = random.Random(1)
    text = "".join(rng.choice(["word ", "1234", "\n", "é", "'s "]) for _ in range(60_000))
    assert bpe.encode_text(enc, text) == enc.encode_ordinary(text)


def test_bpe_query(spark):
    import hashlib

    enc = bpe.encoding(RANKS, P.PATTERN)
    got = {r.doc_id: r for r in bpe.round_trip(docs(spark), RANKS, P.PATTERN).collect()}
    for i, t in enumerate(TEXTS):
        ids = enc.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_columns_and_empty(spark):
    out = bpe.encode(docs(spark).withColumnRenamed("lang", "n_tokens"), RANKS, P.PATTERN)
    assert out.columns == ["doc_id", "text", "n_tokens", "ids"] and out.count() == len(TEXTS)
    with pytest.raises(ValueError):
        bpe.encode(docs(spark).withColumnRenamed("lang", "ids"), RANKS, P.PATTERN)
    assert bpe.round_trip(docs(spark).limit(0), RANKS, P.PATTERN).count() == 0


def word_ids(text):
    return Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids


def test_word_coder_equals_the_library(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "WORDS", 5)  # the memory is emptied all the time
    code = packing.WordCoder(WORDS)
    texts = [t or "" for t in TEXTS] + ["The THE the, (the) we'll I'd", "́ lone", "ÀÉ ẖ H̱", "x <|endoftext|> y", "a<|endoftext|>b<|startoftext|> <|ENDOFTEXT|> <|endoftext| >", "é<|endoftext|>é"]
    for _ in range(2):
        off, ids = code.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[off[i] : off[i + 1]].tolist() == word_ids(t), t


def check_packing(rows, want, tokens, segments=None, loss=None):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc, ids in want.items():
        parts = sorted(by_doc[doc], key=lambda r: r.start)
        assert [r.start for r in parts] == np.cumsum([0, *(r.length for r in parts[:-1])]).tolist()
        assert b"".join(r.ids for r in parts) == np.array(ids, "<u4").tobytes()
        assert {r.doc_tokens for r in parts} == {len(ids)}
    for seq in by_seq.values():
        seq.sort(key=lambda r: r.offset)
        assert [r.offset for r in seq] == np.cumsum([0, *(r.length for r in seq[:-1])]).tolist()
        assert sum(r.length for r in seq) <= tokens
        assert segments is None or len(seq) <= segments
        assert loss is None or sum(r.loss_tokens for r in seq) <= loss
    return by_seq


def test_packing_tokenises_in_small_slices():
    """What a task holds to tokenise a batch stays small, however long the batch's texts are together."""
    text = " ".join(f"w{i % 5000}" for i in range(100_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 16)], names=["text"])
    code = packing.WordCoder(WORDS)
    one = np.diff(code.encode(pa.array([text]))[0])[0]
    tracemalloc.start()
    try:
        for part in text_slices(batch, "text", packing.SLICE):
            assert np.diff(code.encode(strings(part, "text"))[0]).tolist() == [one] * part.num_rows
        assert tracemalloc.get_traced_memory()[1] < 64 << 20
    finally:
        tracemalloc.stop()


def test_packing_documents(spark):
    texts = TEXTS + ["many words here " * 3000, "many words here " * 5]
    rows = packing.pack(docs(spark, texts).repartition(2), WORDS, 1).collect()
    seqs = check_packing(rows, {i: [*word_ids(t or ""), 1] for i, t in enumerate(texts)}, 2048)
    assert all((n := sum(r.length for r in s)) & (n - 1) == 0 for s in seqs.values())  # no padding
    again = packing.pack_documents(docs(spark, texts), WORDS).collect()
    raw = np.array([1], "<u4").tobytes()
    assert [r.ids_crc32 for r in again if r.doc_id == 1] == [zlib.crc32(raw)]


@pytest.mark.parametrize("cut", [True, False])
def test_packing_under_three_limits(spark, cut):
    rng = random.Random(3)
    ex = [(i, " ".join(["ask"] * rng.randint(0, 60)) or None, " ".join(["answer"] * rng.randint(0, 60))) for i in range(300)]
    df = spark.createDataFrame(ex, "doc_id long, prompt string, text string").coalesce(1)
    limits = packing.Limits(tokens=128, segments=4, loss=70)
    rows = packing.pack(df, WORDS, 1, limits, prompt_col="prompt", cut=cut, powers=False, pool=64).collect()
    want = {i: [*word_ids(p or ""), *word_ids(t), 1] for i, p, t in ex}
    seqs = check_packing(rows, want, 128, 4, 70)
    loss = sum(len(word_ids(t)) + 1 for _, _, t in ex)
    assert sum(r.loss_tokens for r in rows) == loss
    total = sum(map(len, want.values()))
    least = max(total / 128, loss / 70, 300 / 4)
    assert len(seqs) <= 1.35 * least


def test_packing_empty_and_repeated(spark):
    assert packing.pack_documents(docs(spark).limit(0), WORDS).count() == 0
    twice = spark.createDataFrame([(None, "a b", "x"), (7, "a b", "x"), (7, "a b", "x")], SCHEMA)
    rows = packing.pack_documents(twice, WORDS).collect()
    assert sum(r.length for r in rows) == 9 and sum(r.length for r in rows if r.doc_id is None) == 3


@pytest.mark.parametrize("block", [2, 6, 16, 1 << 20])
def test_separator_scan(spark, block):
    texts = ["", "one two three", None, "x " * 40, "", "end"]
    enc = bpe.encoding(RANKS, P.PATTERN)
    path = shared_path(spark, "tokens")
    token_scan.write_token_files(docs(spark, texts).coalesce(1), path, RANKS, P.PATTERN, 50_256)
    rows = sorted((r.doc_no, r.start, r.n_tokens) for r in token_scan.token_counts(spark, path, 50_256, block).collect())
    want, at = [], 0
    for i, t in enumerate(texts):
        n = len(enc.encode_ordinary(t or ""))
        want.append((i, at, n))
        at += n + 1
    assert rows == want


def test_open_document_and_empty_files(spark, tmp_path):
    np.array([5, 9, 50_256, 7], "<u2").tofile(tmp_path / "part-00000.txt")
    np.array([7, 7], "<u2").tofile(tmp_path / "part-00001.txt")
    (tmp_path / "part-00002.txt").touch()
    rows = token_scan.token_counts(spark, str(tmp_path), 50_256, 2).collect()
    assert sorted((r.file[-5], r.doc_no, r.start, r.n_tokens, r.open) for r in rows) == [("0", 0, 0, 2, False), ("0", 1, 3, 1, True), ("1", 0, 0, 2, True)]
    assert token_scan.counted_documents(docs(spark).limit(0), RANKS, P.PATTERN, 50_256).count() == 0
