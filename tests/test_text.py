"""Scalar text functions and text jobs: goldens and brute-force rules."""
import random
import string

from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import text as TX


def _soundex_rule(token: str) -> str:
    """The Soundex variant written as a plain loop (independent re-statement)."""
    groups = {"BFPV": "1", "CGJKQSXZ": "2", "DT": "3", "L": "4", "MN": "5", "R": "6"}
    t = token.upper()
    out = t[0]
    for ch in t[1:]:
        code = next((d for letters, d in groups.items() if ch in letters), None)
        if code is not None and code != out[-1]:
            out += code
    return out[:4].ljust(4, "0")


def _edit1_rule(w: str) -> set:
    letters = string.ascii_lowercase
    splits = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    out = set()
    for a, b in splits:
        if b:
            out.add(a + b[1:])
            for c in letters:
                out.add(a + c + b[1:])
        if len(b) > 1:
            out.add(a + b[1] + b[0] + b[2:])
        for c in letters:
            out.add(a + c + b)
    return out


def test_soundex_golden(spark):
    words = ["pfister", "robert", "ashcraft", "tymczak", "honeyman", "jackson", "1bb", "a"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(X.soundex_code("w").alias("s")).collect()
    assert [r.s for r in got] == ["P123", "R163", "A261", "T520", "H500", "J250", "1000", "A000"]


def test_soundex_matches_rule_on_random_words(spark):
    rnd = random.Random(7)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz12") for _ in range(rnd.randint(1, 12)))
             for _ in range(300)]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", X.soundex_code("w").alias("s"))
    for r in got.collect():
        assert r.s == _soundex_rule(r.w), r.w


def test_edit1_counts_and_rule(spark):
    words = ["tink", "a", "aab", "wikipedya"]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", X.edit1_candidates("w").alias("c"))
    got = {r.w: set(r.c) for r in df.collect()}
    assert [len(got[w]) for w in words] == [234, 78, 180, 494]
    for w in words:
        assert got[w] == _edit1_rule(w)


def test_word_tokens_contractions_and_punct(spark):
    df = spark.createDataFrame([("I cannot, won't\tgo  Home!",)], "t string")
    toks = df.select(X.word_tokens(X.normalize_text("t")).alias("k")).first().k
    assert toks == ["i", "can", "not", "wont", "go", "home"]


def test_page_bits_and_words(spark):
    html = "<p>Hello 10 world</p><b>x2y</b>"
    r = spark.createDataFrame([(html,)], "h string").select(X.page_bits("h").alias("b"), X.page_words("h").alias(
        "w")).first()
    assert r.b == "10011001"
    assert r.w == ["Hello", "world", "x", "y"]


def test_links_and_resolution(spark):
    html = '<a href="/x">a</a><a class="c" href="https://o.org/y">b</a><a name="n">no</a><a href=\'rel\'>r</a>'
    df = spark.createDataFrame([("http://h.com/d/p?q=1", html)], "url string, h string")
    r = df.select(F.transform(X.page_links("h"), lambda h: X.resolve_link(h, F.col("url"))).alias("l")).first()
    assert r.l == ["http://h.com/x", "https://o.org/y", "http://h.com/d/rel"]


def test_published_at(spark):
    html = '<meta property="article:published_time" content="2023-05-04T10:11:12+00:00">'
    df = spark.createDataFrame([(html,), ("<p>none</p>",)], "h string")
    got = [r.p for r in df.select(X.published_at("h").alias("p")).collect()]
    assert got[0] is not None and got[1] is None


def test_clean_news_headers_linewise(spark):
    text = "From: a@b\nSubject: Hi 12/3/99 there\nOrganization: X\nbody, text!"
    r = spark.createDataFrame([(text,)], "t string").select(X.clean_news("t").alias("c")).first().c
    assert "a@b" not in r and "subject hi  there" in r and "body text" in r


def test_stop_words_equal_mllib_default(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert TX.STOP_WORDS_EN == StopWordsRemover.loadDefaultStopWords("english")


def test_spell_correct_brute_force(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat, the cat"), (2, "a bat and a hat")],
                                 "doc_id long, text string")
    uni = TX.unigram_counts(TX.tokenize(docs))
    words = spark.createDataFrame([("cst",), ("tha",), ("zzzzzz",)], "word string")
    got = {r.word: (r.correction, r.n) for r in TX.spell_correct(words, uni).collect()}
    counts = {r.token: r.n for r in uni.collect()}
    for w in ("cst", "tha", "zzzzzz"):
        cands = sorted((-counts[c], c) for c in _edit1_rule(w) if c in counts)
        exp = (cands[0][1], -cands[0][0]) if cands else (None, None)
        assert got[w] == exp


def test_index_chunks_keep_every_posting(spark):
    rows = [(d, "hot " + ("cold" if d % 3 == 0 else "warm")) for d in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    post = TX.postings(TX.tokenize(docs))
    idx = TX.index_nested(post, max_postings=7).filter(F.col("token") == "hot").collect()
    assert len(idx) == 8  # ceil(50 / 7) chunks
    ids = sorted(int(p.split(":")[0]) for r in idx for p in r.postings.split(","))
    assert ids == list(range(50))


def test_search_orders_by_tf_then_doc(spark):
    docs = spark.createDataFrame([(0, "apple apple pear", "u0"), (1, "apple", "u1"), (2, "pear pear pear", "u2")],
                                 "doc_id long, text string, url string")
    post = TX.postings(TX.tokenize(docs))
    q = spark.createDataFrame([(7, "Apple pear")], "query_id long, text string")
    got = [(r.rank, r.doc_id, r.term) for r in TX.search(q, post, docs, k=3).orderBy("rank").collect()]
    assert got == [(1, 2, "pear"), (2, 0, "apple"), (3, 0, "pear")]


def test_spell_modes_exclusive(spark):
    import pytest

    w = spark.createDataFrame([("x",)], "word string")
    u = spark.createDataFrame([("x", 1)], "token string, n long")
    with pytest.raises(ValueError):
        TX.spell(w, u, proba=True, correct=True)
    assert TX.spell(w, u, correct=True).first().correction == "x"


def test_decode_text(spark):
    df = spark.createDataFrame([(bytearray(b"caf\xc3\xa9"), bytearray(b"caf\xe9"))], "u binary, l binary")
    r = df.select(X.decode_text("u").alias("u"), X.decode_text("l", "ISO-8859-1").alias("l"),
                  X.decode_text("l").alias("bad")).first()
    assert r.u == "caf\xe9" and r.l == "caf\xe9" and r.bad == "caf�"


def test_doc_term_map(spark):
    docs = spark.createDataFrame([(1, "a b a")], "doc_id long, text string")
    m = TX.doc_term_map(TX.postings(TX.tokenize(docs))).first().terms
    assert m == {"a": 2, "b": 1}
