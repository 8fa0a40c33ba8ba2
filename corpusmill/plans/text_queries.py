"""Text / IR queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import text as TX
from corpusmill.operators.ordered import dense_id
from corpusmill.plans import sqlfrag as S
from corpusmill.plans.registry import register
from corpusmill.sources.tables import read_pages, table


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _unigrams(spark, sf):
    return TX.unigram_counts(TX.tokenize(_docs(spark, sf)))


def _spell_words(spark, sf):
    return TX.typo_words(table(spark, sf, "benchmark"))


def _spell_inputs(spark, sf):
    """Words, and the vocabulary with its deletion index, stored once and read back."""
    import uuid

    from corpusmill.session import ensure_checkpoint_dir
    from corpusmill.sources.files import load_spell_index, store_spell_index

    path = f"{ensure_checkpoint_dir(spark)}/spell-index-{uuid.uuid4().hex}"
    store_spell_index(_unigrams(spark, sf), path)
    return _spell_words(spark, sf), *load_spell_index(spark, path)


def _stops(spark):
    return TX.stop_words_df(spark)


# SQL building blocks -------------------------------------------------------
DOC_TOKENS = f"SELECT doc_id, unnest({S.tokens('text')}) AS token FROM documents"
UNIGRAMS = f"SELECT token, count(*) AS n FROM ({DOC_TOKENS}) GROUP BY token"
_HALF = "CAST(floor(length(t) / 2) AS INTEGER)"
SPELL_WORDS = (
    f"SELECT DISTINCT CASE WHEN length(t) >= 3 THEN substr(t, 1, {_HALF}) || substr(t, {_HALF} + 2) ELSE t END AS word "
    f"FROM (SELECT DISTINCT unnest({S.tokens('text')}) AS t FROM benchmark)"
)
SPELL_CANDS = (
    f"SELECT c.word, c.candidate, u.n FROM (SELECT word, unnest({S.edit1('word')}) AS candidate FROM ({SPELL_WORDS})) c "
    f"JOIN ({UNIGRAMS}) u ON u.token = c.candidate"
)

PAGE_DOCS = "SELECT row_number() OVER (ORDER BY url) - 1 AS doc_id, url, html FROM pages"
PAGE_POSTINGS = (
    f"SELECT token, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest({S.tokens(S.page_text('html'))}) AS token "
    f"FROM ({PAGE_DOCS})) WHERE token NOT IN {S.STOP_LIST} GROUP BY token, doc_id"
)


# X3 ------------------------------------------------------------------------
@register(
    "tokens",
    f"SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ' ') AS tokens "
    f"FROM (SELECT doc_id, {S.tokens('text')} AS toks FROM documents)",
)
def q_tokens(spark, sf):
    arr = TX.token_arrays(_docs(spark, sf))
    return arr.select("doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
                      F.array_join("tokens", " ").alias("tokens"))


# A1 ------------------------------------------------------------------------
@register("unigram_counts", UNIGRAMS)
def q_unigram_counts(spark, sf):
    return _unigrams(spark, sf)


# J1 ------------------------------------------------------------------------
@register(
    "stopword_anti",
    f"SELECT token, count(*) AS n FROM ({DOC_TOKENS}) WHERE token NOT IN {S.STOP_LIST} GROUP BY token",
)
def q_stopword_anti(spark, sf):
    return TX.unigram_counts(TX.tokenize(_docs(spark, sf), stops=_stops(spark)))


# A3 ------------------------------------------------------------------------
@register("postings", f"SELECT token, doc_id, count(*) AS tf FROM ({DOC_TOKENS}) GROUP BY token, doc_id")
def q_postings(spark, sf):
    return TX.postings(TX.tokenize(_docs(spark, sf)))


# A4 ------------------------------------------------------------------------
@register(
    "index_nested",
    f"""WITH p AS (SELECT token, doc_id, count(*) AS tf FROM ({DOC_TOKENS}) GROUP BY token, doc_id),
    s AS (SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf FROM p GROUP BY token),
    c AS (SELECT p.*, s.df, s.total_tf,
          CAST({S.md5_bucket('p.doc_id')} % CAST(ceil(s.df / {TX.MAX_POSTINGS}) AS BIGINT) AS BIGINT) AS chunk
          FROM p JOIN s USING (token))
    SELECT token, chunk, df, total_tf, string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(tf AS VARCHAR), ','
           ORDER BY doc_id) AS postings
    FROM c GROUP BY token, chunk, df, total_tf""",
)
def q_index_nested(spark, sf):
    return TX.index_nested(TX.postings(TX.tokenize(_docs(spark, sf))))


# A5 ------------------------------------------------------------------------
@register(
    "term_totals",
    f"SELECT token, CAST(sum(tf) AS BIGINT) AS total FROM (SELECT token, doc_id, count(*) AS tf FROM ({DOC_TOKENS}) "
    f"GROUP BY token, doc_id) GROUP BY token",
)
def q_term_totals(spark, sf):
    return TX.term_totals(TX.postings(TX.tokenize(_docs(spark, sf))))


# T2 / W3 / O2 / O4 -----------------------------------------------------------
@register(
    "zipf_top",
    f"""WITH t AS (SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) AS BIGINT) AS rank
                  FROM ({UNIGRAMS}) ORDER BY n DESC, token LIMIT 30)
    SELECT token, n, rank, round(regr_slope(ln(n), ln(rank)) OVER (), 6) AS slope FROM t""",
)
def q_zipf_top(spark, sf):
    z = TX.zipf(_unigrams(spark, sf), 30)
    return z.withColumn("slope", F.round("slope", 6))


# P10 + O5 ------------------------------------------------------------------
@register(
    "token_filter_top",
    f"""SELECT token, n, CAST(row_number() OVER (ORDER BY n DESC, token) AS BIGINT) AS rank
    FROM (SELECT token, count(*) AS n FROM ({DOC_TOKENS}) WHERE token NOT IN {S.STOP_LIST} AND length(token) > 2
          GROUP BY token) ORDER BY n DESC, token LIMIT 10""",
)
def q_token_filter_top(spark, sf):
    toks = TX.tokenize(_docs(spark, sf), stops=_stops(spark), min_len=2)
    return TX.top_terms(TX.unigram_counts(toks), 10)


# X11 -------------------------------------------------------------------------
@register(
    "soundex_code",
    f"SELECT token, {S.soundex('token')} AS soundex FROM (SELECT DISTINCT token FROM ({DOC_TOKENS}))",
)
def q_soundex_code(spark, sf):
    toks = TX.tokenize(_docs(spark, sf)).select("token").distinct()
    return toks.select("token", X.soundex_code("token").alias("soundex"))


# T5 --------------------------------------------------------------------------
@register(
    "index_with_soundex",
    f"""SELECT token, {S.soundex('token')} AS soundex, df, total_tf FROM (
        SELECT token, count(*) AS df, CAST(sum(tf) AS BIGINT) AS total_tf FROM (
          SELECT token, doc_id, count(*) AS tf FROM ({DOC_TOKENS}) WHERE token NOT IN {S.STOP_LIST}
          GROUP BY token, doc_id) GROUP BY token)""",
)
def q_index_with_soundex(spark, sf):
    post = TX.postings(TX.tokenize(_docs(spark, sf), stops=_stops(spark)))
    v = post.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("total_tf"))
    return v.select("token", X.soundex_code("token").alias("soundex"), "df", "total_tf")


# J2 / T3 / T4 ------------------------------------------------------------------
@register("spell_candidates", SPELL_CANDS)
def q_spell_candidates(spark, sf):
    return TX.spell_candidates(*_spell_inputs(spark, sf))


@register(
    "spell_proba",
    f"SELECT word, candidate, n, CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM ({UNIGRAMS})) AS DOUBLE) AS proba "
    f"FROM ({SPELL_CANDS})",
)
def q_spell_proba(spark, sf):
    return TX.spell_proba(*_spell_inputs(spark, sf))


@register(
    "spell_correct",
    f"""SELECT w.word, b.correction, b.n FROM ({SPELL_WORDS}) w LEFT JOIN (
        SELECT word, arg_min(candidate, (-n, candidate)) AS correction, max(n) AS n FROM ({SPELL_CANDS}) GROUP BY word
    ) b ON b.word = w.word""",
)
def q_spell_correct(spark, sf):
    return TX.spell_correct(*_spell_inputs(spark, sf))


# J5 ----------------------------------------------------------------------------
@register(
    "soundex_fallback",
    f"""WITH v AS (SELECT DISTINCT token AS term, {S.soundex('token')} AS soundex FROM ({DOC_TOKENS})),
    bc AS (SELECT soundex, min(term) AS sx_term FROM v GROUP BY soundex),
    w AS (SELECT word, {S.soundex('word')} AS soundex FROM ({SPELL_WORDS}))
    SELECT w.word, coalesce(v.term, bc.sx_term) AS term,
           CASE WHEN v.term IS NOT NULL THEN 'exact' ELSE 'soundex' END AS matched
    FROM w LEFT JOIN v ON v.term = w.word LEFT JOIN bc ON bc.soundex = w.soundex
    WHERE coalesce(v.term, bc.sx_term) IS NOT NULL""",
)
def q_soundex_fallback(spark, sf):
    post = TX.postings(TX.tokenize(_docs(spark, sf)))
    return TX.resolve_terms(_spell_words(spark, sf), TX.vocabulary(post))


# W8 ----------------------------------------------------------------------------
@register("dense_doc_id", "SELECT row_number() OVER (ORDER BY url) - 1 AS doc_id, url, sha256(url) AS url_hash FROM pages")
def q_dense_doc_id(spark, sf):
    pages = read_pages(spark, sf).select("url")
    return dense_id(pages, ["url"], out="doc_id").select("doc_id", "url", X.url_hash("url").alias("url_hash"))


# X10 ---------------------------------------------------------------------------
@register("url_hash", "SELECT page_id, sha256(url) AS url_hash FROM pages")
def q_url_hash(spark, sf):
    return read_pages(spark, sf).select("page_id", X.url_hash("url").alias("url_hash"))


# T6 / O3 / J4 ------------------------------------------------------------------
def _numbered_pages(spark, sf):
    """Stored pages (url, html, doc_id) and the doc map (url, doc_id): one dense id per URL (W8). Only URLs are sorted."""
    pages = read_pages(spark, sf).select("url", "html")
    ids = dense_id(pages.select("url").distinct(), ["url"], out="doc_id")
    return pages.join(ids, "url"), ids


def page_postings(docs):
    text = docs.select("doc_id", F.regexp_replace("html", "<[^>]*>", " ").alias("text"))
    return TX.postings(TX.tokenize(text, stops=TX.stop_words_df(docs.sparkSession)))


SEARCH_HITS = f"""WITH d AS ({PAGE_DOCS}), post AS ({PAGE_POSTINGS}),
    v AS (SELECT DISTINCT token AS term, {S.soundex('token')} AS soundex FROM post),
    bc AS (SELECT soundex, min(term) AS sx_term FROM v GROUP BY soundex),
    qw AS (SELECT DISTINCT item_id AS query_id, word FROM (SELECT item_id, unnest({S.tokens('text')}) AS word
           FROM benchmark) WHERE word NOT IN {S.STOP_LIST}),
    rw AS (SELECT DISTINCT qw.query_id, coalesce(v.term, bc.sx_term) AS term FROM qw
           LEFT JOIN v ON v.term = qw.word LEFT JOIN bc ON bc.soundex = {S.soundex('qw.word')}
           WHERE coalesce(v.term, bc.sx_term) IS NOT NULL),
    hits AS (SELECT rw.query_id, rw.term, post.doc_id, post.tf, d.url FROM rw JOIN post ON post.token = rw.term
             JOIN d ON d.doc_id = post.doc_id),"""
SEARCH_TOP = """ r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY tf DESC, doc_id, term) AS rank FROM hits)
    SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, url, term, tf FROM r WHERE rank <= 3"""


@register("search_top3", SEARCH_HITS + SEARCH_TOP)
def q_search_top3(spark, sf):
    pages, ids = _numbered_pages(spark, sf)
    queries = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return TX.search(queries, page_postings(pages), ids, k=3, stops=_stops(spark))


def _stored_index(spark, sf):
    """Build the index once into the shared folder; (path, queries)."""
    import uuid

    from corpusmill.session import ensure_checkpoint_dir
    from corpusmill.sources.files import store_search_index

    path = f"{ensure_checkpoint_dir(spark)}/search-index-{uuid.uuid4().hex}"
    pages, ids = _numbered_pages(spark, sf)
    store_search_index(page_postings(pages), ids, path)
    return path, table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@register("search_stored", SEARCH_HITS + SEARCH_TOP)
def q_search_stored(spark, sf):
    """Top 3 over the stored impact-ordered blocks."""
    from corpusmill.sources.files import load_search_blocks

    path, queries = _stored_index(spark, sf)
    blocks, vocab, doc_map = load_search_blocks(spark, path)
    return TX.search_blocks(queries, blocks, vocab, doc_map, k=3, stops=_stops(spark))


@register(
    "search_merged",
    SEARCH_HITS + """ m AS (SELECT query_id, doc_id, url, CAST(sum(tf) AS BIGINT) AS tf, string_agg(term, ' ' ORDER BY term) AS term
          FROM hits GROUP BY query_id, doc_id, url),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY tf DESC, doc_id, term) AS rank FROM m)
    SELECT query_id, CAST(rank AS BIGINT) AS rank, doc_id, url, term, tf FROM r WHERE rank <= 3""",
)
def q_search_merged(spark, sf):
    from corpusmill.sources.files import load_search_index

    path, queries = _stored_index(spark, sf)
    post, vocab, doc_map = load_search_index(spark, path)
    return TX.search(queries, post, doc_map, k=3, stops=_stops(spark), vocab=vocab, merge_docs=True)


# X13 / T1 (stem=True) ------------------------------------------------------------
@register("stem_counts")
def q_stem_counts(spark, sf):
    from corpusmill.functions.stem import stem_tokens

    toks = TX.tokenize(_docs(spark, sf), stops=_stops(spark))
    return stem_tokens(toks).groupBy("stem").agg(F.count(F.lit(1)).alias("n"))


# T12 ------------------------------------------------------------------------------
# A small illustrative lexicon (word, valence) used as the query's
# input; any (word, valence) table can be passed to the operator instead.
SENTIMENT_LEXICON = (
    ("good", 1.9), ("great", 3.1), ("excellent", 2.7), ("happy", 2.7), ("love", 3.2), ("nice", 1.8),
    ("bad", -2.5), ("poor", -2.1), ("terrible", -2.1), ("sad", -2.1), ("hate", -2.7), ("awful", -2.0),
    ("best", 3.2), ("worst", -3.1), ("fine", 0.8), ("wrong", -2.1), ("free", 2.3), ("strong", 2.3),
    ("well", 1.1), ("like", 1.5),
)


def _sentiment_sql() -> str:
    from corpusmill.operators import sentiment as SE

    lex = "MAP {" + ", ".join(f"{S.q(w)}: {v}::DOUBLE" for w, v in sorted(SENTIMENT_LEXICON)) + "}"
    lst = lambda ws: "[" + ", ".join(S.q(w) for w in ws) + "]"
    toks = S.split_words(S.normalize("text"))

    def prev(k):
        return f"CASE WHEN i >= {k} THEN t[i + 1 - {k}] END"

    def member(ws, x):
        return f"coalesce(list_contains({lst(ws)}, {x}), false)"

    v = f"map_extract_value({lex}, t[i + 1])"
    boosted = (f"({v} + CASE WHEN {member(SE.BOOSTERS, prev(1))} THEN sign({v}) * {SE.BOOST} "
               f"WHEN {member(SE.DAMPENERS, prev(1))} THEN -sign({v}) * {SE.BOOST} ELSE 0.0 END)")
    negated = " OR ".join(member(SE.NEGATIONS, prev(k)) for k in (1, 2, 3))
    contrib = f"CASE WHEN {v} IS NULL THEN 0.0 WHEN {negated} THEN {boosted} * {SE.NEGATION_SCALAR} ELSE {boosted} END"
    return (f"SELECT doc_id, round(s / sqrt(s * s + {SE.ALPHA}), 6) AS compound FROM (SELECT doc_id, "
            f"CASE WHEN len(t) > 0 THEN list_sum(list_transform(range(0, len(t)), lambda i: {contrib})) ELSE 0.0 END "
            f"AS s FROM (SELECT doc_id, {toks} AS t FROM documents))")


@register("sentiment", _sentiment_sql())
def q_sentiment(spark, sf):
    from corpusmill.operators import sentiment as SE

    lex = spark.createDataFrame(list(SENTIMENT_LEXICON), "word string, valence double")
    out = SE.sentiment(_docs(spark, sf), "text", lex)
    return out.select("doc_id", F.round("compound", 6).alias("compound"))


# X22 ------------------------------------------------------------------------------
@register(
    "doc_term_map",
    f"""SELECT doc_id, count(*) AS n_terms, md5(string_agg(token || ':' || CAST(tf AS VARCHAR), ' ' ORDER BY token)) AS terms_md5
    FROM (SELECT doc_id, token, count(*) AS tf FROM ({DOC_TOKENS}) GROUP BY doc_id, token) GROUP BY doc_id""",
)
def q_doc_term_map(spark, sf):
    """The map's size and a digest of its entries in token order (maps have none of their own)."""
    m = TX.doc_term_map(TX.postings(TX.tokenize(_docs(spark, sf))))
    entries = F.array_sort(F.transform(F.map_entries("terms"), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v"))))
    line = F.array_join(F.transform(entries, lambda e: F.concat(e["k"], F.lit(":"), e["v"].cast("string"))), " ")
    return m.select("doc_id", F.size("terms").cast("bigint").alias("n_terms"), F.md5(line).alias("terms_md5"))
