"""Corpus, index, spelling and search jobs.

Tokens are produced by narrow expressions (clean -> split -> explode); every
count is one ``groupBy`` with map-side partial aggregation, so a hot token only
moves one partial row per map partition. Small fixed lists (stop words) are
broadcast; vocabulary-sized joins are left to AQE. Scalars (a total) enter as
scalar subqueries, never as a cross join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators.ordered import dense_id
from corpusmill.session import cut_lineage, stored

# The default English stop-word list of Spark MLlib's
# StopWordsRemover (181 words), used as the default stop list.
STOP_WORDS_EN = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers "
    "herself it its itself they them their theirs themselves what which who whom this that these those am is "
    "are was were be been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below to from up "
    "down in out on off over under again further then once here there when where why how all any both each few "
    "more most other some such no nor not only own same so than too very s t can will just don should now i'll "
    "you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're "
    "they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't "
    "won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's "
    "there's what's when's where's who's why's would"
).split()

MAX_POSTINGS = 10_000


def stop_words_df(spark, words=STOP_WORDS_EN) -> DataFrame:
    return spark.createDataFrame([(w,) for w in words], "token string")


def md5_bucket(c) -> Column:
    """Deterministic 32-bit hash of a value that SQL engines compute alike: the
    first 8 hex digits of md5(cast(c as string)) read as a number."""
    col = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(F.md5(col.cast("string")), 1, 8), 16, 10).cast("bigint")


# --------------------------------------------------------------------------- T1
def token_arrays(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, tokens ARRAY<STRING>) after lower-casing and punctuation removal."""
    return docs.select(key, X.word_tokens(X.normalize_text(text)).alias("tokens"))


def tokenize(docs: DataFrame, text: str = "text", key: str = "doc_id", stops: DataFrame | None = None,
             min_len: int = 0) -> DataFrame:
    """One row per token occurrence (key, pos, token).

    ``stops`` (a one-column ``token`` frame of bounded size) removes stop words by
    broadcast anti-join (J1); ``min_len`` keeps tokens longer than it (P10).
    """
    # explode_outer + null filter: a plain explode makes the optimizer add a
    # size(tokens) > 0 pre-filter that evaluates the whole tokeniser again
    # below any exchange, before the rows are spread over the cluster
    toks = token_arrays(docs, text, key).select(key, F.posexplode_outer("tokens").alias("pos", "token")).filter(
        F.col("token").isNotNull())
    if min_len:
        toks = toks.filter(F.length("token") > min_len)
    if stops is not None:
        toks = toks.join(stops.select("token"), "token", "left_anti")  # AQE broadcasts a short list
    return toks


def unigram_counts(tokens: DataFrame) -> DataFrame:
    """A1: (token, n)."""
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def total_tokens(unigrams: DataFrame) -> Column:
    """A2: total token count as a scalar subquery column."""
    return unigrams.select(F.sum("n").cast("bigint")).scalar()


def postings(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """(token, doc_id, tf)."""
    return tokens.groupBy("token", key).agg(F.count(F.lit(1)).alias("tf"))


def index_nested(post: DataFrame, key: str = "doc_id", max_postings: int = MAX_POSTINGS) -> DataFrame:
    """A4: nested postings per term with df and total tf.

    A term's postings are split into ``ceil(df / max_postings)`` chunks by a hash of
    the doc id, so no group holds much more than ``max_postings`` entries however
    hot the term; every posting is kept. Output: token, chunk, df, total_tf,
    postings (``doc:tf`` sorted by doc, comma separated).
    """
    stats = post.groupBy("token").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").cast("bigint").alias("total_tf"))
    # the chunk's hash only for terms of several chunks
    bucket = F.when(F.col("df") <= max_postings, F.lit(0)).otherwise(F.pmod(md5_bucket(key), F.ceil(F.col("df") / F.lit(max_postings))))
    with_chunk = post.join(stats, "token").withColumn("chunk", bucket.cast("bigint"))
    # dealt out by chunk, or the join's partitioning by token would keep a hot term's chunks in one task
    with_chunk = with_chunk.repartition("token", "chunk")
    return with_chunk.groupBy("token", "chunk", "df", "total_tf").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(key).alias("d"), F.col("tf").alias("t")))),
                lambda s: F.concat(s["d"].cast("string"), F.lit(":"), s["t"].cast("string")),
            ),
            ",",
        ).alias("postings")
    )


def doc_term_map(post: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per document, map token -> tf (bounded by the document's length)."""
    return post.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("token", "tf"))).alias("terms"))


def term_totals(post: DataFrame) -> DataFrame:
    """A5: (token, total)."""
    return post.groupBy("token").agg(F.sum("tf").cast("bigint").alias("total"))


def top_terms(counts: DataFrame, k: int = 30, value: str = "n") -> DataFrame:
    """Top k by count desc, token asc (Q4); rank assigned after the
    limit, so the only global sort is over k rows (TakeOrderedAndProject)."""
    order = [F.col(value).desc(), F.col("token").asc()]
    top = counts.orderBy(*order).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def zipf(counts: DataFrame, k: int = 30) -> DataFrame:
    """Top-k rank/frequency plus the log-log slope fitted over those k points."""
    top = top_terms(counts, k)
    return top.withColumn("slope", F.regr_slope(F.log("n"), F.log("rank")).over(Window.partitionBy()))


# --------------------------------------------------------------------------- T3/T4
def typo_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """Query words for the spelling jobs: the distinct tokens of ``texts`` with the
    middle letter of each token of three or more letters removed."""
    toks = texts.select(F.explode_outer(X.word_tokens(X.normalize_text(text))).alias("t")).filter(
        F.col("t").isNotNull()).distinct()
    n = F.length("t")
    half = F.floor(n / 2).cast("int")
    word = F.when(n >= 3, F.concat(F.col("t").substr(F.lit(1), half), F.col("t").substr(half + 2, F.lit(1 << 30))))
    return toks.select(word.otherwise(F.col("t")).alias("word")).distinct()


def spell_index(unigrams: DataFrame) -> DataFrame:
    """The symmetric-delete index of a vocabulary (token, n): one row (part, at, letter, token, n) for each term
    and each of its one-character deletions."""
    return unigrams.select("token", "n", F.inline(X.deletions("token"))).select("part", "at", "letter", "token", "n")


def spell_candidates(words: DataFrame, unigrams: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """(word, candidate, n) for the terms one edit away (a-z): a word of n letters meets the index on its
    n + 1 deletions instead of some 54 n generated candidates.

    Two strings one edit apart share a deletion, or one is a deletion of the other; the places and letters deleted
    tell exactly whether the edit is a deletion, an adjacent transposition, or a replacement or insertion of a-z.
    ``index`` is a stored ``spell_index`` of the vocabulary."""
    index = spell_index(unigrams) if index is None else index
    w = words.select("word", F.inline(X.deletions("word"))).toDF("word", "part", "w_at", "w_letter")
    latin = F.col("letter").between("a", "z")
    both = (F.col("at") >= 0) & (F.col("w_at") >= 0)
    replaced = both & (F.col("at") == F.col("w_at")) & latin
    swapped = both & (F.abs(F.col("at") - F.col("w_at")) == 1) & (F.col("letter") == F.col("w_letter"))
    inserted = (F.col("w_at") < 0) & (F.col("at") >= 0) & latin
    deleted = (F.col("w_at") >= 0) & (F.col("at") < 0)
    met = w.join(index, "part").filter(replaced | swapped | inserted | deleted)
    return met.select("word", F.col("token").alias("candidate"), "n").distinct()


def spell_proba(words: DataFrame, unigrams: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Each in-vocabulary candidate with n / total."""
    total = total_tokens(unigrams)
    return spell_candidates(words, unigrams, index).select(
        "word", "candidate", "n", (F.col("n").cast("double") / total.cast("double")).alias("proba")
    )


def spell_correct(words: DataFrame, unigrams: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """T4: most frequent candidate, ties to the smallest candidate; null when no
    candidate is in the vocabulary (Q5)."""
    best = spell_candidates(words, unigrams, index).groupBy("word").agg(
        F.min(F.struct(F.negative("n").alias("neg_n"), F.col("candidate"))).alias("b")
    )
    return (
        words.select("word").distinct()
        .join(best, "word", "left")
        .select("word", F.col("b.candidate").alias("correction"), F.negative("b.neg_n").alias("n"))
    )


# --------------------------------------------------------------------------- T5/J5/T6
def vocabulary(post: DataFrame) -> DataFrame:
    """T5: per term: soundex code and document frequency (computed once per term)."""
    return post.groupBy("token").agg(F.count(F.lit(1)).alias("df")).withColumn("soundex", X.soundex_code("token"))


def resolve_terms(words: DataFrame, vocab: DataFrame) -> DataFrame:
    """Word -> the exact term, else the alphabetically first term with the same
    soundex, else dropped. Output: word, term, matched ('exact' | 'soundex')."""
    # read for the exact and for the phonetic match, but counted once
    terms = stored(vocab.select(F.col("token").alias("term"), "soundex"), "terms")
    by_code = terms.groupBy("soundex").agg(F.min("term").alias("sx_term"))
    w = words.select("word").distinct().withColumn("soundex", X.soundex_code("word"))
    exact = w.join(terms.select("term"), w["word"] == F.col("term"), "left")
    out = exact.join(by_code, "soundex", "left").select(
        "word",
        F.coalesce("term", "sx_term").alias("term"),
        F.when(F.col("term").isNotNull(), F.lit("exact")).otherwise(F.lit("soundex")).alias("matched"),
    )
    return out.filter(F.col("term").isNotNull())


def search(queries: DataFrame, post: DataFrame, doc_map: DataFrame, k: int = 3, qkey: str = "query_id",
           text: str = "text", key: str = "doc_id", stops: DataFrame | None = None,
           vocab: DataFrame | None = None, merge_docs: bool = False) -> DataFrame:
    """Batch search. Query words are normalised like the index, resolved
    by J5, all postings of the resolved terms are ranked by tf desc (ties: doc id,
    then term) and the first k with a known URL are returned per query.

    ``row_number() <= k`` is planned with a map-side group limit, so a query that
    hits a hot term only ships k rows per map partition. ``vocab`` is a stored ``vocabulary``
    (else it is counted from the postings). ``merge_docs`` gives each document one hit: its tf
    summed over the query's terms, the terms joined by a space.
    """
    words = tokenize(queries, text=text, key=qkey, stops=stops).select(qkey, F.col("token").alias("word")).distinct()
    resolved = resolve_terms(words, vocabulary(post) if vocab is None else vocab)
    hits = (
        words.join(resolved, "word")
        .select(qkey, "term").distinct()
        .join(post.select(F.col("token").alias("term"), key, "tf"), "term")
    )
    if merge_docs:
        hits = hits.groupBy(qkey, key).agg(  # at most a query's own terms
            F.sum("tf").cast("bigint").alias("tf"), F.array_join(F.sort_array(F.collect_list("term")), " ").alias("term"))
    hits = hits.join(doc_map.select(key, "url"), key)
    w = Window.partitionBy(qkey).orderBy(F.col("tf").desc(), F.col(key).asc(), F.col("term").asc())
    return (
        hits.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(qkey, F.col("rank").cast("bigint").alias("rank"), key, "url", "term", "tf")
    )


# --------------------------------------------------------------------------- S10 / O3 with blocks
#: Postings of an impact-ordered block.
BLOCK = 128


def impact_blocks(post: DataFrame, key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """Postings (token, key, tf) in impact order (tf descending, then key), cut into blocks.

    Output: token, no (ascending in that order), lead (whether it is the token's first), tf and first (of its best posting),
    entries (array of (ntf: -tf, doc)). Places come from the distributed dense order, so a hot token is not one group;
    a block holds ``block`` postings of one token at most."""
    placed = dense_id(post.select("token", F.col(key).alias("doc"), F.negative("tf").alias("ntf")), ["token", "ntf", "doc"], out="__at")
    entry = F.struct("ntf", "doc")
    blocks = placed.groupBy("token", F.floor(F.col("__at") / block).alias("no")).agg(
        F.min(entry).alias("best"), F.sort_array(F.collect_list(entry)).alias("entries"))
    leads = placed.groupBy("token").agg(F.floor(F.min("__at") / block).alias("lead"))
    return blocks.join(leads, "token").select(
        "token", "no", (F.col("no") == F.col("lead")).alias("lead"), F.negative("best.ntf").alias("tf"),
        F.col("best.doc").alias("first"), "entries")


def search_blocks(queries: DataFrame, blocks: DataFrame, vocab: DataFrame, doc_map: DataFrame, k: int = 3,
                  qkey: str = "query_id", text: str = "text", key: str = "doc_id", stops: DataFrame | None = None) -> DataFrame:
    """T6/O3 over ``impact_blocks``: as ``search``, but a term is read only as far as its postings can enter the first k.

    The first block of each term gives a query's k best so far. Of the other blocks only the best posting (tf, first)
    is compared with the last of these: where it ranks behind, so does the whole block, and its entries stay
    unread. One more step is enough, since no block left out can hold a hit."""
    words = tokenize(queries, text=text, key=qkey, stops=stops).select(qkey, F.col("token").alias("word")).distinct()
    terms = words.join(resolve_terms(words, vocab), "word").select(qkey, F.col("term").alias("token")).distinct()
    terms = cut_lineage(terms)
    order = Window.partitionBy(qkey).orderBy("ntf", "doc", "token")

    def best(hits: DataFrame) -> DataFrame:
        return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def opened(rows: DataFrame) -> DataFrame:
        return rows.select(qkey, "token", F.inline("entries"))

    lead = cut_lineage(best(opened(terms.join(blocks.filter("lead"), "token"))))
    last = lead.filter(F.col("rank") == k).select(F.col(qkey).alias("__q"), F.struct("ntf", "doc", "token").alias("last"))
    heads = blocks.filter(~F.col("lead")).select("token", "no", F.negative("tf").alias("ntf"), F.col("first").alias("doc"))
    open_ = terms.join(heads, "token").join(last, F.col(qkey).eqNullSafe(F.col("__q")), "left")
    open_ = open_.filter(F.col("last").isNull() | (F.struct("ntf", "doc", "token") < F.col("last")))
    wanted = open_.select(qkey, "token", "no")
    more = opened(wanted.join(blocks.filter(~F.col("lead")).select("token", "no", "entries"), ["token", "no"]))
    hits = best(lead.drop("rank").unionByName(more)).join(doc_map.select(F.col(key).alias("doc"), "url"), "doc")
    return hits.select(qkey, F.col("rank").cast("bigint").alias("rank"), F.col("doc").alias(key), "url", F.col("token").alias("term"), F.negative("ntf").alias("tf"))


def spell(words: DataFrame, unigrams: DataFrame, proba: bool = False, correct: bool = False,
          index: DataFrame | None = None) -> DataFrame:
    """T3/T4 entry with the two modes mutually exclusive."""
    if proba == correct:
        raise ValueError("choose exactly one of proba=True or correct=True")
    return spell_proba(words, unigrams, index) if proba else spell_correct(words, unigrams, index)
