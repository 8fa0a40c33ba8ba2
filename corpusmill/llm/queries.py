"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
END_ID = 1
#: The free id of the rank file, used as end of document.
SEPARATOR = 50_256


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query()
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents encoded and decoded, as digests."""
    from corpusmill.llm.bpe import round_trip

    return round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@query("""
    WITH w AS (
        SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w
        FROM documents
    ), s AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                            ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
        FROM w
    ), e AS (
        SELECT doc_id, unnest(s) AS g FROM s
    ), p AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
    ), l AS (
        SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b
        WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)
    ), r AS (
        WITH RECURSIVE t(id, comp) AS (
            SELECT doc_id, doc_id FROM s
            UNION
            SELECT l.b, t.comp FROM t JOIN l ON l.a = t.id
        ) SELECT id, min(comp) AS comp FROM t GROUP BY id
    )
    SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, r.comp AS component_id, s.doc_id = r.comp AS kept
    FROM s JOIN r ON r.id = s.doc_id""")
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    from corpusmill.llm.near_dedup import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"))


@query()
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of 2048 tokens."""
    from corpusmill.llm.packing import pack_documents

    return pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), END_ID)


@query()
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every fiftieth id."""
    from corpusmill.llm.ann import nearest

    rows = read(spark, sf_dir, "embeddings")
    return nearest(rows, rows.filter("vec_id % 50 = 0"), 5)


@query()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with words, its class's first line, and whether it goes."""
    from corpusmill.llm.line_dedup import later_matches

    return later_matches(read(spark, sf_dir, "documents"))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learnt outside the held-out fold."""
    from corpusmill.llm.toxicity import toxicity

    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


SHARDS = [f"shard-{i:02d}" for i in range(64)]


def _shard_sql() -> str:
    from corpusmill.llm.sharding import lookup_table

    table = lookup_table(SHARDS)
    return f"""
    WITH t AS (SELECT {table} AS shards),
    d AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {len(table)} AS slot FROM documents)
    SELECT doc_id, slot, shards[slot + 1] AS shard FROM d, t"""


@query(_shard_sql())
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's slot and shard of 64."""
    from corpusmill.llm.sharding import place

    return place(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


@query("""
    WITH t AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)""")
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents."""
    from corpusmill.llm.exact_dedup import exact_duplicates

    return exact_duplicates(read(spark, sf_dir, "documents"))


@query()
def op9_token_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, by scanning flat token files for separators."""
    from corpusmill.llm.token_scan import counted_documents

    return counted_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, SEPARATOR)


@query()
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back."""
    from corpusmill.llm.warc import pages_round_trip

    return pages_round_trip(read(spark, sf_dir, "pages"))


@query("""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
    ), e AS (
        SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d
    ), v AS (
        SELECT r, x, i, string_agg(x, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS s,
               count(*) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) = 35 AS whole
        FROM e
    ), t AS (
        SELECT s FROM v WHERE whole GROUP BY s HAVING count(*) > 1
    ), c AS (
        SELECT r, x, i, bool_or(whole AND t.s IS NOT NULL) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
        FROM v LEFT JOIN t ON t.s = v.s
    ), k AS (
        SELECT r, count(*) FILTER (WHERE gone) AS n_removed, string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM c GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN k ON k.r = d.r""")
def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document without the passages that repeat anywhere."""
    from corpusmill.llm.passages import repeated_passages

    return repeated_passages(read(spark, sf_dir, "documents"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of all vectors."""
    from corpusmill.llm.whitening import whitened

    return whitened(read(spark, sf_dir, "embeddings"))


@query("""
    WITH d AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents
    ), w AS (
        SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\\x20\\x09]+') IF x <> ''] AS w FROM d
    ), p AS (
        SELECT lang, row_number() OVER () AS id, w FROM w
    ), e AS (
        SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p
    ), v AS (
        SELECT lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3, lead(w1, 3) OVER o AS w4, lead(w1, 4) OVER o AS w5
        FROM e WINDOW o AS (PARTITION BY id ORDER BY i)
    ), g AS (
        SELECT lang, k, phrase, count(*) AS f FROM (
            SELECT lang, 1 AS k, w1 AS phrase FROM v
            UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM v
            UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM v
            UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM v
            UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM v
        ) WHERE phrase IS NOT NULL GROUP BY ALL
    ), n AS (
        SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang
    ), c AS (
        SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k >= 2 AND f >= 100
    ), cut AS (
        SELECT c.lang, c.phrase, a, j, x.f AS l, y.f AS r, n, CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
        FROM c JOIN range(1, 5) t(j) ON j < c.k JOIN n ON n.lang = c.lang
        JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1:j], ' ')
        JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(ws[j + 1:], ' ')
    ), best AS (
        SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
    ), kept AS (
        SELECT * FROM best b WHERE NOT EXISTS (
            SELECT 1 FROM c WHERE c.lang = b.lang AND c.phrase <> b.phrase AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.a >= 100 * b.a)
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept QUALIFY rank <= 2000""")
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first collocations of every language."""
    from corpusmill.llm.phrases import collocations

    return collocations(read(spark, sf_dir, "documents"))
