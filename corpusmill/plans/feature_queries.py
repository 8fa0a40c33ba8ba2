"""Feature, sampling and join queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import features as FE
from corpusmill.plans import sqlfrag as S
from corpusmill.plans.registry import register
from corpusmill.sources.tables import table


def _h(seed, *cols) -> str:
    inner = " || ':' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"('0x' || substr(md5('{seed}:' || {inner}), 1, 8))::BIGINT"


def _labelled(spark, sf):
    """Documents with their labels."""
    return table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")


@register(
    "labelled_docs",
    "SELECT doc_id, quality, toxic, lang, n_chars FROM labels JOIN documents USING (doc_id)",
)
def q_labelled_docs(spark, sf):
    return _labelled(spark, sf).select("doc_id", "quality", "toxic", "lang", "n_chars")


@register(
    "dataset_union",
    "SELECT doc_id AS row_id, lang AS label, 'documents' AS dataset FROM documents "
    "UNION ALL SELECT conv_id, role, 'conversations' FROM conversations",
)
def q_dataset_union(spark, sf):
    """Two labelled sets as one, by column name, each row with its set's name."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), F.col("lang").alias("label"), F.lit("documents").alias("dataset"))
    turns = table(spark, sf, "conversations").select(F.lit("conversations").alias("dataset"), F.col("role").alias("label"), F.col("conv_id").alias("row_id"))
    return docs.unionByName(turns)


@register("label_encode", "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code FROM orders")
def q_label_encode(spark, sf):
    enc = FE.label_encode(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                          out="code")
    return enc.select("o_orderkey", "code")


@register(
    "one_hot",
    "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus_F, "
    "CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O, CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P "
    "FROM orders",
)
def q_one_hot(spark, sf):
    return FE.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus").drop(
        "o_orderstatus")


@register("split_rows", f"SELECT o_orderkey, {_h(42, 'o_orderkey')} % 1000 < 800 AS is_train FROM orders")
def q_split_rows(spark, sf):
    return FE.split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.8, 42)


@register(
    "undersample_rows",
    f"""WITH d AS (SELECT doc_id, quality FROM labels),
    r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {_h(42, 'doc_id')}, doc_id) - 1 AS pos
          FROM d)
    SELECT doc_id, quality FROM r WHERE pos < (SELECT min(c) FROM (SELECT count(*) AS c FROM d GROUP BY quality))""",
)
def q_undersample_rows(spark, sf):
    return FE.undersample(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id", 42)


@register(
    "oversample_rows",
    f"""WITH d AS (SELECT doc_id, quality FROM labels),
    p AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS pos,
                 count(*) OVER (PARTITION BY quality) AS n_class FROM d),
    sz AS (SELECT quality, count(*) AS n_class FROM d GROUP BY quality),
    need AS (SELECT quality, n_class, (SELECT max(n_class) FROM sz) - n_class AS deficit FROM sz WHERE
             (SELECT max(n_class) FROM sz) > n_class),
    slots AS (SELECT quality, n_class, unnest(range(0, deficit)) AS slot FROM need),
    draws AS (SELECT s.quality, {_h(42, 's.quality', 's.slot')} % s.n_class AS pos FROM slots s)
    SELECT doc_id, quality FROM d
    UNION ALL SELECT p.doc_id, p.quality FROM draws JOIN p ON p.quality = draws.quality AND p.pos = draws.pos""",
)
def q_oversample_rows(spark, sf):
    return FE.oversample(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id", 42)


@register(
    "fold_sizes",
    """SELECT quality, fold, count(*) AS n FROM (SELECT quality,
        ntile(5) OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS fold FROM labels) GROUP BY quality, fold""",
)
def q_fold_sizes(spark, sf):
    f = FE.stratified_folds(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id", 5)
    return f.groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n"))


@register(
    "folds",
    "SELECT doc_id, ntile(5) OVER (PARTITION BY quality ORDER BY doc_id) - 1 AS fold FROM labels",
)
def q_folds(spark, sf):
    f = FE.stratified_folds(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id", 5)
    return f.select("doc_id", "fold")


TERM_COUNTS_SQL = f"""SELECT doc_id, term, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(translate(text, {S.q(X.ACCENTED)}, {S.q(X.UNACCENTED)})),
                                             {S.q('(' + X.VEC_TOKEN + ')')}, 1)) AS term FROM documents)
    WHERE term NOT IN {S.STOP_LIST} GROUP BY doc_id, term"""


@register("term_counts_vec", TERM_COUNTS_SQL)
def q_term_counts_vec(spark, sf):
    return FE.term_counts(table(spark, sf, "documents"))


@register(
    "tfidf",
    f"""WITH c AS ({TERM_COUNTS_SQL}), nd AS (SELECT count(DISTINCT doc_id) AS n FROM c),
    df AS (SELECT term, count(*) AS df FROM c GROUP BY term),
    w AS (SELECT doc_id, term, n * (ln((1 + (SELECT n FROM nd)) / (1 + df)) + 1) AS w FROM c JOIN df USING (term)),
    nr AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY doc_id)
    SELECT doc_id, term, round(w / norm, 6) AS weight FROM w JOIN nr USING (doc_id)""",
)
def q_tfidf(spark, sf):
    t = FE.tfidf(FE.term_counts(table(spark, sf, "documents")))
    return t.withColumn("weight", F.round("weight", 6))
