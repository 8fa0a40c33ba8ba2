"""Statistics and metric queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import sketches as SK
from corpusmill.operators import stats as ST
from corpusmill.plans import sqlfrag as S
from corpusmill.plans.registry import register
from corpusmill.sources.tables import table

R = 6  # decimals kept for floating results on both sides

# Marker words of the rule-based language guess that produces the
# predicted labels scored by the metric queries (first language wins ties).
LANG_MARKERS = {
    "en": ("the", "and", "of", "to"),
    "fr": ("le", "les", "des", "du"),
    "de": ("der", "die", "und", "das"),
    "es": ("el", "los", "las", "y"),
}


def _member_of(words):
    return lambda t: t.isin(*words)


def guess_lang(text):
    toks = X.split_words(X.normalize_text(text))
    cnt = {k: F.size(F.filter(toks, _member_of(ws))) for k, ws in LANG_MARKERS.items()}
    e, f, d, s = cnt["en"], cnt["fr"], cnt["de"], cnt["es"]
    return (F.when((e >= f) & (e >= d) & (e >= s), "en").when((f >= d) & (f >= s), "fr")
            .when(d >= s, "de").otherwise("es"))


def _guess_lang_sql(t: str) -> str:
    toks = S.split_words(S.normalize(t))
    c = {k: f"len(list_filter({toks}, lambda w: w IN ({', '.join(S.q(x) for x in ws)})))"
         for k, ws in LANG_MARKERS.items()}
    e, f, d, s = c["en"], c["fr"], c["de"], c["es"]
    return (f"CASE WHEN {e} >= {f} AND {e} >= {d} AND {e} >= {s} THEN 'en' WHEN {f} >= {d} AND {f} >= {s} THEN 'fr' "
            f"WHEN {d} >= {s} THEN 'de' ELSE 'es' END")


LANG_PRED_SQL = f"SELECT doc_id, lang AS y, {_guess_lang_sql('text')} AS p FROM documents"


def _lang_pred(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.col("lang").alias("y"), guess_lang("text").alias("p"))


QUALITY_SQL = ("SELECT l.doc_id, l.quality AS y, CASE WHEN d.n_chars >= 1000 THEN 1 ELSE 0 END AS p "
               "FROM labels l JOIN documents d USING (doc_id)")


def _quality_pred(spark, sf):
    lab = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    docs = table(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars") >= 1000, 1).otherwise(0).alias("p"))
    return lab.join(docs, "doc_id")


def _rnd(df, cols, digits=R):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# A6 / A7 ------------------------------------------------------------------------
#: Digits of descriptions: a mean of cents ends in a tie at six.
D = 7


def _describe_sql(tab: str, cols) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({x}), {D}) AS mean, "
            f"round(stddev_samp({x}), {D}) AS std, round(min({x}), {D}) AS min, "
            f"round(quantile_cont({x}, 0.25), {D}) AS q25, round(quantile_cont({x}, 0.5), {D}) AS q50, "
            f"round(quantile_cont({x}, 0.75), {D}) AS q75, round(max({x}), {D}) AS max FROM {tab}")
    return " UNION ALL ".join(parts)


_DESC = ["mean", "std", "min", "q25", "q50", "q75", "max"]


@register("describe_table", _describe_sql("lineitem", LI_COLS))
def q_describe_table(spark, sf):
    return _rnd(ST.describe(table(spark, sf, "lineitem"), LI_COLS), _DESC, D)


@register("describe_column", _describe_sql("orders", ["o_totalprice"]))
def q_describe_column(spark, sf):
    return _rnd(ST.describe(table(spark, sf, "orders"), ["o_totalprice"]), _DESC, D)


# A8 ----------------------------------------------------------------------------
@register(
    "histogram_by",
    f"""WITH m AS (SELECT o_orderstatus, min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders GROUP BY 1),
    b AS (SELECT o.o_orderstatus, mn, mx, CAST(CASE WHEN mx = mn THEN 0
          ELSE least(floor((o_totalprice - mn) / (mx - mn) * 35), 34) END AS BIGINT) AS bin
          FROM orders o JOIN m USING (o_orderstatus))
    SELECT o_orderstatus, bin, round(mn + bin * ((mx - mn) / 35), {R}) AS lo,
           round(mn + (bin + 1) * ((mx - mn) / 35), {R}) AS hi, count(*) AS n FROM b GROUP BY o_orderstatus, bin, mn, mx""",
)
def q_histogram_by(spark, sf):
    h = ST.histogram(table(spark, sf, "orders"), "o_totalprice", 35, ["o_orderstatus"])
    return _rnd(h, ["lo", "hi"])


# A9 ----------------------------------------------------------------------------
@register(
    "boxplot_by",
    f"""WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
                   quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
                   FROM lineitem GROUP BY 1),
    j AS (SELECT l.l_returnflag, l.l_extendedprice AS x, q1, median, q3, q3 - q1 AS iqr FROM lineitem l JOIN q USING (l_returnflag))
    SELECT l_returnflag, round(q1, {R}) AS q1, round(median, {R}) AS median, round(q3, {R}) AS q3,
           round(min(x) FILTER (WHERE x >= q1 - 1.5 * iqr), {R}) AS whisker_lo,
           round(max(x) FILTER (WHERE x <= q3 + 1.5 * iqr), {R}) AS whisker_hi,
           CAST(count(*) FILTER (WHERE x < q1 - 1.5 * iqr OR x > q3 + 1.5 * iqr) AS BIGINT) AS outliers
    FROM j GROUP BY l_returnflag, q1, median, q3""",
)
def q_boxplot_by(spark, sf):
    b = ST.boxplot(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])
    return _rnd(b, ["q1", "median", "q3", "whisker_lo", "whisker_hi"])


# A10 ---------------------------------------------------------------------------
@register("value_counts", "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def q_value_counts(spark, sf):
    return ST.value_counts(table(spark, sf, "orders"), "o_orderpriority")


# A26 ---------------------------------------------------------------------------
@register("shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_cols FROM lineitem")
def q_shape(spark, sf):
    return ST.shape(table(spark, sf, "lineitem"))


# A18 / A19 -----------------------------------------------------------------------
@register(
    "confusion",
    f"""WITH d AS ({LANG_PRED_SQL}), l AS (SELECT y AS l FROM d UNION SELECT p FROM d),
    c AS (SELECT y, p, count(*) AS n FROM d GROUP BY y, p)
    SELECT a.l AS y, b.l AS p, coalesce(c.n, 0) AS n FROM l a, l b LEFT JOIN c ON c.y = a.l AND c.p = b.l""",
)
def q_confusion(spark, sf):
    return ST.confusion(_lang_pred(spark, sf))


def _prf_sql(src: str, average: str, pos=None) -> str:
    base = f"""WITH d AS ({src}), l AS (SELECT y AS l FROM d UNION SELECT p FROM d),
    pc AS (SELECT l.l AS label, count(*) FILTER (WHERE d.y = l.l AND d.p = l.l) AS tp,
                  count(*) FILTER (WHERE d.p = l.l AND d.y <> l.l) AS fp,
                  count(*) FILTER (WHERE d.y = l.l AND d.p <> l.l) AS fn,
                  count(*) FILTER (WHERE d.y = l.l) AS support FROM l, d GROUP BY l.l),
    m AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS pr,
                 CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS rc FROM pc),
    f AS (SELECT *, CASE WHEN pr + rc = 0 THEN 0.0 ELSE 2 * pr * rc / (pr + rc) END AS f FROM m),
    acc AS (SELECT sum(tp) / sum(support) AS accuracy FROM f)"""
    if average == "binary":
        return base + (f" SELECT round(accuracy, {R}) AS accuracy, round(pr, {R}) AS precision, round(rc, {R}) AS recall, "
                       f"round(f, {R}) AS f1 FROM acc, f WHERE label = {pos}")
    if average == "weighted":
        return base + (f" SELECT round(sum(tp) / sum(support), {R}) AS accuracy, "
                       f"round(sum(pr * support) / sum(support), {R}) AS precision, "
                       f"round(sum(rc * support) / sum(support), {R}) AS recall, "
                       f"round(sum(f * support) / sum(support), {R}) AS f1 FROM f")
    return base + (f", mi AS (SELECT sum(tp) / sum(support) AS accuracy, sum(tp) / (sum(tp) + sum(fp)) AS precision, "
                   f"sum(tp) / (sum(tp) + sum(fn)) AS recall FROM f) SELECT round(accuracy, {R}) AS accuracy, "
                   f"round(precision, {R}) AS precision, round(recall, {R}) AS recall, "
                   f"round(2 * precision * recall / (precision + recall), {R}) AS f1 FROM mi")


_PRF = ["accuracy", "precision", "recall", "f1"]


@register("prf_binary", _prf_sql(QUALITY_SQL, "binary", 0))
def q_prf_binary(spark, sf):
    return _rnd(ST.prf(_quality_pred(spark, sf), average="binary", pos_label=0), _PRF)


@register("prf_weighted", _prf_sql(LANG_PRED_SQL, "weighted"))
def q_prf_weighted(spark, sf):
    return _rnd(ST.prf(_lang_pred(spark, sf), average="weighted"), _PRF)


@register("f1_micro", _prf_sql(LANG_PRED_SQL, "micro"))
def q_f1_micro(spark, sf):
    return _rnd(ST.prf(_lang_pred(spark, sf), average="micro"), _PRF)


# A20 ---------------------------------------------------------------------------
ONEHOT_SQL_SRC = """SELECT CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END AS y_a,
    CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END AS y_n, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y_r,
    l_discount / (l_discount + l_tax + 0.1) AS p_a, l_tax / (l_discount + l_tax + 0.1) AS p_n,
    0.1 / (l_discount + l_tax + 0.1) AS p_r FROM lineitem"""


def _onehot_sql() -> str:
    ys, ps = ["y_a", "y_n", "y_r"], ["p_a", "p_n", "p_r"]
    clip = lambda c: f"greatest(0.0, least(1.0, {c}))"
    tp = " + ".join(f"round_even({clip(f'{y} * {p}')}, 0)" for y, p in zip(ys, ps))
    pp = " + ".join(f"round_even({clip(p)}, 0)" for p in ps)
    ap = " + ".join(f"round_even({clip(y)}, 0)" for y in ys)
    se = " + ".join(f"({y} - {p}) ^ 2" for y, p in zip(ys, ps))
    ce = " + ".join(f"{y} * ln(greatest({ST.EPS_KERAS}, least({1 - ST.EPS_KERAS}, {p})))" for y, p in zip(ys, ps))
    e = ST.EPS_KERAS
    return f"""WITH s AS (SELECT sum({tp}) AS tp, sum({pp}) AS pp, sum({ap}) AS ap, sum({se}) / (count(*) * 3) AS mse,
                        -avg({ce}) AS cce FROM ({ONEHOT_SQL_SRC})),
    m AS (SELECT tp / (pp + {e}) AS precision, tp / (ap + {e}) AS recall, mse, cce FROM s)
    SELECT round(precision, {R}) AS precision, round(recall, {R}) AS recall,
           round(2 * precision * recall / (precision + recall + {e}), {R}) AS f1, round(mse, {R}) AS mse,
           round(cce, {R}) AS cce FROM m"""


@register("onehot_metrics", _onehot_sql())
def q_onehot_metrics(spark, sf):
    li = table(spark, sf, "lineitem")
    den = F.col("l_discount") + F.col("l_tax") + F.lit(0.1)
    df = li.select(*[F.when(F.col("l_returnflag") == k, 1.0).otherwise(0.0).alias(f"y_{k.lower()}") for k in "ANR"],
                   (F.col("l_discount") / den).alias("p_a"), (F.col("l_tax") / den).alias("p_n"),
                   (F.lit(0.1) / den).alias("p_r"))
    m = ST.onehot_metrics(df, ["y_a", "y_n", "y_r"], ["p_a", "p_n", "p_r"])
    return _rnd(m, ["precision", "recall", "f1", "mse", "cce"])


# A21 ---------------------------------------------------------------------------
@register(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), {R}) AS corr FROM lineitem"
        for a in LI_COLS for b in LI_COLS),
)
def q_corr_matrix(spark, sf):
    return _rnd(ST.corr_matrix(table(spark, sf, "lineitem"), LI_COLS), ["corr"])


# A22 - A25 ---------------------------------------------------------------------
@register("contingency", "SELECT lang AS a, source AS b, count(*) AS n FROM documents GROUP BY 1, 2")
def q_contingency(spark, sf):
    return ST.contingency(table(spark, sf, "documents"), "lang", "source")


_CT = """WITH ct AS (SELECT lang AS a, source AS b, count(*) AS n FROM documents GROUP BY 1, 2),
    ra AS (SELECT a, sum(n) AS m FROM ct GROUP BY a), cb AS (SELECT b, sum(n) AS m FROM ct GROUP BY b),
    tot AS (SELECT CAST(sum(n) AS DOUBLE) AS n FROM ct)"""


@register(
    "ari",
    _CT + f""", s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM ct) AS idx, (SELECT sum(m * (m - 1) / 2) FROM ra) AS sa,
                (SELECT sum(m * (m - 1) / 2) FROM cb) AS sb, (SELECT n * (n - 1) / 2 FROM tot) AS pairs),
    e AS (SELECT idx, sa * sb / pairs AS expected, (sa + sb) / 2 AS mx FROM s)
    SELECT round(CASE WHEN mx = expected THEN 1.0 ELSE (idx - expected) / (mx - expected) END, {R}) AS ari FROM e""",
)
def q_ari(spark, sf):
    return _rnd(ST.ari(table(spark, sf, "documents"), "lang", "source"), ["ari"])


@register(
    "completeness",
    _CT + f""", mi AS (SELECT sum(ct.n / tot.n * (ln(ct.n * tot.n) - ln(ra.m * cb.m))) AS mi
                 FROM ct JOIN ra USING (a) JOIN cb USING (b), tot),
    hp AS (SELECT -sum(m / tot.n * ln(m / tot.n)) AS h FROM cb, tot)
    SELECT round(CASE WHEN h = 0 THEN 1.0 ELSE mi / h END, {R}) AS completeness FROM mi, hp""",
)
def q_completeness(spark, sf):
    return _rnd(ST.completeness(table(spark, sf, "documents"), "lang", "source"), ["completeness"])


@register(
    "ami",
    _CT + f""", mi AS (SELECT sum(ct.n / tot.n * (ln(ct.n * tot.n) - ln(ra.m * cb.m))) AS mi
                 FROM ct JOIN ra USING (a) JOIN cb USING (b), tot),
    h AS (SELECT (SELECT -sum(m / tot.n * ln(m / tot.n)) FROM ra, tot) AS ha, (SELECT -sum(m / tot.n * ln(m / tot.n)) FROM cb, tot) AS hb),
    cells AS (SELECT CAST(ra.m AS DOUBLE) AS x, CAST(cb.m AS DOUBLE) AS y, CAST(tot.n AS DOUBLE) AS t,
              CAST(unnest(range(CAST(greatest(1, ra.m + cb.m - tot.n) AS BIGINT), CAST(least(ra.m, cb.m) AS BIGINT) + 1)) AS DOUBLE) AS k
              FROM ra, cb, tot),
    emi AS (SELECT sum(k / t * ln(t * k / (x * y)) * exp(lgamma(x + 1) + lgamma(y + 1) + lgamma(t - x + 1) + lgamma(t - y + 1)
            - lgamma(t + 1) - lgamma(k + 1) - lgamma(x - k + 1) - lgamma(y - k + 1) - lgamma(t - x - y + k + 1))) AS emi FROM cells)
    SELECT round(CASE WHEN (ha + hb) / 2 = emi THEN 1.0 ELSE (mi - emi) / ((ha + hb) / 2 - emi) END, {R}) AS ami FROM mi, h, emi""",
)
def q_ami(spark, sf):
    return _rnd(ST.ami(table(spark, sf, "documents"), "lang", "source"), ["ami"])


# P5 ----------------------------------------------------------------------------
@register("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def q_head_n(spark, sf):
    return table(spark, sf, "orders").orderBy("o_orderkey").limit(5)


# P2 / P4 -----------------------------------------------------------------------
@register(
    "drop_all_zero",
    "SELECT l_orderkey, l_linenumber, CAST(round(l_quantity) AS INTEGER) AS q, "
    "CAST(round(l_discount * 100) AS INTEGER) AS d, CAST(round(l_tax * 100) AS INTEGER) AS t FROM lineitem "
    "WHERE CAST(round(l_quantity) AS INTEGER) + CAST(round(l_discount * 100) AS INTEGER) "
    "+ CAST(round(l_tax * 100) AS INTEGER) <> 0",
)
def q_drop_all_zero(spark, sf):
    from corpusmill.operators.features import drop_all_zero

    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round("l_quantity").cast("int").alias("q"),
        F.round(F.col("l_discount") * 100).cast("int").alias("d"), F.round(F.col("l_tax") * 100).cast("int").alias("t"))
    return drop_all_zero(li, ["q", "d", "t"])


# A6 / A7 / A9 / A11 from stored summaries -------------------------------------------
PARTED = ["l_quantity", "l_extendedprice", "l_discount", "l_suppkey"]


def _month_parts(spark, sf):
    """Line items summed up by month of shipping and return flag, stored once and read back."""
    import uuid

    from corpusmill.session import ensure_checkpoint_dir

    path = f"{ensure_checkpoint_dir(spark)}/line-months-{uuid.uuid4().hex}"
    li = table(spark, sf, "lineitem")
    SK.store(SK.summarise(li, PARTED, F.date_format("l_shipdate", "yyyy-MM"), ["l_returnflag"]), path)
    return SK.stored(spark, path)


_MOMENTS_SQL = " UNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS \"column\", count({c}) AS count, count(*) - count({c}) AS missing, round(avg({c}), {R}) AS mean, "
    f"round(stddev_samp({c}), {R}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM lineitem GROUP BY l_returnflag"
    for c in PARTED)


@register("describe_merged", _MOMENTS_SQL)
def q_describe_merged(spark, sf):
    d = SK.describe_sketch(_month_parts(spark, sf), ["l_returnflag"])
    return d.select("l_returnflag", "column", "count", "missing", F.round("mean", R).alias("mean"), F.round("std", R).alias("std"), "min", "max")


@register("describe_sketch")
def q_describe_sketch(spark, sf):
    """Quartiles and distinct counts of the whole table from the months' sketches (estimates)."""
    return SK.describe_sketch(_month_parts(spark, sf)).select("column", "count", "q25", "q50", "q75", "distinct")


@register("boxplot_sketch")
def q_boxplot_sketch(spark, sf):
    return SK.boxplot_sketch(_month_parts(spark, sf), ["l_returnflag"])
