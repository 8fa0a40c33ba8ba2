"""Stored-page and text-cleaning queries."""
from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import html as H
from corpusmill.operators import paragraphs as PG
from corpusmill.plans import sqlfrag as S
from corpusmill.plans.registry import register
from corpusmill.sources.tables import read_pages, table

PAGE_WORDS_SQL = (
    f"regexp_extract_all(regexp_replace(regexp_replace(html, '[10]+', '', 'g'), '<[^>]*>', '1', 'g'), "
    f"{S.q('(' + X.PAGE_WORD + ')')}, 1)"
)


# S17 --------------------------------------------------------------------------
@register("pages_scan", "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages")
def q_pages_scan(spark, sf):
    return read_pages(spark, sf).select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


# X8 ---------------------------------------------------------------------------
@register(
    "page_bits",
    f"SELECT page_id, bits, CAST(length(bits) AS BIGINT) AS n, "
    f"CAST(length(bits) - length(replace(bits, '1', '')) AS BIGINT) AS n_tags FROM (SELECT page_id, "
    f"{S.page_bits('html')} AS bits FROM pages)",
)
def q_page_bits(spark, sf):
    b = read_pages(spark, sf).select("page_id", X.page_bits("html").alias("bits"))
    return b.select("page_id", "bits", F.length("bits").cast("bigint").alias("n"),
                    (F.length("bits") - F.length(F.regexp_replace("bits", "1", ""))).cast("bigint").alias("n_tags"))


# T8 / W4 / O8 -------------------------------------------------------------------
@register(
    "main_content_span",
    f"""WITH b AS (SELECT page_id, {S.page_bits('html')} AS bits, {PAGE_WORDS_SQL} AS words FROM pages),
    c AS (SELECT page_id, k, CASE WHEN substr(bits, CAST(k + 1 AS INTEGER), 1) = '0' THEN 1 ELSE -1 END AS st
          FROM (SELECT page_id, bits, unnest(range(0, length(bits))) AS k FROM b)),
    s AS (SELECT page_id, k, CAST(coalesce(sum(st) OVER (PARTITION BY page_id ORDER BY k
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s FROM c),
    m AS (SELECT page_id, k AS j, s AS sj, min({{'s': s, 'k': k}}) OVER (PARTITION BY page_id ORDER BY k
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mn FROM s),
    best AS (SELECT page_id, j, sj, mn.k AS i, mn.s AS si,
             row_number() OVER (PARTITION BY page_id ORDER BY sj - mn.s DESC, mn.k, j) AS rk FROM m WHERE j >= 1),
    r AS (SELECT b.page_id, CAST(length(bits) AS BIGINT) AS n, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j,
             CAST(length(bits) - length(replace(bits, '1', '')) + sj - si AS BIGINT) AS f,
             CAST((i + si) // 2 AS BIGINT) AS start, CAST(((j + sj) - (i + si)) // 2 AS BIGINT) AS len, words
          FROM best JOIN b USING (page_id) WHERE rk = 1)
    SELECT page_id, n, i, j, f, start, len,
           CASE WHEN len > 0 THEN array_to_string(words[start + 1 : start + len], ' ') ELSE '' END AS content
    FROM r""",
)
def q_main_content_span(spark, sf):
    return H.main_content(read_pages(spark, sf))


# T13 (re-aimed) ----------------------------------------------------------------
@register(
    "content_surface_rowmax",
    f"""WITH b AS (SELECT page_id, {S.page_bits('html')} AS bits FROM pages),
    c AS (SELECT page_id, k, length(bits) AS n, length(bits) - length(replace(bits, '1', '')) AS t,
                 CASE WHEN substr(bits, CAST(k + 1 AS INTEGER), 1) = '0' THEN 1 ELSE -1 END AS st
          FROM (SELECT page_id, bits, unnest(range(0, length(bits))) AS k FROM b)),
    s AS (SELECT page_id, k, n, t, coalesce(sum(st) OVER (PARTITION BY page_id ORDER BY k
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM c),
    x AS (SELECT *, max(s) OVER (PARTITION BY page_id ORDER BY k ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
          AS max_sj FROM s)
    SELECT page_id, CAST(k AS BIGINT) AS i, CAST(t + max_sj - s AS BIGINT) AS f_max FROM x WHERE k <= n - 2""",
)
def q_content_surface_rowmax(spark, sf):
    return H.surface_row_max(read_pages(spark, sf))


# X20 / P9 ------------------------------------------------------------------------
@register(
    "page_links",
    f"SELECT page_id, CAST(len(l) AS BIGINT) AS n_links, array_to_string(l, ' ') AS links "
    f"FROM (SELECT page_id, {S.page_links('html')} AS l FROM pages)",
)
def q_page_links(spark, sf):
    lk = read_pages(spark, sf).select("page_id", X.page_links("html").alias("l"))
    return lk.select("page_id", F.size("l").cast("bigint").alias("n_links"), F.array_join("l", " ").alias("links"))


# P8 ------------------------------------------------------------------------------
@register(
    "prefix_links",
    f"""SELECT page_id, link FROM (SELECT page_id, url, {S.resolve_link('h', 'url')} AS link
        FROM (SELECT page_id, url, unnest({S.page_links('html')}) AS h FROM pages))
    WHERE starts_with(link, {S.url_origin('url')})""",
)
def q_prefix_links(spark, sf):
    return H.prefix_links(read_pages(spark, sf), prefix="origin").select("page_id", "link")


# T7 / J6 -------------------------------------------------------------------------
@register(
    "frontier_d1",
    f"""WITH seeds AS (SELECT regexp_extract(html, '<html[^>]*\\slang=["'']([^"'']*)["'']', 1) AS topic, url, html
                   FROM pages),
    lk AS (SELECT topic, {S.resolve_link('h', 'url')} AS link, url
           FROM (SELECT topic, url, unnest({S.page_links('html')}) AS h FROM seeds)),
    fetched AS (SELECT lk.topic, p.url FROM lk JOIN pages p ON p.url = lk.link WHERE starts_with(lk.link, lk.url)),
    found AS (SELECT url, topic, 0 AS depth FROM seeds UNION ALL SELECT url, topic, 1 AS depth FROM fetched),
    best AS (SELECT sha256(url) AS url_hash, url, topic, depth,
             row_number() OVER (PARTITION BY sha256(url) ORDER BY depth, topic, url) AS rk FROM found)
    SELECT row_number() OVER (ORDER BY url) - 1 AS doc_id, url, url_hash, topic, CAST(depth AS BIGINT) AS depth
    FROM best WHERE rk = 1""",
)
def q_frontier_d1(spark, sf):
    pages = read_pages(spark, sf)
    seeds = pages.select(H.page_topic(F.col("html")).alias("topic"), "url")
    return H.collect(seeds, pages, prefix="url").select("doc_id", "url", "url_hash", "topic", "depth")


# T9 --------------------------------------------------------------------------------
# Written out, not taken from the code: the walk over the tags is a recursion, the neighbour rules are windows.
_HEADS = "['h1','h2','h3','h4','h5','h6']"
_ENDS = ("['body','blockquote','caption','center','col','colgroup','dd','div','dl','dt','fieldset','form','legend','optgroup','option','p','pre',"
         "'table','td','textarea','tfoot','th','thead','tr','ul','li','h1','h2','h3','h4','h5','h6']")
_HOLDS = "['html','article','section','nav','header','footer','aside','main','ol','tbody']"
_SIBLINGS = "['li','dd','dt','td','th','tr','option','h1','h2','h3','h4','h5','h6']"


def _below_sql(tag: str) -> str:
    """The open tags below the last one of this name."""
    return f"open[1 : len(open) - list_position(list_reverse(open), {tag})]"


def _plain_sql(t: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&amp;", "&")):
        t = f"replace({t}, '{name}', '{char}')"
    t = f"regexp_replace({t}, '[ \\t\\r\\n\\f\\x0B\\x{{A0}}]*[\\r\\n][ \\t\\r\\n\\f\\x0B\\x{{A0}}]*', chr(10), 'g')"
    return f"regexp_replace({t}, '[ \\t\\f\\x0B\\x{{A0}}]+', ' ', 'g')"


def _good_before(cls: str, order: str) -> str:
    """Class of the nearest good or bad paragraph on one side, B at the page's edge."""
    return (f"coalesce(last_value(CASE WHEN {cls} IN ('G', 'B') THEN {cls} END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY block {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'B')")


def _any_before(cls: str, order: str) -> str:
    return (f"coalesce(last_value(CASE WHEN {cls} <> 'S' THEN {cls} END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY block {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'B')")


def _good_near(cls: str) -> str:
    """A good paragraph begins at most 200 characters below this one."""
    return (f"coalesce(min(CASE WHEN {cls} = 'G' THEN upto END) OVER (PARTITION BY page_id ORDER BY block ROWS BETWEEN 1 FOLLOWING AND "
            f"UNBOUNDED FOLLOWING) - (upto + length) <= 200, false)")


PARAGRAPHS_SQL = f"""WITH RECURSIVE src AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
        '(?s)<!--.*?-->|<[!?][^>]*>', '', 'g'), '(?is)<script\\b[^>]*>.*?</script\\s*>', '', 'g'),
        '(?is)<style\\b[^>]*>.*?</style\\s*>', '', 'g'), '(?is)<head\\b[^>]*>.*?</head\\s*>', '', 'g') AS body FROM pages),
    parts AS (SELECT page_id, regexp_extract_all(body, '(</?[a-zA-Z][^>]*>|[^<]+|<)', 1) AS ts FROM src),
    tok AS (SELECT page_id, unnest(ts) AS t, generate_subscripts(ts, 1) AS k FROM parts),
    named AS (SELECT *, lower(regexp_extract(t, '^<(/?[a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM tok),
    kinds AS (SELECT page_id, k, t, CASE WHEN tag <> '' THEN tag WHEN regexp_full_match(t, '([ \\t\\r\\n\\f\\x0B\\x{{A0}}]|&nbsp;)*')
              THEN '' ELSE '#' END AS kind FROM named),
    walk AS (
        SELECT page_id, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS open, false AS br, '' AS kind, '' AS t, false AS ends,
               false AS link, false AS head, false AS menu FROM pages
        UNION ALL
        SELECT w.page_id, n.k,
            CASE WHEN starts_with(n.kind, '/') THEN CASE WHEN list_contains(open, n.kind[2:]) THEN {_below_sql('n.kind[2:]')} ELSE open END
                 WHEN n.kind = 'a' THEN list_append(CASE WHEN list_contains(open, 'a') THEN {_below_sql("'a'")} ELSE open END, 'a')
                 WHEN n.kind = 'select' THEN list_append(open, 'select')
                 WHEN list_contains({_ENDS}, n.kind) OR list_contains({_HOLDS}, n.kind) THEN list_concat(
                     CASE WHEN list_contains(open, 'p') THEN {_below_sql("'p'")}
                          WHEN list_contains({_SIBLINGS}, n.kind) AND coalesce(open[-1] = n.kind, false) THEN open[:-2] ELSE open END,
                     CASE WHEN n.kind = 'col' THEN CAST([] AS VARCHAR[]) ELSE [n.kind] END)
                 ELSE open END,
            CASE WHEN starts_with(n.kind, '/') OR n.kind = '' THEN br ELSE n.kind = 'br' END, n.kind, n.t,
            list_contains({_ENDS}, ltrim(n.kind, '/')) OR (n.kind = 'br' AND br),
            list_contains(open, 'a'), list_has_any(open, {_HEADS}), list_contains(open, 'select')
        FROM walk w JOIN kinds n ON n.page_id = w.page_id AND n.k = w.k + 1),
    cut AS (SELECT *, sum(CASE WHEN ends THEN 1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY k) AS p FROM walk),
    texts AS (SELECT page_id, p, string_agg(t, '' ORDER BY k) AS raw, sum(CASE WHEN link THEN length({_plain_sql('t')}) ELSE 0 END) AS link_chars,
              bool_or(head) AS heading, bool_or(menu) AS menu FROM cut WHERE kind = '#' GROUP BY page_id, p),
    trimmed AS (SELECT *, trim({_plain_sql('raw')}, ' ' || chr(10)) AS text FROM texts),
    par AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY p) - 1 AS block, text, length(text) AS length, link_chars,
            heading, menu, list_filter(regexp_split_to_array(text, '[ \\n]'), lambda w: w <> '') AS words FROM trimmed WHERE text <> ''),
    counted AS (SELECT *, len(words) AS n_words, len(list_filter(words, lambda w: lower(w) IN {S.STOP_LIST})) AS n_stop FROM par),
    free AS (SELECT *, CASE WHEN link_chars / length > 0.2 OR contains(text, '©') OR contains(text, '&copy') OR menu THEN 'B'
                WHEN length < 70 THEN CASE WHEN link_chars > 0 THEN 'B' ELSE 'S' END
                WHEN n_stop / n_words >= 0.32 THEN CASE WHEN length > 200 THEN 'G' ELSE 'N' END
                WHEN n_stop / n_words >= 0.3 THEN 'N' ELSE 'B' END AS c0,
             sum(length) OVER (PARTITION BY page_id ORDER BY block) - length AS upto FROM counted),
    s1 AS (SELECT *, CASE WHEN heading AND c0 = 'S' AND {_good_near('c0')} THEN 'N' ELSE c0 END AS c1 FROM free),
    sides AS (SELECT *, {_good_before('c1', 'ASC')} AS l, {_good_before('c1', 'DESC')} AS r, {_any_before('c1', 'ASC')} AS la,
              {_any_before('c1', 'DESC')} AS ra FROM s1),
    s2 AS (SELECT *, CASE WHEN c1 <> 'S' THEN c1 WHEN l = 'G' AND r = 'G' THEN 'G' WHEN l = 'B' AND r = 'B' THEN 'B'
              WHEN (l = 'B' AND la = 'N') OR (r = 'B' AND ra = 'N') THEN 'G' ELSE 'B' END AS c2 FROM sides),
    s3 AS (SELECT *, CASE WHEN c2 = 'N' THEN CASE WHEN {_good_before('c2', 'ASC')} = 'B' AND {_good_before('c2', 'DESC')} = 'B'
              THEN 'B' ELSE 'G' END ELSE c2 END AS c3 FROM s2),
    s4 AS (SELECT *, CASE WHEN heading AND c3 = 'B' AND c0 <> 'B' AND {_good_near('c3')} THEN 'G' ELSE c3 END AS c4 FROM s3)"""


@register(
    "good_blocks",
    PARAGRAPHS_SQL + """ SELECT page_id, block, md5(text) AS text_md5, CAST(length AS BIGINT) AS length, round(link_chars / length, 6) AS link_density,
    CAST(n_words AS BIGINT) AS n_words, CAST(n_stop AS BIGINT) AS n_stop, heading,
    CASE c0 WHEN 'G' THEN 'good' WHEN 'N' THEN 'neargood' WHEN 'S' THEN 'short' ELSE 'bad' END AS cf_class,
    CASE c4 WHEN 'G' THEN 'good' ELSE 'bad' END AS class FROM s4""",
)
def q_good_blocks(spark, sf):
    b = PG.classified_blocks(read_pages(spark, sf))
    return b.select("page_id", "block", F.md5("text").alias("text_md5"), "length", F.round("link_density", 6).alias("link_density"),
                    "n_words", "n_stop", "heading", "cf_class", "class")


# T10 -------------------------------------------------------------------------------
@register(
    "page_record",
    PARAGRAPHS_SQL + f""", content AS (SELECT page_id, string_agg(text, chr(10) ORDER BY block) AS content FROM s4 WHERE c4 = 'G' GROUP BY page_id),
    lk AS (SELECT page_id, url, regexp_extract(html, '<meta[^>]*property=["'']article:published_time["''][^>]*content=["'']([^"'']*)["'']', 1) AS pub,
           list_transform({S.page_links('html')}, lambda h: {S.resolve_link('h', 'url')}) AS l FROM pages)
    SELECT page_id, url, coalesce(content, '') AS content, CAST(len(l) AS BIGINT) AS n_links, array_to_string(l, ' ') AS links,
           CASE WHEN pub <> '' THEN strftime(CAST(pub AS TIMESTAMPTZ), '%Y-%m-%d %H:%M:%S') END AS published_at
    FROM lk LEFT JOIN content USING (page_id)""",
)
def q_page_record(spark, sf):
    r = H.extract_page(read_pages(spark, sf))
    return r.select("page_id", "url", "content", F.size("links").cast("bigint").alias("n_links"), F.array_join("links", " ").alias("links"),
                    F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"))


# X4 --------------------------------------------------------------------------------
@register(
    "vec_tokens",
    f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, "
    f"regexp_extract_all(lower(text), {S.q('(' + X.VEC_TOKEN + ')')}, 1) AS t FROM documents)",
)
def q_vec_tokens(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", X.vec_tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


# X5 --------------------------------------------------------------------------------
@register(
    "strip_accents",
    "SELECT doc_id, md5(strip_accents(text)) AS text_md5, CAST(length(strip_accents(text)) AS BIGINT) AS n_chars "
    "FROM documents",
)
def q_strip_accents(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", X.strip_accents("text").alias("t"))
    return t.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("n_chars"))


# X7 --------------------------------------------------------------------------------
def _clean_news_sql(t: str) -> str:
    s = f"regexp_replace({t}, '(?m)^(From|Reply-To|Path|Organization):[^\\n]*', '', 'g')"
    s = f"regexp_replace({s}, '[\\n\\t]|[ \\t\\r\\n\\f\\x0B]{{2,}}', ' ', 'g')"
    s = f"regexp_replace({s}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{2,4}}', '', 'g')"
    s = f"regexp_replace({s}, '[^a-zA-Z0-9 \\t\\r\\n\\f\\x0B]', '', 'g')"
    return f"lower({s})"


@register(
    "clean_news",
    f"SELECT doc_id, md5(c) AS text_md5, CAST(length(c) AS BIGINT) AS n_chars FROM (SELECT doc_id, "
    f"{_clean_news_sql('text')} AS c FROM documents)",
)
def q_clean_news(spark, sf):
    t = table(spark, sf, "documents").select("doc_id", X.clean_news("text").alias("c"))
    return t.select("doc_id", F.md5("c").alias("text_md5"), F.length("c").cast("bigint").alias("n_chars"))
