"""Stored-page jobs: main-content span, links, page collection and page records
(T7, T8, T10, T13, X8, X9, X16, X20, P8, J6, W4, O8); boilerplate classes are in ``paragraphs``.

Pages are independent rows, so everything per page is a row expression (regex,
higher-order array functions) or a window partitioned by page; nothing shuffles
except the joins of the collection job.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators.ordered import dense_id
from corpusmill.operators.paragraphs import good_text


#: Rows of a batch that leaves ``surface_row_max``.
ROWS_OUT = 1 << 16


def _fold_span(bits: Column) -> Column:
    """W4/O8 as one pass over the bit string: running S(k) = zeros - ones over the
    first k characters, running arg-min of S over earlier positions (smallest index
    on ties) and the best S(j) - min S(i) for 1 <= j <= n-1 (first j on ties)."""
    chars = F.split(bits, "")
    zero = F.struct(
        F.lit(0).alias("k"), F.lit(0).alias("s"), F.lit(1 << 30).alias("mins"), F.lit(-1).alias("argmin"),
        F.lit(-(1 << 30)).alias("best"), F.lit(0).alias("bi"), F.lit(1).alias("bj"),
        F.lit(0).alias("bsi"), F.lit(0).alias("bsj"),
    )

    def step(acc, c):
        cand = acc["s"] - acc["mins"]
        take = (acc["k"] >= 1) & (cand > acc["best"])
        new_min = acc["s"] < acc["mins"]
        return F.struct(
            (acc["k"] + 1).alias("k"),
            (acc["s"] + F.when(c == "0", 1).otherwise(-1)).alias("s"),
            F.when(new_min, acc["s"]).otherwise(acc["mins"]).alias("mins"),
            F.when(new_min, acc["k"]).otherwise(acc["argmin"]).alias("argmin"),
            F.when(take, cand).otherwise(acc["best"]).alias("best"),
            F.when(take, acc["argmin"]).otherwise(acc["bi"]).alias("bi"),
            F.when(take, acc["k"]).otherwise(acc["bj"]).alias("bj"),
            F.when(take, acc["mins"]).otherwise(acc["bsi"]).alias("bsi"),
            F.when(take, acc["s"]).otherwise(acc["bsj"]).alias("bsj"),
        )

    return F.aggregate(chars, zero, step)


def main_content(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Main-content span of each page.

    f(i, j) = tags before i + words in [i, j) + tags after j, maximised over
    0 <= i < j <= n-1 (Q9 bound; first i, then first j on ties); pages with fewer
    than two marks report f(0, 1). Output: key, n, i, j, f, start, len, content
    (the words of the span, from the same token stream as the bits).
    """
    b = pages.select(key, X.page_bits(html).alias("bits"), X.page_words(html).alias("words"))
    n = F.length("bits")
    ones = n - F.length(F.regexp_replace("bits", "1", ""))
    one_char = F.when(F.substring("bits", 1, 1) == "0", 1).otherwise(-1)
    short = n < 2

    def span(acc: Column) -> Column:
        """All fields of one fold; read within one lambda, or the optimiser repeats the fold for each."""
        i = F.when(short, F.lit(0)).otherwise(acc["bi"])
        j = F.when(short, F.lit(1)).otherwise(acc["bj"])
        si = F.when(short, F.lit(0)).otherwise(acc["bsi"])
        sj = F.when(short, F.when(n == 1, one_char).otherwise(0)).otherwise(acc["bsj"])
        return F.struct(i.alias("i"), j.alias("j"), (ones + sj - si).alias("f"), ((i + si) / 2).cast("int").alias("start"),
                        (((j + sj) - (i + si)) / 2).cast("int").alias("len"))

    spans = F.transform(F.array(_fold_span(F.col("bits"))), span)
    out = b.select(key, "words", n.alias("n"), F.inline_outer(spans))
    content = F.array_join(F.slice("words", F.col("start") + 1, F.greatest(F.col("len"), F.lit(0))), " ")
    return out.select(
        key, F.col("n").cast("bigint").alias("n"), F.col("i").cast("bigint").alias("i"),
        F.col("j").cast("bigint").alias("j"), F.col("f").cast("bigint").alias("f"),
        F.col("start").cast("bigint").alias("start"), F.col("len").cast("bigint").alias("len"),
        F.when(F.col("len") > 0, content).otherwise(F.lit("")).alias("content"),
    )


def surface_row_max(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """T13 (re-aimed): instead of all n^2 points of f(i, j), the best j for every
    i: max over j > i of f(i, j) = T + max_{j>i} S(j) - S(i), a suffix maximum per
    page. Output: key, i, f_max (i in 0 .. n-2)."""
    # one short row a page: its bits; rows that repeat a key count as one sequence, in the order of their places
    b = pages.select(key, X.page_bits(html).alias("bits")).filter(F.col("bits").isNotNull())
    b = b.groupBy(key).agg(F.collect_list("bits").alias("all"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, own in enumerate(batch.column("all").to_pylist()):
                bits = [np.frombuffer(x.encode("utf-32-le"), np.uint32) for x in own]
                k, n, ones = (np.concatenate(c) for c in zip(*((np.arange(len(x)), np.full(len(x), len(x)), np.full(len(x), (x == ord("1")).sum())) for x in bits)))
                order = np.argsort(k, kind="stable")
                k, n, ones, step = k[order], n[order], ones[order], np.where(np.concatenate(bits)[order] == ord("0"), 1, -1)
                before = np.cumsum(step) - step
                down = np.argsort(-k, kind="stable")
                best = np.zeros_like(before)
                best[down[1:]] = np.maximum.accumulate(before[down])[:-1]  # of all rows that come first from the page's end
                at = np.flatnonzero(k <= n - 2)  # never the last place
                for a in range(0, len(at), ROWS_OUT):
                    cut = at[a:a + ROWS_OUT]
                    name = batch.column(key).take(pa.array(np.full(len(cut), r)))
                    yield pa.RecordBatch.from_arrays([name, pa.array(k[cut]), pa.array(ones[cut] + best[cut] - before[cut])], names=[key, "i", "f_max"])

    kind = b.schema[key].dataType.simpleString()
    return b.mapInArrow(run, f"`{key}` {kind}, i bigint, f_max bigint")


def links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, url, link) one row per href, resolved against the page URL."""
    hrefs = pages.select(key, "url", F.explode_outer(X.page_links("html")).alias("href"))
    return hrefs.filter(F.col("href").isNotNull()).select(
        key, "url", X.resolve_link(F.col("href"), F.col("url")).alias("link"))


def prefix_links(pages: DataFrame, key: str = "page_id", prefix: str = "url") -> DataFrame:
    """Resolved links that start with the page's own URL (``prefix='url'``)
    or with its origin (``prefix='origin'``)."""
    lk = links(pages, key)
    pre = F.col("url") if prefix == "url" else X.url_origin(F.col("url"))
    return lk.filter(F.col("link").startswith(pre))


def page_topic(html: Column) -> Column:
    """Topic of a stored page: its ``<html lang>`` attribute."""
    return F.regexp_extract(html, r"<html[^>]*\slang=[\"']([^\"']*)[\"']", 1)


def collect(seeds: DataFrame, pages: DataFrame, prefix: str = "url") -> DataFrame:
    """Seeds (topic, url) -> their stored pages -> same-prefix links ->
    depth-1 stored pages (topic inherited) -> one row per URL hash (lowest depth,
    then smallest topic) with a dense doc id by URL.
    Output: doc_id, url, url_hash, topic, depth."""
    store = pages.select("url", "html")
    seed_pages = seeds.select("topic", "url").join(store, "url")
    lk = prefix_links(seed_pages.withColumn("seed", F.col("url")), key="seed", prefix=prefix).join(
        seeds.select(F.col("url").alias("seed"), "topic"), "seed")
    fetched = lk.select("topic", F.col("link").alias("url")).join(store.select("url"), "url")
    found = seed_pages.select("url", "topic", F.lit(0).alias("depth")).unionByName(
        fetched.select("url", "topic", F.lit(1).alias("depth")))
    best = found.withColumn("url_hash", X.url_hash("url")).groupBy("url_hash").agg(
        F.min(F.struct("depth", "topic", "url")).alias("b"))
    flat = best.select("url_hash", F.col("b.url").alias("url"), F.col("b.topic").alias("topic"),
                       F.col("b.depth").cast("bigint").alias("depth"))
    return dense_id(flat, ["url"], out="doc_id")


def published(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Published timestamp per page (null when the meta tag is absent)."""
    return pages.select(key, X.published_at("html").alias("published_at"))


# --------------------------------------------------------------------------- T10
def extract_page(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Page record: main text (good paragraphs, one a line), links and published time; a row expression of each page."""
    cols = [F.col(key), F.col("url"), X.page_links("html"), X.published_at("html")]
    r = good_text(pages, cols).toDF(key, "url", "hrefs", "published_at", "content")
    return r.select(key, "url", "content", F.transform("hrefs", lambda h: X.resolve_link(h, F.col("url"))).alias("links"), "published_at")


# --------------------------------------------------------------------------- T11
def _strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", ""), r"[ \t\r\n]+", " "))


def _first(html: Column, pattern: str) -> Column:
    v = _strip_tags(F.regexp_extract(html, pattern, 1))
    return F.when(v == "", None).otherwise(v)


def _all(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), 1)


def extract_profiles(pages: DataFrame, key: str = "url", html: str = "html") -> DataFrame:
    """T11 (Q11 corrected): researcher profile pages -> one nested record each:
    name, caption, institution, keywords (comma joined), image URL, citation /
    h-index / i10-index counts (all, since2018), coauthors and papers."""
    h = F.col(html)
    cells = _all(F.regexp_extract(h, r'(?s)id="gsc_rsb_st"(.*?)</table>', 1), r"(?s)<td[^>]*>(.*?)</td>")

    def pair(i):
        return F.struct(_strip_tags(F.get(cells, i)).alias("all"), _strip_tags(F.get(cells, i + 1)).alias("since2018"))

    kw_block = F.regexp_extract(h, r'(?s)id="gsc_prf_int"(.*?)</div>', 1)
    keywords = F.array_join(F.transform(F.regexp_extract_all(kw_block, F.lit(r'(?s)class="gs_ibl"[^>]*>(.*?)</a>'), 1),
                                        _strip_tags), ",")
    img_tag = F.regexp_extract(h, r'<img[^>]*id="gsc_prf_pup-img"[^>]*>', 0)
    co_blocks = _all(h, r'(?s)class="gsc_rsb_a_desc"(.*?)</li>')
    coauthors = F.transform(co_blocks, lambda b: F.struct(
        _strip_tags(F.regexp_extract(b, r"(?s)<a[^>]*>(.*?)</a>", 1)).alias("coauthor_name"),
        _strip_tags(F.regexp_extract(b, r'(?s)class="gsc_rsb_a_ext"[^>]*>(.*?)</span>', 1)).alias("coauthor_title"),
        F.regexp_extract(b, r'href="([^"]*)"', 1).alias("coauthor_link")))
    rows = _all(F.regexp_extract(h, r'(?s)id="gsc_a_b"(.*?)</tbody>', 1), r"(?s)<tr[^>]*>(.*?)</tr>")

    def paper(r):
        cell = F.regexp_extract(r, r'(?s)class="gsc_a_t"[^>]*>(.*?)</td>', 1)
        divs = F.regexp_extract_all(cell, F.lit(r"(?s)<div[^>]*>(.*?)</div>"), 1)
        return F.struct(
            _strip_tags(F.regexp_extract(r, r'(?s)class="gsc_a_at"[^>]*>(.*?)</a>', 1)).alias("paper_title"),
            _strip_tags(F.get(divs, 0)).alias("paper_authors"), _strip_tags(F.get(divs, 1)).alias("paper_journal"),
            _strip_tags(F.regexp_extract(r, r'(?s)class="gsc_a_c"[^>]*>.*?<a[^>]*>(.*?)</a>', 1)).alias(
                "paper_citedby"),
            _strip_tags(F.regexp_extract(r, r'(?s)class="gsc_a_y"[^>]*>.*?<span[^>]*>(.*?)</span>', 1)).alias(
                "paper_year"))

    return pages.select(
        key,
        _first(h, r'(?s)id="gsc_prf_in"[^>]*>(.*?)</div>').alias("researcher_name"),
        _first(h, r'(?s)class="gsc_prf_il"[^>]*>(.*?)</div>').alias("researcher_caption"),
        _first(h, r'(?s)class="gsc_prf_ila"[^>]*>(.*?)</a>').alias("researcher_institution"),
        keywords.alias("researcher_keywords"),
        F.regexp_extract(img_tag, r'src="([^"]*)"', 1).alias("researcher_imgURL"),
        pair(1).alias("researcher_citations"), pair(4).alias("researcher_hindex"),
        pair(7).alias("researcher_i10index"),
        coauthors.alias("researcher_coauthors"), F.transform(rows, paper).alias("researcher_papers"))
