"""Paragraphs of stored pages and their boilerplate classes.

A page stays one row until its paragraphs are classified: its tags and texts become an array, a fold with the stack
of open tags marks where paragraphs end and which texts lie in links or headings, and the neighbour rules are folds
over the array of paragraphs. Nothing shuffles, and no text is carried by a window.
"""
from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.operators.text import STOP_WORDS_EN

# Boilerplate thresholds of the paragraph classifier (Pomikalek 2011).
LENGTH_LOW = 70
LENGTH_HIGH = 200
STOPWORDS_LOW = 0.30
STOPWORDS_HIGH = 0.32
MAX_LINK_DENSITY = 0.2
MAX_HEADING_DISTANCE = 200
# Tags that begin and end a paragraph.
PARAGRAPH_TAGS = ("body blockquote caption center col colgroup dd div dl dt fieldset form legend optgroup option p pre table td "
                  "textarea tfoot th thead tr ul li h1 h2 h3 h4 h5 h6").split()
# Other tags whose end closes what is open within them.
HOLDING_TAGS = "html article section nav header footer aside main ol tbody".split()
# Tags without an end, and tags that a neighbour of the same name closes.
VOID_TAGS = ["col"]
SIBLING_TAGS = "li dd dt td th tr option h1 h2 h3 h4 h5 h6".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
SPACE = r"[ \t\r\n\f\x0B\x{A0}]"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&amp;", "&"))
#: Items a fold takes before it adds its characters to the page's: a page of n items copies n * n / CHUNK characters.
CHUNK = 512
_FAR = 1 << 30


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is read."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sweep(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """One character for each item of an array: ``step(state, item)`` gives the next state and the character."""

    def one(acc, x):
        state, char = step(acc["state"], x)
        return F.struct(state.alias("state"), F.concat(acc["out"], char).alias("out"))

    def run(it):
        def chunk(acc, c):
            start = F.struct(acc["state"].alias("state"), F.lit("").alias("out"))
            return F.aggregate(F.slice(it, c * CHUNK + 1, CHUNK), start, one, lambda r: F.struct(
                r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))

        whole = F.struct(zero.alias("state"), F.lit("").alias("out"))
        chunks = F.sequence(F.lit(0), F.floor(F.size(it) / CHUNK).cast("int"))
        text = F.aggregate(chunks, whole, chunk, lambda r: r["out"])
        return F.when(F.size(it) == 0, F.array().cast("array<string>")).otherwise(F.split(text, ""))

    return _let(items, run)


# --------------------------------------------------------------------------- paragraphs
def _cut(stack: Column, tag: Column) -> Column:
    """The stack below the last open ``tag`` (which is on it)."""
    return F.slice(stack, 1, F.size(stack) - F.array_position(F.reverse(stack), tag).cast("int"))


def _tag_step(state: Column, kind: Column) -> tuple[Column, Column]:
    """One tag or text: ``kind`` is ``p``, ``/p``, ``#`` for text and empty for blanks."""
    stack, again = state["open"], state["br"]
    ends = kind.startswith("/")
    name = F.when(ends, F.substring(kind, 2, 20)).otherwise(kind)
    block = kind.isin(*PARAGRAPH_TAGS, *HOLDING_TAGS)
    held = block & ~kind.isin(*VOID_TAGS) | kind.isin("a", "select")
    p, a = F.lit("p"), F.lit("a")
    below = (F.when(block & F.array_contains(stack, p), _cut(stack, p))
             .when((kind == "a") & F.array_contains(stack, a), _cut(stack, a))
             .when(kind.isin(*SIBLING_TAGS) & (F.try_element_at(stack, F.lit(-1)) == kind), _cut(stack, kind))
             .otherwise(stack))
    after = (F.when(held, F.concat(below, F.array(kind)))
             .when(ends & F.array_contains(stack, name), _cut(stack, name)).otherwise(stack))
    br = F.when(ends | (kind == ""), again).otherwise(kind == "br")

    def inside(*tags):
        return F.arrays_overlap(stack, F.array(*[F.lit(t) for t in tags]))

    flags = F.when(inside("a"), 1).otherwise(0) + F.when(inside(*HEADINGS), 2).otherwise(0) + F.when(inside("select"), 4).otherwise(0)
    code = (F.when(kind == "#", flags.cast("string")).when(name.isin(*PARAGRAPH_TAGS) | ((kind == "br") & again), "B").otherwise(" "))
    return F.struct(after.alias("open"), br.alias("br")), code


def _one_space(c: Column) -> Column:
    """Each run of white space as one line feed if it holds a line end, else as one space."""
    lines = F.regexp_replace(c, rf"{SPACE}*[\r\n]{SPACE}*", "\n")
    return F.regexp_replace(lines, r"[ \t\f\x0B\x{A0}]+", " ")


def page_paragraphs(html: Column, stops=STOP_WORDS_EN) -> Column:
    """Array of a page's paragraphs (text, length, link_chars, n_words, n_stop, heading, cf): cf is the class without
    context, G(ood), N(ear good), S(hort) or B(ad). Comments, scripts, styles and the head count as nothing; blank
    texts are left out; two line breaks in a row end a paragraph as a paragraph tag does."""
    body = F.translate(html, "\u0001\u0002\u0003\u0004\u0005", "     ")
    for rx in (r"(?s)<!--.*?-->|<[!?][^>]*>", r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>",
               r"(?is)<head\b[^>]*>.*?</head\s*>"):
        body = F.regexp_replace(body, rx, "")
    tokens = F.regexp_extract_all(body, F.lit(r"(</?[a-zA-Z][^>]*>|[^<]+|<)"), 1)

    def kind(t):
        tag = F.lower(F.regexp_extract(t, r"^<(/?[a-zA-Z][a-zA-Z0-9]*)", 1))
        return F.when(tag != "", tag).when(t.rlike(rf"^({SPACE}|&nbsp;)*$"), "").otherwise("#")

    def plain(t):
        for name, char in ENTITIES:
            t = F.replace(t, F.lit(name), F.lit(char))
        return t

    def piece(t, code):
        marked = F.when(code.isin("1", "3", "5", "7"), F.concat(F.lit("\u0002"), t, F.lit("\u0003"))).otherwise(t)
        signs = F.concat(F.when(code.isin("2", "3", "6", "7"), "\u0004").otherwise(""), F.when(code.isin("4", "5", "6", "7"), "\u0005").otherwise(""))
        return F.when(code == "B", "\u0001").when(code == " ", "").otherwise(F.concat(signs, marked))

    def joined(ts):
        zero = F.struct(F.array().cast("array<string>").alias("open"), F.lit(False).alias("br"))
        return _one_space(plain(F.array_join(F.zip_with(ts, _sweep(F.transform(ts, kind), zero, _tag_step), piece), "")))

    def paragraph(p):
        text = _one_space(F.regexp_replace(p, "[\u0002-\u0005]", ""))
        return F.struct(F.trim(text, F.lit(" \n")).alias("text"),
                        F.length(F.array_join(F.regexp_extract_all(p, F.lit("\u0002([^\u0003]*)\u0003"), 1), "")).alias("link_chars"),
                        F.contains(p, F.lit("\u0004")).alias("heading"), F.contains(p, F.lit("\u0005")).alias("menu"))

    def measured(p):
        words = F.filter(F.split(p["text"], "[ \n]"), lambda w: w != "")
        return F.struct(p["text"].alias("text"), F.length(p["text"]).alias("length"), p["link_chars"].alias("link_chars"), F.size(words).alias("n_words"),
                        F.size(F.filter(words, lambda w: F.lower(w).isin(*stops))).alias("n_stop"), p["heading"].alias("heading"), p["menu"].alias("menu"))

    def classed(p):
        share = p["n_stop"] / p["n_words"]
        cf = (F.when(p["link_chars"] / p["length"] > MAX_LINK_DENSITY, "B")
              .when(F.contains(p["text"], F.lit("©")) | F.contains(p["text"], F.lit("&copy")) | p["menu"], "B")
              .when(p["length"] < LENGTH_LOW, F.when(p["link_chars"] > 0, "B").otherwise("S"))
              .when(share >= STOPWORDS_HIGH, F.when(p["length"] > LENGTH_HIGH, "G").otherwise("N"))
              .when(share >= STOPWORDS_LOW, "N").otherwise("B"))
        return F.struct(*[p[f].alias(f) for f in ("text", "length", "link_chars", "n_words", "n_stop", "heading")], cf.alias("cf"))

    parts = F.filter(F.transform(F.split(_let(tokens, joined), "\u0001"), paragraph), lambda p: p["text"] != "")
    return F.transform(F.transform(parts, measured), classed)


# --------------------------------------------------------------------------- neighbours
def _headings(paras: Column, classes: Column, promote: Callable[[Column, Column], Column], to: str) -> Column:
    """Headings with a good paragraph at most MAX_HEADING_DISTANCE characters below become ``to``."""
    items = F.reverse(F.zip_with(paras, classes, lambda p, c: F.struct(
        c.alias("c"), p["length"].alias("length"), (p["heading"] & promote(p, c)).alias("may"))))

    def step(gap, x):
        nxt = F.when(x["c"] == "G", 0).otherwise(F.least(gap + x["length"], F.lit(_FAR)))
        return nxt, F.when(x["may"] & (gap <= MAX_HEADING_DISTANCE), to).otherwise(x["c"])

    return F.reverse(_sweep(items, F.lit(_FAR), step))


def _before(classes: Column) -> Column:
    """For each place what lies before it: G or B by the last good or bad one, b if a near-good one follows that bad one."""

    def step(last, c):
        return F.when(c.isin("G", "B"), c).when((c == "N") & (last == "B"), "b").otherwise(last), last

    return _sweep(classes, F.lit("B"), step)


def _with_sides(classes: Column, use: Callable[[Column, Column, Column], Column]) -> Column:
    sides = F.arrays_zip(classes.alias("c"), _before(classes).alias("l"), F.reverse(_before(F.reverse(classes))).alias("r"))
    return F.transform(sides, lambda s: use(s["c"], s["l"], s["r"]))


def revise(paras: Column) -> Column:
    """Final classes (G or B) of an array of paragraphs. Short headings above a good paragraph become near good; short
    paragraphs follow their good or bad neighbours, and between a good and a bad one they are good if a near-good one stands on the
    bad side; near-good ones are bad only between bad ones; at last headings above a good paragraph come back. Page edges are bad."""

    def short(c, left, right):
        both_good = (left == "G") & (right == "G")
        mixed = (left == "G") != (right == "G")
        return F.when(c != "S", c).when(both_good | (mixed & ((left == "b") | (right == "b"))), "G").otherwise("B")

    def near(c, left, right):
        return F.when(c != "N", c).when((left == "G") | (right == "G"), "G").otherwise("B")

    def classes(ps):
        first = _headings(ps, F.transform(ps, lambda p: p["cf"]), lambda p, c: c == "S", "N")
        return _let(first, lambda c1: _let(_with_sides(c1, short), lambda c2: _let(
            _with_sides(c2, near), lambda c3: _headings(ps, c3, lambda p, c: (c == "B") & (p["cf"] != "B"), "G"))))

    return _let(paras, classes)


NAMES = {"G": "good", "N": "neargood", "S": "short", "B": "bad"}


def _name(c: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv]), c)


def _revised(pages: DataFrame, cols: list, html: str, stops) -> DataFrame:
    """``cols`` of each page and an array ``ps`` of (p: paragraph, c: its final class)."""
    both = _let(page_paragraphs(F.coalesce(F.col(html), F.lit("")), stops), lambda ps: F.zip_with(
        ps, revise(ps), lambda p, c: F.struct(p.alias("p"), c.alias("c"))))
    return pages.select(*cols, both.alias("ps"))


def classified_blocks(pages: DataFrame, key: str = "page_id", html: str = "html", stops=STOP_WORDS_EN) -> DataFrame:
    """One row a paragraph: key, block (from 0), text, length, link_density, n_words, n_stop, heading, cf_class
    (without context) and class (good or bad). A page without text, or a null one, has no row."""
    rows = _revised(pages, [F.col(key)], html, stops).select(key, F.posexplode_outer("ps").alias("block", "x")).filter(F.col("x").isNotNull())
    p = F.col("x.p")
    return rows.select(key, F.col("block").cast("bigint").alias("block"), p["text"].alias("text"), p["length"].cast("bigint").alias("length"),
                       (p["link_chars"] / p["length"]).alias("link_density"), p["n_words"].cast("bigint").alias("n_words"),
                       p["n_stop"].cast("bigint").alias("n_stop"), p["heading"].alias("heading"),
                       _name(p["cf"]).alias("cf_class"), _name(F.col("x.c")).alias("class"))


def good_text(pages: DataFrame, cols: list, html: str = "html", stops=STOP_WORDS_EN) -> DataFrame:
    """``cols`` of each page and ``content``: its good paragraphs, one a line. A row of the input is a row of the result."""
    good = F.transform(F.filter("ps", lambda x: x["c"] == "G"), lambda x: x["p"]["text"])
    kept = [f"__k{i}" for i in range(len(cols))]
    r = _revised(pages, [c.alias(k) for c, k in zip(cols, kept)], html, stops)
    return r.select(*kept, F.array_join(good, "\n").alias("content"))
