"""Scalar text functions (X1-X12, X16, X20) as Spark column expressions.

Everything here builds a ``Column`` from built-in expressions so it stays inside
whole-stage codegen; no Python runs per row.
"""
from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------
# The 32 ASCII punctuation characters, as one character class: ! " # $ % & ' ( ) * + , - . /
# : ; < = > ? @ [ \ ] ^ _ ` { | } ~
ASCII_PUNCT_CLASS = r"[!-/:-@\[-`{-~]"
# Whitespace used by the tokenizers (written out: Java and RE2 disagree on \s).
WHITESPACE_RUN = r"[ \t\r\n]+"
# Word tokenizer contractions that are split in two after punctuation removal;
# each splits after its third letter: can|not gim|me gon|na got|ta lem|me wan|na.
CONTRACTIONS = ("cannot", "gimme", "gonna", "gotta", "lemme", "wanna")
# Soundex letter groups and their digits; vowels and H, W, Y are dropped.
SOUNDEX_LETTERS = "BFPVCGJKQSXZDTLMNR"
SOUNDEX_DIGITS = "111122222222334556"
# Vectoriser token: a run of two or more word characters (letters, numbers, underscore).
VEC_TOKEN = r"[\p{L}\p{N}_]{2,}"
# Word characters that are not digits (letters, underscore, non-decimal numbers).
PAGE_WORD = r"[\p{L}\p{Nl}\p{No}_]+"
# Anchor tags that carry an href attribute of that very name (double or single quoted, or bare).
HREF = r"""<a(?:\s[^>]*?)?\shref\s*=\s*["']?([^"'\s>]*)"""
# Published-time meta tag.
PUBLISHED_META = r"""<meta[^>]*property=["']article:published_time["'][^>]*content=["']([^"']*)["']"""
# Accented Latin letters and their ASCII base letters (for strip_accents), by canonical decomposition
# of the Latin blocks; letters without one, such as o with stroke, have their base letter named here.
_STROKED = dict(zip("øØłŁđĐħĦŧŦ", "oOlLdDhHtT"))
_BASE = {c: unicodedata.normalize("NFD", c)[0] for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)])}
_BASE = {c: b for c, b in (_BASE | _STROKED).items() if c != b and b.isascii() and b.isalpha()}
ACCENTED, UNACCENTED = "".join(_BASE), "".join(_BASE.values())


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_punct(c) -> Column:
    """Delete ASCII punctuation (no space inserted)."""
    return F.regexp_replace(_col(c), ASCII_PUNCT_CLASS, "")


def normalize_text(c) -> Column:
    """X1 + X2: lower-case and strip punctuation (corpus preprocessing)."""
    return strip_punct(F.lower(_col(c)))


def split_words(c) -> Column:
    """Whitespace split with empty strings dropped."""
    parts = F.split(F.regexp_replace(_col(c), WHITESPACE_RUN, " "), " ")
    return F.filter(parts, lambda t: t != F.lit(""))


def word_tokens(c) -> Column:
    """Word tokens of already-normalised text.

    Whitespace split; the word tokenizer's contractions (``cannot`` ...) are split
    after their third letter.
    """
    return F.flatten(F.transform(split_words(c), _split_contraction))


def _split_contraction(t: Column) -> Column:
    return F.when(
        F.lower(t).isin(*CONTRACTIONS), F.array(t.substr(F.lit(1), F.lit(3)), _tail(t, F.lit(4)))
    ).otherwise(F.array(t))


def _tail(s: Column, pos: Column) -> Column:
    """Substring from 1-based ``pos`` to the end."""
    return s.substr(pos, F.lit(1 << 30))


def vec_tokens(c) -> Column:
    """Vectoriser tokens (two or more word characters) of lower-cased text."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(f"({VEC_TOKEN})"), 1)


def strip_accents(c) -> Column:
    """Map accented Latin letters to their base letter."""
    return F.translate(_col(c), ACCENTED, UNACCENTED)


def soundex_code(c) -> Column:
    """X11: the Soundex variant.

    First character kept (upper-cased); the remaining letters map to digits, vowels
    and H/W/Y are dropped *without* separating equal digits, runs of equal digits
    collapse (the first character only collapses with a digit if it is itself that
    digit), and the code is cut or zero-padded to four characters.
    """
    u = F.upper(_col(c))
    first = F.substring(u, 1, 1)
    rest = _tail(u, F.lit(2))
    digits = F.translate(F.regexp_replace(rest, f"[^{SOUNDEX_LETTERS}]", ""), SOUNDEX_LETTERS, SOUNDEX_DIGITS)
    collapsed = F.regexp_replace(F.concat(first, digits), r"(\d)\1+", "$1")
    return F.rpad(F.substring(collapsed, 1, 4), 4, "0")


def deletions(c) -> Column:
    """The word itself (at = -1) and what is left of it without each one character: array of (part, at, letter)."""
    w = _col(c)
    whole = F.struct(w.alias("part"), F.lit(-1).alias("at"), F.lit("").alias("letter"))

    def without(i):
        return F.struct(
            F.concat(w.substr(F.lit(1), i), _tail(w, i + 2)).alias("part"), i.alias("at"), w.substr(i + 1, F.lit(1)).alias("letter"))

    each = F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(0), F.length(w) - 1), without))
    return F.when(each.isNull(), F.array(whole)).otherwise(F.concat(F.array(whole), each))


def edit1_candidates(c) -> Column:
    """X12 + U1: all strings one edit away over a-z (deletes, adjacent transposes,
    replaces, inserts), the word itself included, de-duplicated."""
    w = _col(c)
    n = F.length(w)
    letters = F.transform(F.sequence(F.lit(97), F.lit(122)), lambda x: F.char(x))

    def left(i):
        return w.substr(F.lit(1), i)

    def right_from(pos):
        return _tail(w, pos)

    idx_del = F.sequence(F.lit(0), n - 1)
    deletes = F.when(n > 0, F.transform(idx_del, lambda i: F.concat(left(i), right_from(i + 2)))).otherwise(
        F.array().cast("array<string>")
    )
    transposes = F.when(
        n > 1,
        F.transform(
            F.sequence(F.lit(0), n - 2),
            lambda i: F.concat(left(i), w.substr(i + 2, F.lit(1)), w.substr(i + 1, F.lit(1)), right_from(i + 3)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    replaces = F.when(
        n > 0,
        F.flatten(
            F.transform(idx_del, lambda i: F.transform(letters, lambda ch: F.concat(left(i), ch, right_from(i + 2))))
        ),
    ).otherwise(F.array().cast("array<string>"))
    inserts = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n), lambda i: F.transform(letters, lambda ch: F.concat(left(i), ch, right_from(i + 1)))
        )
    )
    return F.array_distinct(F.concat(deletes, transposes, replaces, inserts))


def clean_news(c) -> Column:
    """Newsgroup clean-up. Header lines are removed line-wise first (Q8), then
    whitespace runs become one space, dates d/d/yy(yy) and non-alphanumerics are
    deleted and the text is lower-cased."""
    t = F.regexp_replace(_col(c), r"(?m)^(From|Reply-To|Path|Organization):[^\n]*", "")
    t = F.regexp_replace(t, r"[\n\t]|[ \t\r\n\f\x0B]{2,}", " ")
    t = F.regexp_replace(t, r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}", "")
    t = F.regexp_replace(t, r"[^a-zA-Z0-9 \t\r\n\f\x0B]", "")
    return F.lower(t)


def page_bits(c) -> Column:
    """tag/word bit string of a page: 0 and 1 characters deleted, each tag
    becomes ``1``, each run of non-digit word characters becomes ``0``, everything
    else is dropped."""
    t = F.regexp_replace(_col(c), "[10]+", "")
    t = F.regexp_replace(t, "<[^>]*>", "1")
    t = F.regexp_replace(t, PAGE_WORD, "0")
    return F.regexp_replace(t, "[^10]", "")


def page_words(c) -> Column:
    """The words of a page in the same token stream as ``page_bits`` (Q9)."""
    t = F.regexp_replace(_col(c), "[10]+", "")
    t = F.regexp_replace(t, "<[^>]*>", "1")
    return F.regexp_extract_all(t, F.lit(f"({PAGE_WORD})"), 1)


def url_hash(c) -> Column:
    """SHA-256 hex of the URL."""
    return F.sha2(_col(c), 256)


def page_links(c) -> Column:
    """X20 + P9: href values of anchor tags, in page order."""
    return F.regexp_extract_all(_col(c), F.lit(HREF), 1)


def url_origin(c) -> Column:
    """scheme://host of a URL."""
    return F.regexp_extract(_col(c), r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)


def resolve_link(link, base) -> Column:
    """Resolve a link against its page: links with a scheme (http:, mailto:, ...) are kept,
    root-relative links get the page origin, other relative links the page directory; an
    empty link or a bare fragment is the page. ``.`` and ``..`` segments are resolved."""
    link, base = _col(link), _col(base)
    origin = url_origin(base)
    base_dir = F.regexp_extract(base, r"^([^?#]*/)", 1)
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), link))
        .when((link == "") | link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .when(link.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), link))
        .when(link.startswith("/"), F.concat(origin, _dots(link)))
        .otherwise(F.concat(origin, _dots(F.concat(F.regexp_replace(base_dir, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+", ""), link))))
    )


def _dots(path: Column) -> Column:
    """A path (query and fragment kept) without its ``.`` and ``..`` segments."""
    head, tail = F.regexp_extract(path, r"^([^?#]*)", 1), F.regexp_extract(path, r"^[^?#]*(.*)$", 1)
    segments = F.split(head, "/", -1)
    last = F.element_at(segments, -1)

    def step(acc, x):
        up = F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)
        return F.when(x == ".", acc).when(x == "..", up).otherwise(F.concat(acc, F.array(x)))

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    ends = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    clean = F.when(head.rlike(r"(^|/)\.\.?(/|$)"), F.concat(F.array_join(kept, "/"), ends)).otherwise(head)
    return F.concat(clean, tail)


def published_at(c) -> Column:
    """Published time from the ``article:published_time`` meta tag, null if absent."""
    raw = F.regexp_extract(_col(c), PUBLISHED_META, 1)
    raw = F.when(raw == "", None).otherwise(F.regexp_replace(F.trim(raw), r"^[A-Za-z]{3,9},\s*", ""))
    raw = F.regexp_replace(raw, r"\s*(GMT|UTC|UT)$", " +0000")
    return F.coalesce(
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ssXX")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXX")),
        F.try_to_timestamp(raw, F.lit("d MMM yyyy HH:mm:ss XX")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd HH:mm:ssXXX")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ss")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(raw, F.lit("yyyy-MM-dd")),
    )


def split_list(c, sep: str = ",") -> Column:
    """``[a,b]`` style list: brackets stripped, split on ``sep``, items trimmed, empties dropped."""
    items = F.split(F.regexp_replace(_col(c), r"[\[\]]", ""), sep)
    return F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != F.lit(""))


def pct(c, digits: int = 2) -> Column:
    """``{:.2f}%`` rendering of a fraction."""
    return F.concat(F.format_string(f"%.{digits}f", _col(c) * 100.0), F.lit("%"))


def decode_text(c, encoding: str = "UTF-8") -> Column:
    """Bytes -> string in ``encoding``; for UTF-8, invalid byte sequences
    become U+FFFD instead of failing the row."""
    col = _col(c)
    if encoding.upper().replace("-", "") == "UTF8":
        return F.make_valid_utf8(col.cast("string"))
    return F.decode(col, encoding)
