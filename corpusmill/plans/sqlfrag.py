"""DuckDB SQL fragments mirroring ``corpusmill.functions.text``; used only by the
oracle SQL of the registered queries (the independent check)."""
from __future__ import annotations

from corpusmill.functions import text as X
from corpusmill.operators.text import STOP_WORDS_EN


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP_LIST = "(" + ", ".join(q(w) for w in STOP_WORDS_EN) + ")"
CONTRACTION_LIST = "(" + ", ".join(q(w) for w in X.CONTRACTIONS) + ")"


def normalize(t: str) -> str:
    return f"regexp_replace(lower({t}), {q(X.ASCII_PUNCT_CLASS)}, '', 'g')"


def split_words(t: str) -> str:
    return f"list_filter(string_split(regexp_replace({t}, {q(X.WHITESPACE_RUN)}, ' ', 'g'), ' '), lambda w: w <> '')"


def word_tokens(t: str) -> str:
    return (
        f"flatten(list_transform({split_words(t)}, lambda w: CASE WHEN lower(w) IN {CONTRACTION_LIST} "
        f"THEN [substr(w, 1, 3), substr(w, 4)] ELSE [w] END))"
    )


def tokens(t: str) -> str:
    """Token list of raw text (normalise + word tokens)."""
    return word_tokens(normalize(t))


def soundex(t: str) -> str:
    u = f"upper(replace({t}, 'ß', 'ss'))"
    digits = (
        f"translate(regexp_replace(substr({u}, 2), '[^{X.SOUNDEX_LETTERS}]', '', 'g'), "
        f"'{X.SOUNDEX_LETTERS}', '{X.SOUNDEX_DIGITS}')"
    )
    s = f"(substr({u}, 1, 1) || {digits})"
    for d in "123456":
        s = f"regexp_replace({s}, '{d}+', '{d}', 'g')"
    return f"rpad(substr({s}, 1, 4), 4, '0')"


def edit1(w: str) -> str:
    letters = "list_transform(range(97, 123), lambda c: chr(CAST(c AS INTEGER)))"
    n = f"length({w})"
    deletes = f"list_transform(range(0, {n}), lambda i: substr({w}, 1, i) || substr({w}, i + 2))"
    transposes = (
        f"list_transform(range(0, greatest({n} - 1, 0)), lambda i: substr({w}, 1, i) || substr({w}, i + 2, 1) "
        f"|| substr({w}, i + 1, 1) || substr({w}, i + 3))"
    )
    replaces = (
        f"flatten(list_transform(range(0, {n}), lambda i: list_transform({letters}, "
        f"lambda c: substr({w}, 1, i) || c || substr({w}, i + 2))))"
    )
    inserts = (
        f"flatten(list_transform(range(0, {n} + 1), lambda i: list_transform({letters}, "
        f"lambda c: substr({w}, 1, i) || c || substr({w}, i + 1))))"
    )
    return f"list_distinct(list_concat({deletes}, {transposes}, {replaces}, {inserts}))"


def md5_bucket(c: str) -> str:
    return f"('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8))::BIGINT"


def page_text(h: str) -> str:
    return f"regexp_replace({h}, '<[^>]*>', ' ', 'g')"


def page_bits(h: str) -> str:
    t = f"regexp_replace({h}, '[10]+', '', 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', '1', 'g')"
    t = f"regexp_replace({t}, {q(X.PAGE_WORD)}, '0', 'g')"
    return f"regexp_replace({t}, '[^10]', '', 'g')"


def page_links(h: str) -> str:
    """Written out, not taken from the code: first the anchor tags, then the href attribute of each."""
    tags = f"regexp_extract_all({h}, '<a\\s[^>]*')"
    with_href = f"list_filter({tags}, lambda t: regexp_matches(t, '\\shref\\s*='))"
    return f"list_transform({with_href}, lambda t: regexp_extract(t, '\\shref\\s*=\\s*[\"'']?([^\"''\\s>]*)', 1))"


def url_origin(u: str) -> str:
    return f"regexp_extract({u}, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1)"


def resolve_link(link: str, base: str) -> str:
    return (
        f"CASE WHEN regexp_matches({link}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {link} "
        f"WHEN {link} = '' OR starts_with({link}, '#') THEN regexp_extract({base}, '^([^#]*)', 1) || {link} "
        f"WHEN starts_with({link}, '//') THEN regexp_extract({base}, '^([a-zA-Z][a-zA-Z0-9+.-]*:)', 1) || {link} "
        f"WHEN starts_with({link}, '/') THEN {url_origin(base)} || {link} "
        f"ELSE regexp_extract({base}, '^([^?#]*/)', 1) || {link} END"
    )
