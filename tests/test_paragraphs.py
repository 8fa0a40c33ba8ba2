"""Paragraphs of pages: open tags, headings, nested lists, neighbour rules against a written-out form."""
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import html as H
from corpusmill.operators import paragraphs as PG

LONG = "the cat is on the mat and it is not in the house " * 8
PAGE = "page_id long, html string"


def _rows(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), PAGE)
    return [r.asDict() for r in PG.classified_blocks(df).orderBy("page_id", "block").collect()]


def test_nested_lists_headings_and_breaks(spark):
    got = _rows(spark, "<html><head><title>no</title></head><body><h1>Head</h1><ul><li>one<ul><li>two <a href=x>lk</a></ul><li>three</ul>"
                       f"<p>{LONG}</p>short<br> <br>other &amp; more<script>var a = '<p>';</script></body></html>")
    assert [(r["text"], r["heading"], r["class"]) for r in got] == [
        ("Head", True, "good"), ("one", False, "bad"), ("two lk", False, "bad"), ("three", False, "bad"), (LONG.strip(), False, "good"),
        ("short", False, "bad"), ("other & more", False, "bad")]
    assert got[2]["link_density"] == pytest.approx(2 / 6)


def test_open_tags(spark):
    # a heading ends with the element it stands in; an unclosed link ends with its block; stray end tags do nothing
    got = _rows(spark, "<div><h2>in</div>out</h2></p><ul><li><a>link</ul>free <b>bold</b><i> </i>tail<br>same", "<h2>a<span>b</span><p>c</h2>d")
    assert [(r["page_id"], r["text"], r["heading"], r["link_density"] > 0) for r in got] == [
        (0, "in", True, False), (0, "out", False, False), (0, "link", False, True), (0, "free boldtailsame", False, False),
        (1, "ab", True, False), (1, "c", True, False), (1, "d", False, False)]


def test_heading_distance(spark):
    # the rule looks at most MAX_HEADING_DISTANCE characters below the heading
    for gap, cls in ((200, "good"), (201, "bad")):
        got = _rows(spark, f"<h1>Head</h1><p>{'x' * gap}</p><p>{LONG}</p>")
        assert [r["class"] for r in got] == [cls, "bad", "good"]


def test_null_empty_and_menu(spark):
    assert _rows(spark, None, "", "<p> </p>&nbsp;<br><br>") == []
    assert [r["cf_class"] for r in _rows(spark, f"<select><option>{LONG}</select><p>{LONG}&copy;</p><p>{LONG}</p>")] == ["bad", "bad", "good"]
    pages = spark.createDataFrame([(1, "http://a/b", f"<p>{LONG}</p><a href='/x'>x</a>"), (2, "http://a/c", None)], "page_id long, url string, html string")
    one, two = H.extract_page(pages).orderBy("page_id").collect()
    assert (one.content, one.links) == (LONG.strip(), ["http://a/x"]) and two.content == ""


def _written_out(ps):
    """The neighbour rules as loops: ps holds (class, length, heading)."""
    n, cls = len(ps), [p[0] for p in ps]

    def side(i, inc, near=False):
        j = i + inc
        while 0 <= j < n:
            if cls[j] in "GB" or (near and cls[j] == "N"):
                return cls[j]
            j += inc
        return "B"

    def below(i):
        far, j = 0, i + 1
        while j < n and far <= PG.MAX_HEADING_DISTANCE:
            if cls[j] == "G":
                return True
            far, j = far + ps[j][1], j + 1
        return False

    for i in range(n):
        if ps[i][2] and cls[i] == "S" and below(i):
            cls[i] = "N"
    new = list(cls)
    for i in range(n):
        if cls[i] == "S":
            l, r = side(i, -1), side(i, 1)
            mixed = (l == "B" and side(i, -1, True) == "N") or (r == "B" and side(i, 1, True) == "N")
            new[i] = l if l == r else "G" if mixed else "B"
    cls[:] = new
    for i in range(n):
        if cls[i] == "N":
            cls[i] = "B" if side(i, -1) == side(i, 1) == "B" else "G"
    for i in range(n):
        if ps[i][2] and cls[i] == "B" and ps[i][0] != "B" and below(i):
            cls[i] = "G"
    return "".join(cls)


@pytest.mark.parametrize("chunk", [3, 512])
def test_neighbour_rules(spark, monkeypatch, chunk):
    monkeypatch.setattr(PG, "CHUNK", chunk)
    rnd = random.Random(4)
    pages = [[(rnd.choice("GNSSB"), rnd.choice([5, 60, 150]), rnd.random() < 0.4) for _ in range(rnd.randint(0, 14))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(pages)), "id long, ps array<struct<cf: string, length: int, heading: boolean>>")
    got = {r.id: r.c for r in df.select("id", F.array_join(PG.revise(F.col("ps")), "").alias("c")).collect()}
    assert got == {i: _written_out(p) for i, p in enumerate(pages)}


def test_no_shuffle(spark):
    plan = PG.classified_blocks(spark.createDataFrame([(0, "<p>x")], PAGE))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
