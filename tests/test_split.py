"""JSON arrays and quoted CSV read in byte ranges: the same rows as one task reads, wherever the cuts fall."""
import json
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import files as S
from corpusmill.sources.split import cut_records

PIECES = ['"', '\\', "{", "}", "[", "]", ",", ":", "\n", "\r\n", "é", "漢", " ", "word", '""', "}]", '\\"', '"}', "]}"]


@pytest.fixture(params=[41, 700])
def ranges(spark, request):
    """Scans cut files into ranges of so many bytes, and tasks get two rows a batch."""
    wanted = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1",
              "spark.sql.execution.arrow.maxRecordsPerBatch": "2"}
    old = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def _texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choices(PIECES, k=r.choice([0, 1, 3, 9, 40]))) for _ in range(n)]


@pytest.mark.parametrize("indent", [None, 1])
def test_array_in_ranges(spark, tmp_path, ranges, indent):
    want = _texts(12, ranges)
    items = [{"text": t, "in": {"deep": [t, {"x": 1}]}} for t in want]
    (tmp_path / "a.json").write_text(json.dumps(items, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text('﻿ [{"text": "mark"}]\n', encoding="utf-8")
    arts, errors = S.read_articles(spark, str(tmp_path))
    assert sorted(r.text for r in arts.collect()) == sorted([*want, "mark"])
    assert errors.count() == 0
    records, files = cut_records(spark, str(tmp_path / "a.json"), "json")
    assert sorted(json.loads(r.record)["text"] for r in records.collect()) == sorted(want)
    assert records.filter("first").count() == 1 and [r.complete for r in files.collect()] == [True]


def test_broken_arrays_are_reported_whole(spark, tmp_path, ranges):
    good = json.dumps([{"text": "x" * 50}, {"text": None}, {"other": 1}])
    files = {"good": good, "empty": "[]", "cut": good[:-1], "cut_in_item": good[:70], "cut_in_text": good[:30],
             "object": '{"text": "alone"}', "bad_item": '[{"text": "fine"}, {"text": oops}]', "no_json": "hello", "nothing": ""}
    for name, text in files.items():
        (tmp_path / f"{name}.json").write_text(text)
    arts, errors = S.read_articles(spark, str(tmp_path))
    assert [r.text for r in arts.collect()] == ["x" * 50]
    found = {r.path.rsplit("/", 1)[1].removesuffix(".json") for r in errors.collect()}
    assert found == {"cut", "cut_in_item", "cut_in_text", "object", "bad_item", "no_json"}


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_table_in_ranges(spark, tmp_path, ranges, end):
    texts = [t.replace("\\", "/") for t in _texts(12, 100 + ranges)]
    rows = [f'{i},"{t.replace(chr(34), chr(34) * 2)}",{i % 5}' for i, t in enumerate(texts)]
    rows.insert(7, "")
    rows.append("x,,")
    (tmp_path / "t.csv").write_bytes(end.join(['No,"Review\nText",Rating', *rows]).encode())
    schema = "No int, `Review Text` string, Rating int"
    got = S.read_table(spark, str(tmp_path), schema)
    want = spark.read.csv(str(tmp_path), header=True, schema=schema, multiLine=True, escape='"')
    assert got.columns == want.columns
    got = {r.No: (r["Review Text"] or "", r.Rating) for r in got.collect()}
    assert got == {None: ("", None), **{i: (t, i % 5) for i, t in enumerate(texts)}}
    if end == "\n":  # with two-byte line ends Spark's reader is misled by single ones within quotes
        assert got == {r.No: (r["Review Text"] or "", r.Rating) for r in want.collect()}


def test_one_file_is_read_by_several_tasks(spark, tmp_path, ranges):
    (tmp_path / "a.json").write_text(json.dumps([{"text": "word " * 40} for _ in range(12)]))
    records, _ = cut_records(spark, str(tmp_path / "a.json"), "json")
    tasks = records.select(F.spark_partition_id().alias("p")).distinct().count()
    assert records.count() == 12 and tasks > 1


def test_more_ranges_than_are_broadcast(spark, tmp_path, ranges):
    want = _texts(8, 5)
    (tmp_path / "a.json").write_text(json.dumps([{"text": t} for t in want]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records, _ = cut_records(spark, str(tmp_path / "a.json"), "json", most_broadcast=0)
        assert sorted(json.loads(r.record)["text"] for r in records.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
