"""ANN, toxicity, sharding and WARC."""
import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import ann, sharding, toxicity, warc
from corpusmill.llm.common import shared_path
from tests.conftest import SF01


def brute(vectors, queries, n):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = x @ x[ids.index(q)]
        out[q] = sorted((-round(v, 9), i) for v, i in zip(s.tolist(), ids) if i != q)[:n]
    return out


@pytest.mark.parametrize("folder", [SF01, SF01.replace("0.01", "0.1")])
def test_ann_recall(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in rows.collect()}
    queries = [i for i in vectors if i % 50 == 0]
    got = ann.nearest(rows, rows.filter("vec_id % 50 = 0"), 5).collect()
    want = brute(vectors, queries, 5)
    hit = sum(r.vec_id in {i for _, i in want[r.query_id]} for r in got)
    assert hit >= 0.95 * 5 * len(queries)
    assert sorted((r.query_id, r["rank"]) for r in got) == sorted((q, k) for q in queries for k in range(1, 6))


def test_ann_small_tables_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], "x") for i in range(100)]
    rows += [(200 + i, rows[3][1], "x") for i in range(30)]  # a hot vector
    odd = [(300, None, "x"), (301, [0.0] * 8, "x"), (302, [float("nan")] + [1.0] * 7, "x"), (303, [None] + [1.0] * 7, "x"), (304, [1.0], "x"), (None, [1.0] * 8, "x"), (305, [float("inf")] * 8, "x"), (306, [1e300] * 8, "x"), rows[0]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string")
    got = ann.nearest(df, df.filter("vec_id % 50 = 0 or vec_id = 3"), 5).collect()
    vectors = {i: v for i, v, _ in rows} | {306: [1.0] * 8}
    want = brute(vectors, [0, 50, 3, 200], 5)
    for q, best in want.items():
        mine = sorted((r["rank"], r.vec_id) for r in got if r.query_id == q)
        assert [v for _, v in mine] == [v for _, v in best]
    assert {r.query_id for r in got} == set(want)


def test_ann_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], schema)
    got = ann.nearest(two, two.filter("vec_id = 0")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1)] and abs(got[0].score - 0.5**0.5) < 1e-12
    assert ann.nearest(two.limit(0), two).count() == 0
    assert ann.nearest(two, two.limit(0)).count() == 0


def test_footrule_ranking():
    rng = np.random.default_rng(0)
    lists = np.argsort(rng.random((50, 20)), axis=1)[:, :6].astype(np.int16)
    total = ann.InvertedFiles(lists, 20).rank(lists[0])

    def footrule(a, b):
        place = lambda x, p: x.index(p) if p in x else 6
        return sum(abs(place(a, p) - place(b, p)) for p in set(a) | set(b))

    d = [footrule(lists[0].tolist(), row.tolist()) for row in lists]
    assert all(d[i] == d[0] + 2 * (total[0] - total[i]) for i in range(50))


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    hit = sum(r.predicted == 1 for r in got if r.toxic == 1) / max(1, sum(r.toxic == 1 for r in got))
    false = sum(r.predicted == 1 for r in got if r.toxic == 0) / sum(r.toxic == 0 for r in got)
    assert hit >= 0.8 and false <= 0.01


def test_training_frees_the_drivers_memory(spark, monkeypatch):
    """What the driver needed to train is given back before its next work."""
    freed = []
    monkeypatch.setattr(toxicity, "release", lambda: freed.append(1))
    rows = [(i, "bad worse" if i % 2 else "good fine", i % 2) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is not None
    assert freed == [1]


def test_toxicity_odd_rows(spark):
    good, bad = "the sun is up and warm over there", "you stupid idiot clown go away from here"
    rows = [(i, bad if i % 4 == 0 else f"{good} {i}") for i in range(200)] + [(None, bad), (500, None), (501, ""), (502, bad), (502, bad)]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], "doc_id long, text string, score double, p string")
    labels = spark.createDataFrame([(i, 1 if i % 4 == 0 else 0) for i in range(0, 200, 2)] + [(None, 1), (3, None), (0, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 205 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert sum(r.predicted for r in got) == 53
    import zlib

    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 152
    none = toxicity.toxicity(docs, labels.filter("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0 and toxicity.drop_toxic(docs, labels.limit(0)).count() == 205


def test_non_negative_risk_learns():
    rng = np.random.default_rng(1)

    def make(n, toxic):
        each = [np.unique(np.concatenate([rng.integers(100, 400, 30), rng.integers(0, 10, 2) if t else []]).astype(np.int32)) for t in toxic[:n]]
        return np.cumsum([0, *map(len, each)]), np.concatenate(each)

    p, u = make(300, [True] * 300), make(900, [i % 5 == 0 for i in range(900)])
    w, b = toxicity.fit(*p, *u, 0.2)
    f = toxicity.margins(*u, w, b) > 0
    assert (f == (np.arange(900) % 5 == 0)).mean() > 0.98


def test_lookup_table_by_turns():
    shards = [f"s{i}" for i in range(7)]
    size = sharding.first_prime(50)
    owner, free = {}, {s: [(sharding.hash60(f"{s}:offset") + i * (sharding.hash60(f"{s}:skip") % (size - 1) + 1)) % size for i in range(size)] for s in shards}
    while len(owner) < size:
        for n, s in enumerate(shards):
            slot = next((x for x in free[s] if x not in owner), None)
            if slot is not None:
                owner[slot] = n
    table = sharding.lookup_table(shards, 50)
    assert table == [owner[i] for i in range(size)]
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    big, less = sharding.lookup_table([f"s{i}" for i in range(20)], 5000), sharding.lookup_table([f"s{i}" for i in range(19)], 5000)
    moved = np.mean([a != b for a, b in zip(big, less) if a != 19])
    assert moved < 0.1
    with pytest.raises(ValueError):
        sharding.lookup_table(["a", "a"])


def test_place_rows(spark):
    shards = [f"s{i}" for i in range(8)]
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.col("id").cast("string")).alias("key"), "id", F.lit(1).alias("n"))
    plain = sharding.place(df, "key", shards)
    assert plain.columns == ["key", "id", "n", "slot", "shard"] and plain.count() == 4000
    table = sharding.lookup_table(shards)
    for r in plain.limit(300).collect():
        slot = sharding.hash60(r.key or "") % len(table)
        assert (r.slot, r.shard) == (slot, table[slot])
    split = sharding.place(df, "key", shards, split_by="id")
    per = [r["count"] for r in split.groupBy("shard").count().collect()]
    assert sum(per) == 4000 and max(per) < 2 * 500
    plan = split._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    assert sharding.place(df.limit(0), "key", shards, split_by="id").count() == 0
    with pytest.raises(ValueError):
        sharding.place(df.withColumn("slot", F.lit(1)), "key", shards)


PAGES = [(1, "http://a/é", "<p>hé</p>"), (2, "http://b", "<p>hé</p>"), (3, None, None), (4, "http://c/\r\nX: y", ""), (5, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "n", "<p>hé</p>"), (9, "big", "x\n" * 300_000), (9, "big", "x\n" * 300_000)]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "q") for r in rows], "page_id long, url string, html string, sha1 string")


def test_warc_round_trip(spark):
    got = warc.pages_round_trip(pages(spark).repartition(3)).collect()
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        first = min((j for j, _, h in PAGES if (h or "").encode() == raw and j is not None), default=None)
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == first else "revisit", None if i == first else first))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_warc_least_bytes_and_empty(spark):
    got = warc.pages_round_trip(pages(spark), min_revisit_bytes=5).collect()
    assert sorted(r.page_id or 0 for r in got if r.record_type == "revisit") == [0, 2]
    assert warc.pages_round_trip(pages(spark).limit(0)).count() == 0


def test_warc_pushdown_and_skipping(spark):
    path = shared_path(spark, "warc")
    warc.write_pages(pages(spark), path)
    df = warc.read_warc(spark, path).filter((F.col("record_type") == "response") & (F.col("target_uri") == "u"))
    rows = df.collect()
    assert [(r.record_id, bytes(r.payload)) for r in rows] == [("urn:page:5", PAGES[4][2].encode())]
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, GreaterThan

    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("payload_bytes",), 3)]))
    assert len(left) == 1 and reader.wanted == [("record_type", frozenset(["revisit"]))]
    bare = warc.read_warc(spark, path, payload=False).collect()
    assert len(bare) == len(PAGES) and all(r.payload is None for r in bare)
    assert {r.target_uri for r in bare if r.record_id == "urn:page:4"} == {"http://c/%0D%0AX: y"}


def test_warc_rolls_and_abandons(spark, tmp_path):
    import pyarrow as pa

    w = warc.WarcWriter({"path": str(tmp_path), "rollbytes": "1000"})
    rows = [{"record_id": f"urn:page:{i}", "record_type": "response", "target_uri": None, "refers_to": None, "payload_digest": warc.payload_digest(b"z" * 600), "payload_bytes": 600, "payload": b"z" * 600} for i in range(6)]
    done = w.write(iter([pa.RecordBatch.from_pylist(rows)]))
    lost = w.write(iter([pa.RecordBatch.from_pylist(rows)]))
    w.abort([lost])
    w.commit([done, None])
    assert len(done.names) > 1 and len(list(tmp_path.iterdir())) == len(done.names)
    assert warc.read_warc(spark, str(tmp_path)).count() == 6
