"""Streaming re-aims: availableNow streams, stopped and started again, equal the batch job."""
import time

from pyspark.sql import functions as F

from corpusmill.operators import text as TX
from corpusmill.streaming import intake as R
from tests.conftest import SF001


def _state_rows(query):
    return query.lastProgress.stateOperators[0].numRowsTotal


def test_running_unigrams_equal_batch_after_a_restart(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    first, second = docs.filter("doc_id % 2 = 0"), docs.filter("doc_id % 2 = 1")
    src, out, ck = (str(tmp_path / n) for n in ("docs", "counts", "ck"))
    for part in (first, second):
        part.coalesce(2).write.mode("append").parquet(src)
        q = R.start_running_unigrams(spark, src, out, ck)
        assert q.awaitTermination(300) and q.exception() is None
    got = {r.token: r.n for r in R.current_unigrams(spark, out).collect()}
    assert got == {r.token: r.n for r in TX.unigram_counts(TX.tokenize(docs)).collect()}
    assert not any(t.isTemporary for t in spark.catalog.listTables())  # no sink in the driver's memory


def test_page_intake_dedupes_and_replays(spark, tmp_path):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url", "html")
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    nameless = spark.createDataFrame([(None, None, "<p>x</p>"), (None, "http://new.example/", None)], R.PAGE_SCHEMA)
    # two runs; the second repeats ten URLs of the first and brings one that is new, twice
    for part in (pages, pages.orderBy("url").limit(10).unionByName(nameless).unionByName(nameless)):
        part.coalesce(1).write.mode("append").parquet(src)
        q = R.start_intake(spark, src, out, ck)
        assert q.awaitTermination(300) and q.exception() is None
    dm = spark.read.parquet(f"{out}/doc_map")
    n = pages.select("url").distinct().count() + 1
    assert dm.count() == n and dm.select("url_hash").distinct().count() == n and _state_rows(q) == n
    assert sorted(r.doc_id for r in dm.collect()) == list(range(n))
    post = spark.read.parquet(f"{out}/postings")
    assert post.agg(F.countDistinct("doc_id")).first()[0] <= n and post.count() > 0
    # a batch that is done again rewrites what it wrote
    before = sorted(map(tuple, post.collect()))
    again = spark.read.parquet(f"{out}/pages").filter("batch_id = 0").select("url", "html").checkpoint()
    R.intake_batch(again, 0, out)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/postings").collect())) == before


def test_known_urls_are_forgotten_in_time(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    sizes = []
    for urls in (range(40), [1, 2, 100]):
        spark.createDataFrame([(i, f"http://a.example/{i}", f"<p>page {i}</p>") for i in urls], R.PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(src)
        q = R.start_intake(spark, src, out, ck, ttl_ms=1000)
        assert q.awaitTermination(300) and q.exception() is None
        sizes.append(_state_rows(q))
        time.sleep(1.5)
    assert sizes == [40, 3]
    seen = spark.read.parquet(f"{out}/doc_map").groupBy("url").count().filter("count = 2")
    assert sorted(r.url for r in seen.collect()) == ["http://a.example/1", "http://a.example/2"]
