"""File sources and sinks: fixture round trips."""
import json
import struct

from pyspark.sql import functions as F

from corpusmill.operators import models as M
from corpusmill.operators import text as TX
from corpusmill.sources import files as S


def test_articles_items_and_bad_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"text": "one"}, {"text": "two", "id": 3}]))
    (tmp_path / "b.json").write_text('[{"text": "three"}')
    arts, errs = S.read_articles(spark, str(tmp_path))
    assert sorted(r.text for r in arts.collect()) == ["one", "two"]
    assert [r.path.endswith("b.json") for r in errs.collect()] == [True]


def test_edges_with_header(spark, tmp_path):
    p = tmp_path / "g.txt"
    p.write_text("#\n#\n# Nodes: 4 Edges: 3\n#\n1   2\n1\t3\n4 1\n")
    edges, n = S.read_edges(spark, str(p))
    assert n == 4 and sorted(map(tuple, edges.collect())) == [(1, 2), (1, 3), (4, 1)]


def test_csv_and_tsv(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('Title,Review Text,Rating\n"A","multi\nline, text",5\n"B",,3\n')
    t = S.read_table(spark, str(p), "Title string, `Review Text` string, Rating int")
    rows = sorted(t.collect())
    assert rows[0]["Review Text"] == "multi\nline, text" and rows[1].Rating == 3
    a, b = tmp_path / "a.tsv", tmp_path / "b.tsv"
    a.write_text(" good film \t1\nbad\t0\n")
    b.write_text("fine\t1\n")
    lab = S.read_labelled(spark, {"imdb": str(a), "yelp": str(b)})
    assert sorted((r.text, r.label, r.source) for r in lab.collect()) == [
        ("bad", 0, "imdb"), ("fine", 1, "yelp"), ("good film", 1, "imdb")]


def test_dir_corpus_latin1(spark, tmp_path):
    for lab, name, txt in [("sci", "1", "caf\xe9"), ("arts", "2", "art"), ("sci", "3", "x")]:
        d = tmp_path / lab
        d.mkdir(exist_ok=True)
        (d / name).write_bytes(txt.encode("latin-1"))
    df = S.read_dir_corpus(spark, str(tmp_path), "ISO-8859-1")
    got = sorted((r.label, r.label_id, r.text) for r in df.collect())
    assert got == [("arts", 0, "art"), ("sci", 1, "caf\xe9"), ("sci", 1, "x")]


def test_sources_crawl_log_doc_map(spark, tmp_path):
    p = tmp_path / "sources.txt"
    p.write_text("health, https://a.org/x\ntech, https://b.org/y\n")
    assert [r.topic for r in S.read_sources(spark, str(p)).orderBy("topic").collect()] == ["health", "tech"]
    log = spark.createDataFrame([("t", "https://a.org/x,y", 0, None)], S.CRAWL_SCHEMA)
    S.write_crawl_log(log, str(tmp_path / "log"))
    S.write_crawl_log(log, str(tmp_path / "log"))
    back = S.read_crawl_log(spark, str(tmp_path / "log")).collect()
    assert len(back) == 2 and back[0].url == "https://a.org/x,y"
    m = spark.createDataFrame([("ab" * 32, 7)], "url_hash string, doc_id long")
    S.write_doc_map(m, str(tmp_path / "map"))
    assert spark.read.text(str(tmp_path / "map")).first().value == "ab" * 32 + " | H7"
    assert S.read_doc_map(spark, str(tmp_path / "map")).first().doc_id == 7


def test_unigrams_and_index_round_trips(spark, tmp_path):
    docs = spark.createDataFrame([(1, "b a b"), (2, "a c")], "doc_id long, text string")
    post = TX.postings(TX.tokenize(docs))
    uni = TX.unigram_counts(TX.tokenize(docs))
    for fmt in ("text", "parquet"):
        S.write_unigrams(uni, str(tmp_path / f"u_{fmt}"), fmt)
        assert sorted(map(tuple, S.read_unigrams(spark, str(tmp_path / f"u_{fmt}"), fmt).collect())) == sorted(
            map(tuple, uni.collect()))
    want = sorted(map(tuple, post.select("token", "doc_id", "tf").collect()))
    for fmt in ("parquet", "json", "table"):
        S.write_index(post.select("token", "doc_id", "tf"), str(tmp_path / f"i_{fmt}"), fmt)
        got = sorted(map(tuple, S.read_index(spark, str(tmp_path / f"i_{fmt}"), fmt).collect()))
        assert got == want
    lines = [r.value for r in spark.read.text(str(tmp_path / "i_table")).collect()]
    assert "| b | B000 | [(1, 2)] |" in lines
    S.write_tokens(TX.tokenize(docs), str(tmp_path / "tok"))
    assert spark.read.text(str(tmp_path / "tok")).count() == 5


def test_nested_json_and_profiles(spark, tmp_path):
    p = tmp_path / "t.json"
    p.write_text(json.dumps({"Marks": [{"student": "a", "AI": 3}, {"student": "b", "AI": 5}]}))
    df = S.read_nested(spark, str(p), "Marks", "student:string, AI:int")
    assert sorted(map(tuple, df.collect())) == [("a", 3), ("b", 5)]
    prof = spark.createDataFrame([("http://x/1", "Ann", [("Bob", "Prof", "l")])],
                                 "url string, name string, coauthors array<struct<n:string,t:string,l:string>>")
    S.write_profiles(prof, str(tmp_path / "prof"))
    back = spark.read.json(str(tmp_path / "prof")).first()
    assert back.name == "Ann" and len(back.url_hash) == 64


def _bmp(path, w, h, rgb):
    """A 24-bit uncompressed BMP (rows bottom-up, BGR, 4-byte aligned)."""
    rows = []
    for y in range(h - 1, -1, -1):
        r = b"".join(bytes(rgb[y * w + x][::-1]) for x in range(w))
        rows.append(r + b"\0" * ((4 - len(r) % 4) % 4))
    data = b"".join(rows)
    header = b"BM" + struct.pack("<IHHI", 54 + len(data), 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(data), 2835, 2835, 0, 0)
    path.write_bytes(header + info + data)


def test_images_labels_and_flip(spark, tmp_path):
    (tmp_path / "cat").mkdir()
    (tmp_path / "dog").mkdir()
    _bmp(tmp_path / "cat" / "a.bmp", 2, 1, [(255, 0, 0), (0, 0, 255)])
    _bmp(tmp_path / "dog" / "b.bmp", 2, 1, [(0, 255, 0), (0, 255, 0)])
    img = S.read_images(spark, str(tmp_path))
    assert sorted(r.label for r in img.collect()) == ["cat", "dog"]
    px = S.image_pixels(img.filter("label = 'cat'"), flip=False).first().pixels
    fl = S.image_pixels(img.filter("label = 'cat'"), flip=True).first().pixels
    assert len(px) == 6 and max(px) == 1.0 and px[:3] == fl[3:] and px[3:] == fl[:3]


def test_model_save_load(spark, tmp_path):
    from pyspark.ml import Pipeline

    df = spark.createDataFrame([("good fine nice", 1.0), ("bad awful", 0.0)] * 5, "text string, label double")
    model = Pipeline(stages=[*M.text_stages(), M.classifier("multinomial")]).fit(df)
    M.save_model(model, str(tmp_path / "m"))
    again = M.load_model(str(tmp_path / "m"))
    assert again.transform(df).filter(F.col("prediction") == F.col("label")).count() == 10
    try:
        M.load_model(str(tmp_path / "missing"))
        raise AssertionError("expected a missing-model error")
    except FileNotFoundError as e:
        assert "train" in str(e)
