"""The pipeline's stages against the operators and brute force, and the optional import."""
import subprocess
import sys

import numpy as np

import corpus_pipeline
from corpusmill.llm.toxicity import toxicity
from tests.conftest import SF001
from tests.llm.test_dedup_ops import ascii_lower, components, shingles
from tests.llm.test_text_ops import word_ids


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    left = {r.doc_id for r in toxicity(docs, labels).collect() if r.predicted == 0}
    by_text = {}
    for i in left:
        by_text.setdefault(ascii_lower(texts[i]), []).append(i)
    left = sorted(max(g) for g in by_text.values())
    sets = [(i, shingles(texts[i])) for i in left]
    comp = components(sets, lambda a, b: bool(a & b) and 100 * len(a & b) >= 75 * len(a | b))
    left = {i for i in left if comp[i] == i}
    rows = corpus_pipeline.run(spark, SF001).collect()
    assert {r.doc_id for r in rows} == left
    for i in list(left)[:40]:
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert sum(r.length for r in own) == len(word_ids(texts[i])) + 1
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048 and all(n & (n - 1) == 0 for n in used.values())


def test_stage_columns(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF001).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF001).count() == 0, name


def test_entry_without_the_subpackage(tmp_path):
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name in ("corpus_pipeline", "corpusmill.llm") or name.startswith("corpusmill.llm."):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
q = e.queries()
assert "pipeline" not in q and not any(k.startswith("op") and k[2].isdigit() for k in q) and len(q) > 50
assert set(e.oracle_sql()) <= set(q)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=".")
