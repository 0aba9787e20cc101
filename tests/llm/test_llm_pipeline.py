from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from ordergrain.llm.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


def test_all_operators_and_the_pipeline_are_registered():
    names = set(entry_point.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLES) <= set(entry_point.oracle_sql()) and "pipeline" not in entry_point.oracle_sql()
    assert [f.__module__ for _, f in corpus_pipeline.STAGES] == ["corpus_pipeline"] * 5


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    duck = duckdb.connect()
    for view in ("documents", "embeddings", "conversations"):
        duck.sql(f"CREATE VIEW {view} AS SELECT * FROM '{FOLDER}/{view}.parquet'")
    found, expected = QUERIES[name](spark, FOLDER), duck.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = [tuple(r) for r in found.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted(expected.select(*(f'"{c}"' for c in columns)).fetchall(), key=repr)


def test_stages(spark, tmp_path):
    """Every stage on what the one before has written; its decisions take effect."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == COLUMNS
        assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        if name in ("quality", "near_duplicates"):
            assert all(before[k] == text for k, text in after.items())
        else:
            assert set(after) == set(before) and all(len(text) <= len(before[k]) for k, text in after.items())
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(before)
    fills = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert fills.where("n <> end OR n > 1024").count() == 0


def test_awkward_documents(spark, documents, awkward, tmp_path):
    docs = documents(awkward, clashing=False)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.where("doc_id = 1").count() == 1 and docs.where("doc_id IS NULL").count() >= 1


def test_empty_documents(spark, documents):
    docs = documents([], clashing=False)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0


def test_the_rest_works_without_the_subpackage():
    """Without the folders and the file, the entry module has the other queries."""
    script = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name == 'ordergrain.llm':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "assert 'enriched_orders' in names and not any(n.startswith('op1') or n == 'pipeline' for n in names)\n"
        "assert set(e.oracle_sql()) <= names\n"
    )
    root = Path(entry_point.__file__).parent
    subprocess.run([sys.executable, "-c", script], cwd=root, check=True, timeout=120)
