from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from ordergrain.llm import bpe, storage


def test_stored_tables_are_read_back_and_dropped(spark):
    storage.drop_stored(spark)
    first, empty = storage.stored(spark.range(5)), storage.stored(spark.createDataFrame([], "a long, b array<int>"))
    assert first.count() == 5 and empty.collect() == [] and empty.dtypes == [("a", "bigint"), ("b", "array<int>")]
    assert storage.drop_stored(spark) == 2 and storage.drop_stored(spark) == 0


def test_large_vocabulary_files_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "LARGEST_FILE", 10)
    (tmp_path / "large.json").write_text("{}" * 10)
    with pytest.raises(ValueError):
        bpe.Vocabulary(spark, str(tmp_path / "large.json"))


def test_tables_on_the_way_to_a_settled_one_are_deleted(spark):
    storage.drop_stored(spark)
    outside = storage.stored(spark.range(3))
    passing = []

    def build():
        passing.append(storage.stored(spark.range(5)))
        inner = storage.settled(spark, lambda: storage.stored(spark.range(4)).where("id > 0"))
        return passing[0].join(inner, "id").join(outside, "id", "left_anti")

    assert [r.id for r in storage.settled(spark, build).collect()] == [3]
    assert outside.count() == 3 and storage.drop_stored(spark) == 2
    with pytest.raises(Exception, match="(?i)not.*exist"):
        passing[0].collect()


def test_shuffles_of_a_stored_table_are_deleted_at_once(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getPath() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    before = shuffled()
    grouped = spark.range(10_000).groupBy((F.col("id") % 1000).alias("k")).count()
    table = storage.stored(grouped)
    until = time.time() + 20  # Spark deletes them in the background
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.1)
    assert not left and table.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    storage.drop_stored(spark)
