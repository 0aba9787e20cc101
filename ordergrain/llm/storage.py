"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordergrain.session import scratch_folder, ship_package

__all__ = ["drop_stored", "scratch_folder", "settled", "ship_package", "stored"]

_STORED: list[str] = []
# Spark deletes the shuffle files of an execution at its end, not when the driver next collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet and read back: lineage ends there, lost executors cost nothing.

    The table stays until :func:`drop_stored`, because later plans may still read it. The shuffles that wrote it
    go at once, as the plan is not run again.
    """
    spark = df.sparkSession
    path = scratch_folder(spark)
    _STORED.append(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``build`` returns, stored; the tables that were stored on the way to it are deleted."""
    before = len(_STORED)
    result = stored(build())
    passing = _STORED[before:-1]
    del _STORED[before:-1]
    for path in passing:
        _delete(spark, path)
    return result


def _delete(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_stored(spark: SparkSession) -> int:
    """Deletes the intermediate tables of this process and returns their number.

    To be called when all results that were computed from them have been written.
    """
    gone = 0
    while _STORED:
        gone += _delete(spark, _STORED.pop())
    return gone
