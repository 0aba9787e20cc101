"""Marking the rare categories of rows by a table that is saved with the model."""

from __future__ import annotations

import json

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class RareCategories(Transformer, MLWritable, MLReadable):
    """Adds, for each column with rare categories, whether a row's value is one of them.

    The values are a table (``column``, ``value``), joined by Spark whatever its size; neither the driver nor the
    query text holds them. ``fallbacks`` names the columns and the value that stands for a missing one.
    """

    fallbacks = Param(Params._dummy(), "fallbacks", "value of missing cells by column, as JSON", TypeConverters.toString)

    def __init__(self, values: DataFrame | None = None, fallbacks: dict[str, str] | None = None) -> None:
        super().__init__()
        self.values = values
        self._set(fallbacks=json.dumps(fallbacks or {}))

    @staticmethod
    def mark(column: str) -> str:
        """Name of the added column."""
        return f"rare__{column}"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for column, fallback in json.loads(self.getOrDefault(self.fallbacks)).items():
            key, mark = f"key__{column}", self.mark(column)
            rare = self.values.where(F.col("column") == column).select(
                F.col("value").alias(key), F.lit(True).alias(f"known__{column}")
            )
            same = F.coalesce(F.col(f"`{column}`"), F.lit(fallback)) == F.col(key)
            dataset = dataset.join(rare, same, "left").withColumn(mark, F.col(f"known__{column}").isNotNull())
            dataset = dataset.drop(key, f"known__{column}")
        return dataset

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: RareCategories) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.values.write.parquet(f"{path}/values")


class _Reader(MLReader):
    def load(self, path: str) -> RareCategories:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = RareCategories(self.sparkSession.read.parquet(f"{path}/values"))
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance
