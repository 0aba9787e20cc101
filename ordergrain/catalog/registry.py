"""Registration of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordergrain.catalog.oracle import ROLES_AND_ENRICHED
from ordergrain.plans.enrich import enrich_orders
from ordergrain.session import apply_settings
from ordergrain.sources.roles import RoleTables

# Averages of doubles depend in their last bits on the order of addition, so both sides of a
# comparison round them to this many places.
COMPARED_PLACES = 6


class Inputs:
    """The commerce tables of one test-data folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = apply_settings(spark)
        self.folder = folder

    @cached_property
    def tables(self) -> RoleTables:
        return RoleTables(self.spark, self.folder)

    def orders(self, *columns: str) -> DataFrame:
        """The enriched orders, all columns or the given ones."""
        return enrich_orders(self.tables, columns or None)

    def delivered(self, *columns: str) -> DataFrame:
        """The given columns of the delivered orders."""
        rows = enrich_orders(self.tables, ["order_status", *columns])
        return rows.where(F.col("order_status") == "delivered").drop("order_status")

    def parquet(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str | None
    rounded: tuple[str, ...]

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Inputs(spark, folder))
        return df.withColumns({c: F.round(c, COMPARED_PLACES) for c in self.rounded}) if self.rounded else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        replaced = ", ".join(f"round({c}, {COMPARED_PLACES}) AS {c}" for c in self.rounded)
        star = f"* REPLACE ({replaced})" if replaced else "*"
        return f"{ROLES_AND_ENRICHED}\nSELECT {star} FROM (\n{self.sql.strip()}\n)"


QUERIES: dict[str, Query] = {}


def register(
    name: str, build: Callable[[Inputs], DataFrame], sql: str | None = None, rounded: Sequence[str] = ()
) -> None:
    if name in QUERIES:
        raise ValueError(f"Query {name} registered twice")
    QUERIES[name] = Query(build, sql, tuple(rounded))
