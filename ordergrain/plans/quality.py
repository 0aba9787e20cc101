"""Data-quality profile of the source tables and the enriched orders."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordergrain.plans.kpis import mean_of, order_counts, per_order, purchase_span
from ordergrain.sources.tables import UNREADABLE

PROFILE = ("rows", "columns", "duplicate_rows", "missing_cells", "unreadable_cells")


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != UNREADABLE]


def table_size(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, null cells and unreadable ones, from one scan whose rows do not move.

    Unreadable are cells that held text which is no value of their type; the reader counts them per row
    when asked to. They are among the null cells.
    """
    columns = _data_columns(df)
    empty = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("bigint") for c in columns])
    unreadable = F.col(UNREADABLE).cast("bigint") if UNREADABLE in df.columns else F.lit(0).cast("bigint")
    return df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(empty), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum(unreadable), F.lit(0)).alias("unreadable_cells"),
    ).select(F.lit(name).alias("table"), "rows", F.lit(len(columns)).alias("columns"), "missing_cells", "unreadable_cells")


def row_digest(columns: Sequence[str], words: int = 4) -> list[Column]:
    """``words`` 64-bit hashes of a row, each with a start of its own; nulls count by their place."""
    nulls = F.array(*[F.col(f"`{c}`").isNull() for c in columns])
    cells = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(F.lit(k), nulls, *cells).alias(f"__digest{k}") for k in range(words)]


def duplicate_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows beyond the first of equal ones.

    Rows are compared by a digest of 256 bits, so no data column is shuffled; equal rows collapse before the
    shuffle, so any number of copies of one row is cheap.
    """
    digest = row_digest(_data_columns(df))
    copies = df.select(*digest).groupBy(*[f"__digest{k}" for k in range(len(digest))]).agg(F.count("*").alias("__copies"))
    beyond = F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0)).alias("duplicate_rows")
    return copies.agg(beyond).select(F.lit(name).alias("table"), "duplicate_rows")


def _of_all(profile: Callable[[DataFrame, str], DataFrame], tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile(df, name) for name, df in tables.items()])


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _of_all(table_size, tables)


def table_duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _of_all(duplicate_rows, tables)


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns, rows beyond the first of equal ones, null and unreadable cells of one table."""
    return table_profiles({name: df})


def table_profiles(tables: Mapping[str, DataFrame]) -> DataFrame:
    both = table_sizes(tables).join(table_duplicates(tables), "table")  # one row per table
    return both.select("table", *PROFILE)


def order_profile(orders: DataFrame) -> DataFrame:
    span = purchase_span(orders).select(F.struct("*").alias("span")).scalar()
    return (
        per_order(orders, "is_late")
        .agg(*order_counts(), mean_of("is_late").alias("late_rate"))
        .withColumn("span", span)
        .select(
            F.col("orders").alias("orders_total"),
            "delivered_orders",
            "late_rate",
            F.date_format("span.first_purchase", "yyyy-MM-dd HH:mm:ss").alias("date_min"),
            F.date_format("span.last_purchase", "yyyy-MM-dd HH:mm:ss").alias("date_max"),
        )
    )


def quality_report(tables: Mapping[str, DataFrame], orders: DataFrame) -> DataFrame:
    """One record: the order totals and a map from table name to its profile."""
    per_table = table_profiles(tables).agg(
        F.map_from_entries(
            F.collect_list(F.struct("table", F.struct(*PROFILE)))
        ).alias("tables")
    )
    return order_profile(orders).select(per_table.scalar().alias("tables"), "*")


def quality_rows(report: DataFrame) -> DataFrame:
    """The record as one row per table, with the order totals on each."""
    totals = [c for c in report.columns if c != "tables"]
    each = report.select(F.explode("tables").alias("table", "profile"), *totals)
    return each.select("table", *[F.col(f"profile.{c}") for c in PROFILE], *totals)
