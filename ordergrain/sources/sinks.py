"""Writing the enriched table, the summaries and the records."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_enriched(orders: DataFrame, path: str, *, partition_by_month: bool = True) -> None:
    """Parquet, one folder per purchase month so that date filters prune files.

    Rows of one month may come from every task. ``rebalance`` gathers them into files of the
    advisory size and splits a month that is far larger than the others.
    """
    if not partition_by_month:
        orders.write.mode("overwrite").parquet(path)
        return
    (
        orders.hint("rebalance", "purchase_year_month")
        .write.mode("overwrite")
        .partitionBy("purchase_year_month")
        .parquet(path)
    )


def write_summary(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_record(record: DataFrame, path: str) -> None:
    record.write.mode("overwrite").option("ignoreNullFields", False).json(path)
