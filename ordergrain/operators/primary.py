"""One representative value per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def most_frequent(value: Column) -> Column:
    """Aggregate: the most frequent non-null value, the smallest on a tie.

    The state per group is one counter per distinct value, merged map-side.
    """
    return F.mode(value, deterministic=True)


def primary_value(df: DataFrame, key: str, value: str, output: str) -> DataFrame:
    """Rows ``(key, output)`` for the keys that have a non-null value."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(key)
        .agg(most_frequent(F.col(value)).alias(output))
    )


def largest_payment_type(kind: Column, amount: Column, sequence: Column) -> Column:
    """Aggregate: type of the largest payment, then lowest sequence, then lowest type."""
    return F.min_by(kind, F.struct(amount.isNull(), -amount, sequence, kind))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows ``(column, value, n)`` over several text columns in one pass."""
    return (
        df.unpivot([], columns, "column", "value")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
