"""Monthly cohort retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordergrain.functions import scalar
from ordergrain.plans.kpis import delivered_orders


def active_months(orders: DataFrame) -> DataFrame:
    """Each customer's purchase months, once, with the first of them as ``cohort_month``.

    The orders are reduced to one row per customer and month before the window, so a customer
    with very many orders brings no more rows than there are months.
    """
    months = (
        delivered_orders(orders)
        .select(
            "customer_unique_id",
            F.to_date(F.date_trunc("month", "order_purchase_timestamp")).alias("order_month"),
        )
        .dropna()
        .distinct()
    )
    first = F.min("order_month").over(Window.partitionBy("customer_unique_id"))
    return months.withColumn("cohort_month", first)


def cohort_counts(orders: DataFrame) -> DataFrame:
    """Customers by cohort and months since; months without customers have no row."""
    return (
        active_months(orders)
        .select(
            "cohort_month",
            scalar.months_between_months(F.col("cohort_month"), F.col("order_month")).alias("cohort_index"),
        )
        .groupBy("cohort_month", "cohort_index")
        .agg(F.count("*").alias("customers"))
        .withColumn("cohort_month", scalar.year_month(F.col("cohort_month")))
    )


def cohort_retention(orders: DataFrame) -> DataFrame:
    counts = cohort_counts(orders)
    size = F.max(F.when(F.col("cohort_index") == 0, F.col("customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return counts.withColumn("cohort_size", size).withColumn(
        "retention_rate", scalar.safe_ratio(F.col("customers"), F.col("cohort_size"))
    )
