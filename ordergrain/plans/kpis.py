"""KPI tables over the enriched orders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordergrain.functions import scalar
from ordergrain.functions.aggregates import avg_where, money_sum, money_sum_or_zero, order_measures


def delivered_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == "delivered")


def _summary(orders: DataFrame, key: str, measures: Sequence[str], one_row_per_order: bool) -> DataFrame:
    return (
        delivered_orders(orders)
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*order_measures(*measures, one_row_per_order=one_row_per_order))
    )


def monthly_kpis(orders: DataFrame, *, one_row_per_order: bool = False) -> DataFrame:
    measures = ["orders", "revenue", "avg_order_value", "late_rate", "avg_review_score"]
    return _summary(orders, "purchase_year_month", measures, one_row_per_order)


def category_performance(orders: DataFrame, *, one_row_per_order: bool = False) -> DataFrame:
    """By primary category; orders without one are left out."""
    measures = ["orders", "revenue", "avg_order_value", "late_rate", "avg_review_score"]
    return _summary(orders, "primary_category", measures, one_row_per_order)


def state_performance(orders: DataFrame, *, one_row_per_order: bool = False) -> DataFrame:
    measures = ["orders", "revenue", "late_rate", "avg_delivery_days", "avg_review_score"]
    return _summary(orders, "customer_state", measures, one_row_per_order)


def by_revenue(summary: DataFrame, key: str) -> DataFrame:
    """Highest revenue first; equal revenues by key."""
    return summary.orderBy(F.desc("revenue"), F.asc(key))


def category_risk(orders: DataFrame, min_orders: int = 500) -> DataFrame:
    """Scale against lateness for categories with enough orders."""
    return _summary(orders, "primary_category", ["orders", "revenue", "late_rate"], False).where(
        F.col("orders") >= min_orders
    )


def per_order(orders: DataFrame, *values: str) -> DataFrame:
    """One row per order id: ``delivered``, and sum and count of values of delivered rows.

    Two distinct counts in one aggregate would copy and shuffle every row; counting rows of this
    table instead reuses the partitioning by order id that the joins left behind.
    """
    delivered = F.col("order_status") == "delivered"
    measures = [F.max(delivered).alias("delivered")]
    for name in values:
        value = F.when(delivered, F.col(name))
        measures += [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_count")]
    return orders.groupBy("order_id").agg(*measures)


def order_counts() -> list[Column]:
    """Aggregates over :func:`per_order` rows: all orders and the delivered ones."""
    order_id = F.col("order_id")
    return [
        F.count(order_id).alias("orders"),
        F.count(F.when(F.col("delivered"), order_id)).alias("delivered_orders"),
    ]


def mean_of(name: str) -> Column:
    """Aggregate over :func:`per_order` rows: mean of a value of the delivered orders."""
    return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_count"))


def overall_kpis(orders: DataFrame) -> DataFrame:
    """One row over all orders, most of it about the delivered ones."""
    paid = F.col("total_payment_sum")
    return per_order(orders, "total_payment", "is_late", "review_score").agg(
        *order_counts(),
        money_sum_or_zero(paid).alias("revenue"),
        F.try_divide(money_sum(paid), F.sum("total_payment_count")).alias("avg_order_value"),
        mean_of("is_late").alias("late_rate"),
        mean_of("review_score").alias("avg_review_score"),
    )


def as_metric_rows(one_row: DataFrame) -> DataFrame:
    """Turn a row of numbers into rows ``(metric, value)``."""
    values = one_row.select([F.col(c).cast("double").alias(c) for c in one_row.columns])
    return values.unpivot([], values.columns, "metric", "value")


def review_by_delivery(orders: DataFrame, null_policy: str = "on_time") -> DataFrame:
    """Orders and mean review by delivery result.

    An unknown late flag counts as ``on_time``, forms a ``null`` group, or is left out (``drop``).
    """
    rows = delivered_orders(orders)
    if null_policy == "drop":
        rows = rows.where(F.col("is_late").isNotNull())
        null_policy = "null"
    return (
        rows.withColumn("delivery_result", scalar.delivery_result(F.col("is_late"), null_policy))
        .groupBy("delivery_result")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.avg("review_score").alias("average_review"),
        )
    )


def mean_review_by_lateness(orders: DataFrame) -> DataFrame:
    """Mean review of on-time and of late orders, side by side from one pass."""
    score, late = F.col("review_score"), F.col("is_late")
    return delivered_orders(orders).agg(
        avg_where(score, late == 0).alias("on_time_review"),
        avg_where(score, late == 1).alias("late_review"),
    )


def filtered_orders(
    orders: DataFrame,
    states: Sequence[str] | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Delivered orders of some states and of an inclusive span of purchase dates.

    The dates apply only when both are given. They are compared as timestamps, so the condition
    reaches the Parquet scan.
    """
    rows = delivered_orders(orders)
    if states is not None:
        rows = rows.where(F.col("customer_state").isin(*states))
    if start is not None and end is not None:
        bought = F.col("order_purchase_timestamp")
        first = F.lit(start.isoformat()).cast("timestamp_ntz")
        beyond = F.lit((end + timedelta(days=1)).isoformat()).cast("timestamp_ntz")
        rows = rows.where((bought >= first) & (bought < beyond))
    return rows


def kpi_cards(orders: DataFrame) -> DataFrame:
    return orders.agg(*order_measures("orders", "revenue", "avg_order_value", "late_rate"))


def monthly_trend(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("purchase_year_month").isNotNull())
        .groupBy("purchase_year_month")
        .agg(*order_measures("orders", "revenue", "late_rate"))
    )


def category_revenue(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("primary_category").isNotNull())
        .groupBy("primary_category")
        .agg(money_sum_or_zero(F.col("total_payment")).alias("total_payment"))
    )


def top_categories(orders: DataFrame, count: int = 12) -> DataFrame:
    """The categories with the highest revenue, lowest of them first."""
    largest = category_revenue(orders).orderBy(F.desc("total_payment"), F.asc("primary_category")).limit(count)
    return largest.orderBy(F.asc("total_payment"), F.desc("primary_category"))


def state_operations(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("customer_state").isNotNull())
        .groupBy("customer_state")
        .agg(*order_measures("orders", "late_rate"), F.avg("delivery_days").alias("delivery_days"))
        .withColumn("late_rate_pct", scalar.percent(F.col("late_rate")))
    )


def review_distribution(orders: DataFrame) -> DataFrame:
    """Percent of each delivery result's reviewed orders by review score, in bins of one point.

    Bin ``k`` covers mean scores from ``k - 0.5`` up to but not including ``k + 0.5``.
    """
    binned = (
        orders.where(F.col("review_score").isNotNull())
        .select(
            scalar.delivery_result(F.col("is_late"), "null").alias("delivery_result"),
            F.floor(F.col("review_score") + 0.5).cast("int").alias("score_bin"),
        )
        .groupBy("delivery_result", "score_bin")
        .agg(F.count("*").alias("orders"))
    )
    # At most three results with five bins each are left for the window.
    whole = F.sum("orders").over(Window.partitionBy("delivery_result"))
    return binned.withColumn("percent", scalar.percent(F.col("orders")) / whole)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def purchase_span(orders: DataFrame) -> DataFrame:
    bought = F.col("order_purchase_timestamp")
    return orders.agg(F.min(bought).alias("first_purchase"), F.max(bought).alias("last_purchase"))
