"""The executive summary as a one-row table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergrain.functions import scalar
from ordergrain.plans.kpis import (
    category_performance,
    mean_review_by_lateness,
    overall_kpis,
    purchase_span,
    state_performance,
)
from ordergrain.plans.rfm import repeat_rate


def leader(summary: DataFrame, key: str) -> DataFrame:
    """The row with the highest revenue, the lowest key on a tie."""
    return summary.agg(
        F.min_by(F.struct(key, "revenue", "orders"), F.struct(-F.col("revenue"), F.col(key))).alias("top")
    ).select("top.*")


def executive_summary(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Headline numbers as report text. Pass stored tables: each is read more than once."""
    category = leader(category_performance(orders), "primary_category").select(
        F.struct("*").alias("category")
    )
    state = leader(state_performance(orders), "customer_state").select(F.struct("*").alias("state"))
    span = purchase_span(orders).select(F.struct("*").alias("span"))
    review = mean_review_by_lateness(orders).select(F.struct("*").alias("review"))
    return (
        overall_kpis(orders)
        .withColumns(
            {
                "span": span.scalar(),
                "review": review.scalar(),
                "category": category.scalar(),
                "state": state.scalar(),
                "repeat_rate": repeat_rate(customers).scalar(),
            }
        )
        .select(
            F.date_format("span.first_purchase", "yyyy-MM-dd").alias("period_start"),
            F.date_format("span.last_purchase", "yyyy-MM-dd").alias("period_end"),
            scalar.count_text(F.col("orders")).alias("total_orders"),
            scalar.count_text(F.col("delivered_orders")).alias("delivered_orders"),
            scalar.money_text(F.col("revenue")).alias("revenue"),
            scalar.money_text(F.col("avg_order_value"), 2).alias("average_order_value"),
            scalar.percent_text(F.col("late_rate")).alias("late_rate"),
            scalar.percent_text(F.col("repeat_rate")).alias("repeat_rate"),
            scalar.number_text(F.col("review.on_time_review"), 2).alias("on_time_review"),
            scalar.number_text(F.col("review.late_review"), 2).alias("late_review"),
            F.col("category.primary_category").alias("top_category"),
            scalar.money_text(F.col("category.revenue")).alias("top_category_revenue"),
            scalar.count_text(F.col("category.orders")).alias("top_category_orders"),
            F.col("state.customer_state").alias("top_state"),
            scalar.money_text(F.col("state.revenue")).alias("top_state_revenue"),
            scalar.count_text(F.col("state.orders")).alias("top_state_orders"),
        )
    )


def model_summary(metrics: DataFrame) -> DataFrame:
    """The model's test results as report text, from the metrics record."""
    return metrics.select(
        scalar.title_text(F.col("selected_model")).alias("selected_model"),
        scalar.count_text(F.col("test_rows")).alias("test_rows"),
        *[
            scalar.number_text(F.col(f"test.{name}"), 3).alias(name)
            for name in ("pr_auc", "roc_auc", "precision", "recall", "f1")
        ],
        scalar.number_text(F.col("selected_threshold"), 2).alias("threshold"),
    )
