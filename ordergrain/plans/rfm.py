"""Recency, frequency and monetary value per customer, scored and segmented."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergrain.functions import scalar
from ordergrain.functions.aggregates import money_sum_or_zero, share_where
from ordergrain.operators.ranking import quartile_scores
from ordergrain.plans.kpis import delivered_orders
from ordergrain.session import materialize


def reference_date(orders: DataFrame) -> DataFrame:
    """One value: the midnight after the latest delivered order's purchase."""
    last = F.max("order_purchase_timestamp")
    return delivered_orders(orders).agg(
        F.date_add(F.to_date(last), 1).cast("timestamp_ntz").alias("reference_date")
    )


def rfm_base(orders: DataFrame) -> DataFrame:
    """Per customer: whole days since the last purchase, orders placed, amount paid."""
    as_of = reference_date(orders).scalar()
    return (
        delivered_orders(orders)
        .where(F.col("customer_unique_id").isNotNull())
        .groupBy("customer_unique_id")
        .agg(
            F.max("order_purchase_timestamp").alias("last_purchase"),
            F.count_distinct("order_id").alias("frequency"),
            money_sum_or_zero(F.col("total_payment")).alias("monetary"),
        )
        .select(
            "customer_unique_id",
            scalar.whole_days_between(F.col("last_purchase"), as_of).alias("recency_days"),
            "frequency",
            "monetary",
        )
    )


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quartile scores; equal values rank by customer id."""
    return quartile_scores(
        base,
        {"recency_days": "r_score", "frequency": "f_score", "monetary": "m_score"},
        tie_key="customer_unique_id",
        descending=["recency_days"],
    )


def rfm(orders: DataFrame) -> DataFrame:
    # The scoring reads the customers several times; store them once.
    scored = rfm_scores(materialize(rfm_base(orders)))
    return scored.withColumn("segment", scalar.rfm_segment(F.col("r_score"), F.col("f_score")))


def segment_summary(customers: DataFrame) -> DataFrame:
    return customers.groupBy("segment").agg(
        F.count_distinct("customer_unique_id").alias("customers"),
        money_sum_or_zero(F.col("monetary")).alias("monetary"),
        F.avg("recency_days").alias("avg_recency"),
    )


def repeat_rate(customers: DataFrame) -> DataFrame:
    return customers.agg(share_where(F.col("frequency") > 1).alias("repeat_rate"))
