"""Writing all data products from the nine tables, and reading them back for reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ordergrain.plans.cohort import cohort_retention
from ordergrain.plans.enrich import enrich_orders
from ordergrain.plans.kpis import by_revenue, category_performance, monthly_kpis, state_performance
from ordergrain.plans.late_risk.train import metrics_record, save_model, train_late_risk
from ordergrain.plans.quality import quality_report
from ordergrain.plans.rfm import rfm
from ordergrain.sources.sinks import write_enriched, write_record, write_summary
from ordergrain.sources.tables import UNREADABLE, read_derived, read_enriched, read_record


def write_products(tables: Mapping[str, DataFrame], folder: str, spark: SparkSession) -> DataFrame:
    """Write the enriched orders once, then every table computed from the stored copy."""
    data = {name: df.drop(UNREADABLE) for name, df in tables.items()}
    write_enriched(enrich_orders(data), f"{folder}/orders")
    orders = read_enriched(spark, f"{folder}/orders")
    write_summary(monthly_kpis(orders).orderBy("purchase_year_month"), f"{folder}/monthly")
    write_summary(by_revenue(category_performance(orders), "primary_category"), f"{folder}/category")
    write_summary(by_revenue(state_performance(orders), "customer_state"), f"{folder}/state")
    write_summary(cohort_retention(orders).orderBy("cohort_month", "cohort_index"), f"{folder}/cohort")
    write_summary(rfm(orders), f"{folder}/rfm")
    write_record(quality_report(tables, orders), f"{folder}/quality")
    return orders


def write_model_products(orders: DataFrame, folder: str, **forest_options: int) -> None:
    """Train on the enriched orders; write predictions, importances, metrics and the model."""
    run = train_late_risk(orders, **forest_options)
    write_summary(run.predictions(), f"{folder}/predictions")
    write_summary(run.importance(), f"{folder}/importance")
    write_record(metrics_record(run), f"{folder}/metrics")
    save_model(run.fitted.pipeline, f"{folder}/model")


SUMMARIES = ("monthly", "category", "state", "cohort", "rfm", "predictions", "importance")


def read_products(spark: SparkSession, folder: str, *, keep: bool = False) -> dict[str, DataFrame]:
    """The stored products. ``keep`` holds the summaries that are read repeatedly.

    The orders stay in Parquet, where filters and column choice limit what is read.
    """
    products = {name: read_derived(spark, f"{folder}/{name}", name) for name in SUMMARIES}
    if keep:
        products = {name: df.persist(StorageLevel.MEMORY_AND_DISK) for name, df in products.items()}
    products["orders"] = read_enriched(spark, f"{folder}/orders")
    products["metrics"] = read_record(spark, f"{folder}/metrics")
    return products
