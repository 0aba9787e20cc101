"""Scoring of hypothetical orders."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergrain.operators.ranking import exact_medians
from ordergrain.plans.kpis import delivered_orders
from ordergrain.plans.late_risk.features import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES
from ordergrain.plans.late_risk.train import PROBABILITY, score
from ordergrain.session import materialize
from ordergrain.sources.tables import literal_table

# The range each numeric feature of a scenario may take, and whether its default
# is cut to a whole number.
RANGES = {
    "item_count": (1, 20),
    "unique_product_count": (1, 20),
    "seller_count": (1, 10),
    "total_price": (0.0, 10000.0),
    "total_freight": (0.0, 1000.0),
    "avg_product_weight_g": (0.0, 50000.0),
    "avg_product_volume_cm3": (0.0, 1000000.0),
    "avg_distance_km": (0.0, 5000.0),
    "payment_installments": (0, 24),
    "estimated_days": (1.0, 90.0),
    "purchase_month": (1, 12),
    "purchase_weekday": (0, 6),
    "purchase_hour": (0, 23),
}


def _median_defaults(rows: DataFrame) -> dict[str, float | int]:
    medians = exact_medians(rows, NUMERIC_FEATURES)
    return {
        c: int(v) if v is not None and isinstance(RANGES[c][0], int) else v for c, v in medians.items()
    }


def numeric_defaults(orders: DataFrame) -> dict[str, float | int]:
    """Median of every numeric feature over the delivered orders."""
    # Stored once: the search for the medians reads its input several times.
    return _median_defaults(materialize(delivered_orders(orders).select(*NUMERIC_FEATURES)))


def observed_categories(orders: DataFrame) -> DataFrame:
    """``(column, value)`` of the categorical features seen in delivered orders."""
    return (
        delivered_orders(orders)
        .unpivot([], list(CATEGORICAL_FEATURES), "column", "value")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def default_scenario(orders: DataFrame) -> DataFrame:
    """One order with the median of each number and the first value of each category."""
    rows = materialize(delivered_orders(orders).select(*NUMERIC_FEATURES, *CATEGORICAL_FEATURES))
    first = rows.agg(*[F.min(c).alias(c) for c in CATEGORICAL_FEATURES]).first()
    return literal_table(orders.sparkSession, [{**_median_defaults(rows), **first.asDict()}])


def range_violations(scenarios: DataFrame) -> DataFrame:
    """The scenarios with ``violations``, the names of the numbers outside their range."""
    outside = [
        F.when(~F.coalesce(F.col(c).between(low, high), F.lit(False)), F.lit(c))
        for c, (low, high) in RANGES.items()
    ]
    return scenarios.withColumn("violations", F.array_compact(F.array(*outside)))


def valid_scenarios(scenarios: DataFrame) -> DataFrame:
    return range_violations(scenarios).where(F.size("violations") == 0).drop("violations")


def scenario_scores(pipeline: PipelineModel, scenarios: DataFrame) -> DataFrame:
    """Every scenario with its ``violations`` and, if it has none, its probability of lateness."""
    others = [c for c in scenarios.columns if c not in FEATURES]
    scored = score(pipeline, range_violations(scenarios.select(*others, *FEATURES)))
    return scored.withColumn(PROBABILITY, F.when(F.size("violations") == 0, F.col(PROBABILITY)))
