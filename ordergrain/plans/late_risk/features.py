"""Model rows, chronological split and the fitted feature preparation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergrain.operators.primary import value_counts
from ordergrain.operators.ranking import Place, after_key, exact_medians, order_statistics
from ordergrain.plans.kpis import delivered_orders
from ordergrain.plans.late_risk.rare import RareCategories
from ordergrain.session import materialize

# The features known at checkout, and the outcomes that must stay out of them.
NUMERIC_FEATURES = (
    "item_count",
    "unique_product_count",
    "seller_count",
    "total_price",
    "total_freight",
    "avg_product_weight_g",
    "avg_product_volume_cm3",
    "avg_distance_km",
    "payment_installments",
    "estimated_days",
    "purchase_month",
    "purchase_weekday",
    "purchase_hour",
)
CATEGORICAL_FEATURES = (
    "customer_state",
    "primary_category",
    "primary_seller_state",
    "primary_payment_type",
)
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES
OUTCOMES = (
    "is_late",
    "late_days",
    "delivery_days",
    "review_score",
    "order_delivered_customer_date",
)
# Rows a category needs for a slot of its own, and the name of the shared slot.
MIN_CATEGORY_ROWS = 20
INFREQUENT = "infrequent_sklearn"

LABEL = "is_late"
KEYS = ("order_id", "order_purchase_timestamp")
MODEL_COLUMNS = KEYS + ("order_status", LABEL) + FEATURES


def check_features(features: Sequence[str], columns: Sequence[str]) -> None:
    """Refuse outcome columns and features that the table does not have."""
    leaks = sorted(set(features) & set(OUTCOMES))
    if leaks:
        raise ValueError(f"Outcome columns used as features: {leaks}")
    absent = [name for name in features if name not in columns]
    if absent:
        raise ValueError(f"Features missing from the table: {absent}")


def model_rows(orders: DataFrame) -> DataFrame:
    """Delivered orders with a label and a purchase time, keys, label and features only."""
    check_features(FEATURES, orders.columns)
    return (
        delivered_orders(orders)
        .dropna(subset=[LABEL, "order_purchase_timestamp"])
        .select(*KEYS, F.col(LABEL).cast("int").alias(LABEL), *FEATURES)
    )


def chronological_split(
    rows: DataFrame, train_share: float = 0.80, fit_share: float = 0.80
) -> DataFrame:
    """Add ``split``: ``fit``, then ``validation``, then ``test``, by purchase time.

    Orders of the same instant go by order id. Only the first row of each later slice is
    searched for; labelling the rows is a comparison and moves none of them.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(KEYS[1]))
    timed = rows.select(micros.alias("micros"), "order_id")

    def starts(total: int) -> list[int]:
        train = int(total * train_share)
        return [p for p in (int(train * fit_share), train) if p > 0]

    total = rows.count()
    found = order_statistics(timed, {"micros": starts}, "order_id")
    train = int(total * train_share)
    fit = int(train * fit_share)

    def from_position(position: int):
        if position == 0:
            return F.lit(True)
        if position >= total:
            return F.lit(False)
        value, tie = found[Place("micros", position)]
        return ~after_key(F.lit(int(value)), F.lit(tie), (micros, F.col("order_id")))

    return rows.withColumn(
        "split",
        F.when(from_position(train), "test").when(from_position(fit), "validation").otherwise("fit"),
    )


@dataclass(frozen=True)
class FeatureStatistics:
    """What the preparation learns from the rows it is fitted on.

    Only categories with a slot of their own are held here; the rare ones, of which there may be as
    many as rows, stay in the table ``rare`` (``column``, ``value``).
    """

    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    most_frequent: dict[str, str]
    frequent: dict[str, list[str]]
    with_rare: tuple[str, ...]
    rare: DataFrame = field(compare=False)


def numeric_moments(rows: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Mean and population deviation of each numeric feature after median imputation."""
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c])) for c in medians}
    return rows.agg(
        *[F.avg(v).alias(f"{c}_mean") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"{c}_std") for c, v in filled.items()],
    )


def imputed_value_counts(rows: DataFrame) -> DataFrame:
    """``(column, value, n)`` of the categorical features, nulls added to the top value."""
    counts = value_counts(rows, list(CATEGORICAL_FEATURES))
    # One row per feature and category, which also is the width of the model.
    known = counts.where(F.col("value").isNotNull())
    top = known.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top_value")
    )
    return (
        counts.join(top, "column")
        .select("column", F.coalesce("value", "top_value").alias("value"), "n")
        .groupBy("column", "value")
        .agg(F.sum("n").alias("n"))
    )


def category_slots(rows: DataFrame) -> DataFrame:
    """``(column, value, n, slot)``: a category's own slot, or the shared one when it is rare."""
    return imputed_value_counts(rows).withColumn(
        "slot", F.when(F.col("n") >= MIN_CATEGORY_ROWS, F.col("value")).otherwise(INFREQUENT)
    )


def learn_statistics(rows: DataFrame) -> FeatureStatistics:
    medians = {c: v if v is not None else 0.0 for c, v in exact_medians(rows, NUMERIC_FEATURES).items()}
    moments = numeric_moments(rows, medians).first()
    slots = materialize(category_slots(rows))
    own = slots.where(F.col("n") >= MIN_CATEGORY_ROWS)
    rare = slots.where(F.col("n") < MIN_CATEGORY_ROWS).select("column", "value")
    frequent: dict[str, list[str]] = {c: [] for c in CATEGORICAL_FEATURES}
    for row in own.select("column", "value").collect():  # as many rows as the model has category inputs
        frequent[row["column"]].append(row["value"])
    top = F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top")
    by_column = slots.groupBy("column").agg(top, F.min("n").alias("least")).collect()  # one row per feature
    return FeatureStatistics(
        medians=medians,
        means={c: moments[f"{c}_mean"] for c in NUMERIC_FEATURES},
        scales={c: moments[f"{c}_std"] or 1.0 for c in NUMERIC_FEATURES},
        most_frequent={row["column"]: row["top"] for row in by_column},
        frequent={c: sorted(values) for c, values in frequent.items()},
        with_rare=tuple(sorted(row["column"] for row in by_column if row["least"] < MIN_CATEGORY_ROWS)),
        rare=rare,
    )


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _prepare_sql(learned: FeatureStatistics) -> str:
    parts = ["*"]
    for c in NUMERIC_FEATURES:
        parts.append(
            f"(coalesce(CAST({c} AS DOUBLE), {learned.medians[c]!r}D) - {learned.means[c]!r}D)"
            f" / {learned.scales[c]!r}D AS numeric__{c}"
        )
    for c in CATEGORICAL_FEATURES:
        top = learned.most_frequent.get(c)
        value = f"coalesce({c}, {_literal(top)})" if top is not None else c
        if c in learned.with_rare:
            value = f"IF({RareCategories.mark(c)}, {_literal(INFREQUENT)}, {value})"
        parts.append(f"{value} AS slot__{c}")
    return f"SELECT {', '.join(parts)} FROM __THIS__"


def slot_labels(learned: FeatureStatistics) -> dict[str, list[str]]:
    """One-hot slots per categorical feature: own slots in order, the shared slot last."""
    return {
        c: learned.frequent[c] + ([INFREQUENT] if c in learned.with_rare else [])
        for c in CATEGORICAL_FEATURES
    }


def feature_names(learned: FeatureStatistics) -> list[str]:
    """Names of the assembled vector's positions."""
    names = [f"numeric__{c}" for c in NUMERIC_FEATURES]
    for c, labels in slot_labels(learned).items():
        names.extend(f"categorical__{c}_{label}" for label in labels)
    return names


def preparation_stages(rows: DataFrame, learned: FeatureStatistics) -> list[Transformer]:
    """Fitted stages from raw features to the ``features`` vector.

    A value unseen when fitting gets no slot. The pipeline they are part of can be saved and loaded; the
    rare categories are a table beside it.
    """
    used = {c: labels for c, labels in slot_labels(learned).items() if labels}
    prepare = SQLTransformer(statement=_prepare_sql(learned))
    fallbacks = {c: learned.most_frequent[c] for c in learned.with_rare}
    marking = [RareCategories(learned.rare, fallbacks)] if fallbacks else []
    indexers = [
        StringIndexerModel.from_labels(
            labels, inputCol=f"slot__{c}", outputCol=f"index__{c}", handleInvalid="keep"
        )
        for c, labels in used.items()
    ]
    # The labels are in the column metadata, so fitting the encoder reads no rows.
    encode: OneHotEncoderModel = OneHotEncoder(
        inputCols=[f"index__{c}" for c in used],
        outputCols=[f"onehot__{c}" for c in used],
        dropLast=True,
    ).fit(PipelineModel([*marking, prepare, *indexers]).transform(rows.limit(0)))
    assemble = VectorAssembler(
        inputCols=[f"numeric__{c}" for c in NUMERIC_FEATURES] + [f"onehot__{c}" for c in used],
        outputCol="features",
    )
    return [*marking, prepare, *indexers, encode, assemble]
