"""Late-delivery model: data operators, metrics and trained products (M, W5, O6, F23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ordergrain.catalog.registry import register
from ordergrain.plans.late_risk import features, metrics, scenario, train
from ordergrain.plans.report import model_summary
from ordergrain.session import materialize
from ordergrain.sources.tables import literal_table


def _rows(i):
    return materialize(features.model_rows(i.orders(*features.MODEL_COLUMNS)))


def _split(i):
    return features.chronological_split(_rows(i))


def _fit_rows(i):
    return _split(i).where("split = 'fit'").drop("split")


# Rows of d that can be modelled, their place in time and their slice.
_ROWS_SQL = """WITH placed AS (
    SELECT *, row_number() OVER (ORDER BY order_purchase_timestamp, order_id) - 1 AS place,
           count(*) OVER () AS n
    FROM d WHERE is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL
), cut AS (
    SELECT *, CAST(floor(n * 0.8e0) AS BIGINT) AS train_rows FROM placed
), sliced AS (
    SELECT *, CASE WHEN place >= train_rows THEN 'test'
                   WHEN place >= CAST(floor(train_rows * 0.8e0) AS BIGINT) THEN 'validation'
                   ELSE 'fit' END AS split
    FROM cut
), fit AS (
    SELECT * FROM sliced WHERE split = 'fit'
)"""
register(
    "m2_chronological_split",
    lambda i: _split(i).select("order_id", "is_late", "split"),
    _ROWS_SQL + "\nSELECT order_id, is_late, split FROM sliced",
)
register(
    "w5_position_split",
    lambda i: _split(i).groupBy("split").agg(
        F.count("*").alias("orders"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
    ),
    _ROWS_SQL + "\nSELECT split, count(*) AS orders, min(order_purchase_timestamp) AS first_purchase,"
    " max(order_purchase_timestamp) AS last_purchase FROM sliced GROUP BY 1",
)

# --- feature preparation ---------------------------------------------------------------------


def _medians(i):
    return features.exact_medians(_fit_rows(i), features.NUMERIC_FEATURES)


register(
    "m3_imputation_medians",
    lambda i: literal_table(i.spark, [_medians(i)]),
    _ROWS_SQL + "\nSELECT " + ", ".join(f"CAST(median({c}) AS DOUBLE) AS {c}" for c in features.NUMERIC_FEATURES)
    + " FROM fit",
    rounded=features.NUMERIC_FEATURES,
)


def _moments(i):
    rows = _fit_rows(i)
    medians = features.exact_medians(rows, features.NUMERIC_FEATURES)
    return features.numeric_moments(rows, medians)


_MEDIANS_SQL = ", meds AS (SELECT " + ", ".join(
    f"median({c}) AS med_{c}" for c in features.NUMERIC_FEATURES
) + " FROM fit)"
register(
    "m4_standardization",
    _moments,
    _ROWS_SQL + _MEDIANS_SQL + "\nSELECT "
    + ", ".join(
        f"avg(coalesce({c}, med_{c})) AS {c}_mean, stddev_pop(coalesce({c}, med_{c})) AS {c}_std"
        for c in features.NUMERIC_FEATURES
    )
    + " FROM fit, meds",
    rounded=[f"{c}_{part}" for c in features.NUMERIC_FEATURES for part in ("mean", "std")],
)
_CATEGORY_SQL = (
    ", long AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value FROM fit" for c in features.CATEGORICAL_FEATURES)
    + """), known AS (
    SELECT "column", value, row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) AS place
    FROM long WHERE value IS NOT NULL GROUP BY "column", value
), filled AS (
    SELECT long."column", coalesce(long.value, known.value) AS value
    FROM long JOIN known ON known."column" = long."column" AND known.place = 1
), counted AS (
    SELECT "column", value, count(*) AS n FROM filled GROUP BY "column", value
)
"""
)
register(
    "m5_most_frequent",
    lambda i: features.imputed_value_counts(_fit_rows(i)).groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value")
    ),
    _ROWS_SQL + _CATEGORY_SQL + 'SELECT "column", value FROM known WHERE place = 1',
)
register(
    "m6_category_slots",
    lambda i: features.category_slots(_fit_rows(i)),
    _ROWS_SQL + _CATEGORY_SQL + f"""SELECT "column", value, n,
    CASE WHEN n >= {features.MIN_CATEGORY_ROWS} THEN value ELSE '{features.INFREQUENT}' END AS slot FROM counted""",
)


def _vectors(i):
    rows = _fit_rows(i)
    stages = features.preparation_stages(rows, features.learn_statistics(rows))
    prepared = train.PipelineModel(stages).transform(rows)
    values = train.vector_to_array("features")
    return prepared.select(
        "order_id",
        F.size(values).alias("width"),
        F.aggregate(F.slice(values, len(features.NUMERIC_FEATURES) + 1, F.size(values)), F.lit(0.0), lambda a, b: a + b)
        .cast("int")
        .alias("slots_set"),
        values[0].alias("item_count_scaled"),
    )


register(
    "m7_feature_vectors",
    _vectors,
    _ROWS_SQL + _MEDIANS_SQL + _CATEGORY_SQL.rstrip() + f""", slots AS (
    SELECT DISTINCT "column", CASE WHEN n >= {features.MIN_CATEGORY_ROWS} THEN value
                                   ELSE '{features.INFREQUENT}' END AS slot FROM counted
), moments AS (
    SELECT avg(coalesce(item_count, med_item_count)) AS mean, stddev_pop(coalesce(item_count, med_item_count)) AS std
    FROM fit, meds
)
SELECT order_id, CAST({len(features.NUMERIC_FEATURES)} + (SELECT count(*) FROM slots) AS INT) AS width,
       CAST(4 AS INT) AS slots_set,
       (coalesce(item_count, med_item_count) - mean) / std AS item_count_scaled
FROM fit, meds, moments""",
    rounded=("item_count_scaled",),
)
register(
    "m8_class_weights",
    lambda i: train.class_weights(_fit_rows(i)),
    _ROWS_SQL + "\nSELECT is_late, count(*) AS n, (SELECT count(*) FROM fit) / CAST(2 * count(*) AS DOUBLE) AS weight"
    " FROM fit GROUP BY 1",
)

# --- metrics over two deterministic scores: one with many ties, one nearly unique -----------------
_COARSE = "(order_id * 7919 + purchase_hour * 31) % 97 / 97.0{e}"
_FINE = "(order_id * 104729 + purchase_hour * 31) % 1000003 / 1000003.0{e}"


def _scored(i):
    rows = features.model_rows(i.orders(*features.MODEL_COLUMNS))
    return rows.select(
        "order_id",
        "is_late",
        F.expr(_COARSE.format(e="D")).alias("coarse"),
        F.expr(_FINE.format(e="D")).alias("fine"),
    )


_SCORED_SQL = f"""WITH scored AS (
    SELECT order_id, is_late, {_COARSE.format(e="e0")} AS coarse, {_FINE.format(e="e0")} AS fine
    FROM d WHERE is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL
)"""


def _ranking_sql(source, score, name):
    return f""", {name}_groups AS (
    SELECT {score} AS score, CAST(sum(is_late) AS BIGINT) AS late, count(*) AS n FROM {source} GROUP BY 1
), {name}_sums AS (
    SELECT *, sum(late) OVER (ORDER BY score DESC) AS late_from, sum(n) OVER (ORDER BY score DESC) AS n_from,
           sum(late) OVER () AS all_late, sum(n) OVER () AS all_n FROM {name}_groups
), {name} AS (
    SELECT coalesce(sum(late * CAST(late_from AS DOUBLE) / n_from) / max(all_late), 0) AS pr_auc,
           sum(late * (CAST(all_n - all_late - (n_from - late_from) AS DOUBLE) + (n - late) / 2e0))
               / (CAST(max(all_late) AS DOUBLE) * max(all_n - all_late)) AS roc_auc
    FROM {name}_sums
)"""


def _threshold_sql(source, score, threshold, name):
    return f""", {name}_counts AS (
    SELECT CAST(sum(CASE WHEN {score} >= {threshold} THEN is_late ELSE 0 END) AS DOUBLE) AS hits,
           CAST(sum(CASE WHEN {score} >= {threshold} THEN 1 ELSE 0 END) AS DOUBLE) AS predicted,
           CAST(sum(is_late) AS DOUBLE) AS late FROM {source}
), {name} AS (
    SELECT coalesce(hits / nullif(predicted, 0), 0) AS precision, coalesce(hits / nullif(late, 0), 0) AS recall,
           coalesce(2 * hits / nullif(predicted + late, 0), 0) AS f1 FROM {name}_counts
)"""


for _score in ("coarse", "fine"):
    register(
        f"m13_average_precision_{_score}",
        lambda i, score=_score: metrics.ranking_metrics(_scored(i), "is_late", score).select("pr_auc"),
        _SCORED_SQL + _ranking_sql("scored", _score, "ranked") + "\nSELECT pr_auc FROM ranked",
        rounded=("pr_auc",),
    )
    register(
        f"m14_roc_auc_{_score}",
        lambda i, score=_score: metrics.ranking_metrics(_scored(i), "is_late", score).select("roc_auc"),
        _SCORED_SQL + _ranking_sql("scored", _score, "ranked") + "\nSELECT roc_auc FROM ranked",
        rounded=("roc_auc",),
    )
register(
    "m15_threshold_metrics",
    lambda i: metrics.threshold_metrics(_scored(i), "is_late", "fine", 0.62),
    _SCORED_SQL + _threshold_sql("scored", "fine", "0.62e0", "chosen") + "\nSELECT * FROM chosen",
)
_SWEEP_SQL = """, sweep AS (
    SELECT 0.05e0 + i * 0.01e0 AS threshold,
           coalesce(CAST(2 * sum(CASE WHEN fine >= 0.05e0 + i * 0.01e0 THEN is_late ELSE 0 END) AS DOUBLE)
               / nullif(sum(CASE WHEN fine >= 0.05e0 + i * 0.01e0 THEN 1 ELSE 0 END) + sum(is_late), 0), 0) AS f1
    FROM scored, (SELECT unnest(range(76)) AS i) GROUP BY i
)"""
register(
    "m16_threshold_sweep",
    lambda i: metrics.threshold_sweep(_scored(i), "is_late", "fine"),
    _SCORED_SQL + _SWEEP_SQL + "\nSELECT threshold, f1 FROM sweep",
)
register(
    "m16_best_threshold",
    lambda i: metrics.best_threshold(_scored(i), "is_late", "fine"),
    _SCORED_SQL + _SWEEP_SQL + "\nSELECT threshold, f1 FROM sweep ORDER BY f1 DESC, threshold LIMIT 1",
)


def _chosen(i):
    scored = _scored(i)
    results = None
    for name in ("dummy", "coarse", "fine"):
        column = F.lit(0.5) if name == "dummy" else F.col(name)
        row = (
            metrics.ranking_metrics(scored.withColumn("score", column), "is_late", "score")
            .select(F.lit(name).alias("model"), "pr_auc", F.lit(0.5).alias("threshold"))
        )
        results = row if results is None else results.unionByName(row)
    return metrics.choose_model(results, ("coarse", "fine"))


register(
    "m17_chosen_model",
    _chosen,
    _SCORED_SQL + _ranking_sql("scored", "coarse", "by_coarse") + _ranking_sql("scored", "fine", "by_fine")
    + "\nSELECT CASE WHEN f.pr_auc > c.pr_auc THEN 'fine' ELSE 'coarse' END AS model,"
    " greatest(c.pr_auc, f.pr_auc) AS pr_auc, 0.5e0 AS threshold FROM by_coarse c, by_fine f",
    rounded=("pr_auc",),
)


def _baseline(i):
    split = _split(i)
    scored = train.baseline_scores(split.where("split = 'fit'"), split.where("split = 'validation'"))
    return metrics.evaluate(scored, "is_late", train.PROBABILITY, train.BASELINE_THRESHOLD)


register(
    "m9_baseline_metrics",
    _baseline,
    _ROWS_SQL + """, base AS (
    SELECT is_late, (SELECT avg(is_late) FROM fit) AS score FROM sliced WHERE split = 'validation'
)"""
    + _ranking_sql("base", "score", "ranked") + _threshold_sql("base", "score", "0.5e0", "chosen")
    + "\nSELECT pr_auc, roc_auc, precision, recall, f1 FROM ranked, chosen",
    rounded=("pr_auc",),
)

# --- trained products: every query trains on the tables as they are -----------------------------------


_RUNS: dict[tuple[str, str], train.TrainingRun] = {}


def _run(i):
    """The training run of a folder, once per application: all its products come from one run."""
    key = (i.spark.sparkContext.applicationId, i.folder)
    if key not in _RUNS:
        _RUNS[key] = train.train_late_risk(i.orders(*features.MODEL_COLUMNS))
    return _RUNS[key]


def _coefficients(i):
    rows = _fit_rows(i)
    fitted = train.fit_model(rows, "logistic_regression")
    return train.feature_importance(fitted, count=None)


register("m10_logistic_regression", _coefficients)
register(
    "m11_random_forest",
    lambda i: train.feature_importance(train.fit_model(_fit_rows(i), "random_forest"), count=None),
)


def _bootstraps(i):
    """Of every tree: the rows to draw from, whether it drew about as many, and whether both classes weigh the same."""
    rows = materialize(_fit_rows(i).select("is_late", F.xxhash64(*features.KEYS).alias("row")))
    drawn = train.drawn_rows(rows, train.FOREST_TREES).groupBy("tree", "is_late", "times").agg(F.count("*").alias("n"))
    # A left join asks nothing of the labels, so that the draws are counted once for both sides.
    drawn = drawn.join(train.bootstrap_weights(rows, train.FOREST_TREES).drop("drawn"), ["tree", "is_late"], "left")
    weight = F.col("n") * F.col("times") * F.col("weight")
    found = drawn.groupBy("tree").agg(
        F.sum(F.col("n") * F.col("times")).alias("drawn"), *(F.sum(F.when(F.col("is_late") == c, weight)).alias(f"w{c}") for c in (0, 1))
    )
    total = rows.agg(F.count("*")).scalar()
    return found.select(
        "tree",
        total.alias("rows"),
        (F.abs(F.col("drawn") - total) <= 6 * F.sqrt(total)).alias("drawn_as_many"),
        (F.greatest(*(F.abs(F.col(w) - F.col("drawn") / 2) for w in ("w0", "w1"))) <= 1e-9 * F.col("drawn")).alias("balanced"),
    )


register(
    "m11_bootstraps",
    _bootstraps,
    _ROWS_SQL + f"""
SELECT CAST(range AS INTEGER) AS tree, (SELECT count(*) FROM fit) AS rows, true AS drawn_as_many, true AS balanced
FROM range({train.FOREST_TREES})""",
)
# The greatest derivative by row at which the regression counts as solved.
GRADIENT_BOUND = 1e-4


def _optimum(i):
    rows = _fit_rows(i)
    return train.optimum(train.fit_model(rows, "logistic_regression"), rows)


register(
    "m10_optimum",
    lambda i: _optimum(i).select(
        "rows",
        (F.col("gradient") <= GRADIENT_BOUND).alias("gradient_is_zero"),
        (F.col("loss") <= F.col("shifted_loss")).alias("loss_is_least"),
    ),
    _ROWS_SQL + "\nSELECT count(*) AS rows, true AS gradient_is_zero, true AS loss_is_least FROM fit",
)
register("m12_predictions", lambda i: _run(i).predictions())
register(
    "m12_predicted_rows",
    lambda i: _run(i).predictions().select(
        *features.KEYS, "is_late", F.col("late_probability").between(0, 1).alias("probable"),
        ((F.col("late_probability") >= _run(i).threshold).cast("int") == F.col("predicted_late")).alias("by_threshold"),
    ),
    _ROWS_SQL + "\nSELECT order_id, order_purchase_timestamp, is_late, true AS probable, true AS by_threshold"
    " FROM sliced WHERE split = 'test'",
)
register("m18_validation_metrics", lambda i: _run(i).validation)


def _baseline_sql(learned, measured):
    """Ranking and threshold metrics when the rows ``measured`` all get the late rate of the rows ``learned``."""
    return (
        _ROWS_SQL + f""", base AS (
    SELECT is_late, (SELECT avg(is_late) FROM sliced WHERE {learned}) AS score FROM sliced WHERE {measured}
)"""
        + _ranking_sql("base", "score", "ranked") + _threshold_sql("base", "score", "0.5e0", "chosen")
    )


register(
    "m18_validated_baseline",
    lambda i: _run(i).validation.where("model = 'dummy'"),
    _baseline_sql("split = 'fit'", "split = 'validation'")
    + "\nSELECT 'dummy' AS model, pr_auc, roc_auc, precision, recall, f1, 0.5e0 AS threshold FROM ranked, chosen",
    rounded=("pr_auc",),
)
register("m19_feature_importance", lambda i: _run(i).importance())
register("o6_top_importances", lambda i: train.top_importances(_run(i).importance()))
register("m20_metrics_record", lambda i: train.metrics_record(_run(i)))
register(
    "m20_slices",
    lambda i: train.metrics_record(_run(i)).select(
        "target", "positive_rate_train", "positive_rate_test", "train_rows", "test_rows", "train_end", "test_start",
        "baseline_test.*", F.array_join("features", ",").alias("features"),
    ),
    _baseline_sql("split <> 'test'", "split = 'test'") + f"""
SELECT '{train.TARGET}' AS target, '{",".join(features.FEATURES)}' AS features, slices.*, ranked.*, chosen.* FROM ranked, chosen, (
    SELECT avg(is_late) FILTER (split <> 'test') AS positive_rate_train, avg(is_late) FILTER (split = 'test') AS positive_rate_test,
           count(*) FILTER (split <> 'test') AS train_rows, count(*) FILTER (split = 'test') AS test_rows,
           strftime(max(order_purchase_timestamp) FILTER (split <> 'test'), '%Y-%m-%d %H:%M:%S') AS train_end,
           strftime(min(order_purchase_timestamp) FILTER (split = 'test'), '%Y-%m-%d %H:%M:%S') AS test_start FROM sliced
) AS slices""",
    rounded=("pr_auc", "positive_rate_train", "positive_rate_test"),
)
register("m20_test_comparison", lambda i: train.comparison_rows(train.metrics_record(_run(i))))
register("f22_model_summary", lambda i: model_summary(train.metrics_record(_run(i))))
register(
    "scenario_scores",
    lambda i: scenario.scenario_scores(_run(i).fitted.pipeline, i.delivered("order_id", *features.FEATURES)),
)

_VIOLATIONS_SQL = ", ".join(
    f"CASE WHEN NOT coalesce({c} BETWEEN {low} AND {high}, false) THEN '{c}' END" for c, (low, high) in scenario.RANGES.items()
)
register(
    "scenario_rows",
    lambda i: scenario.scenario_scores(_run(i).fitted.pipeline, i.delivered("order_id", *features.FEATURES)).select(
        "order_id",
        F.array_join("violations", ",").alias("violations"),
        F.col("late_probability").isNotNull().alias("scored"),
    ),
    f"""SELECT order_id, violations, violations = '' AS scored
    FROM (SELECT order_id, concat_ws(',', {_VIOLATIONS_SQL}) AS violations FROM d)""",
)
