"""Exact classification metrics as DataFrame aggregates.

Every function takes rows with a 0/1 label and a score column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordergrain.functions.scalar import reaches, threshold_at
from ordergrain.operators.ranking import running_totals

# Fixed value: number of points of the threshold grid.
GRID_POINTS = 76


def _score_groups(scored: DataFrame, label: str, score: str) -> DataFrame:
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("bigint")).alias("late"), F.count("*").alias("rows")
    )


def ranking_metrics(scored: DataFrame, label: str, score: str) -> DataFrame:
    """``pr_auc`` (average precision) and ``roc_auc``; equal scores form one step.

    Scores are nearly unique, so the running sums are taken over range partitions.
    """
    groups = running_totals(
        _score_groups(scored, label, score),
        [F.col("score").desc()],
        {"late": "late_above", "rows": "rows_above"},
    )
    late, rows = F.col("late"), F.col("rows")
    all_late, all_rows = F.max("late_above_total"), F.max("rows_above_total")
    precision = (F.col("late_above") + late) / (F.col("rows_above") + rows)
    on_time = (rows - late).cast("double")
    on_time_below = (
        F.col("rows_above_total") - F.col("late_above_total") - F.col("rows_above") + F.col("late_above") - on_time
    )
    return groups.agg(
        F.coalesce(F.try_divide(F.sum(late * precision), all_late), F.lit(0.0)).alias("pr_auc"),
        F.try_divide(
            F.sum(late * (on_time_below + on_time / 2)),
            all_late.cast("double") * (all_rows - all_late),
        ).alias("roc_auc"),
    )


def _threshold_measures(hits: Column, predicted: Column, late: Column) -> dict[str, Column]:
    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return {
        "precision": ratio(hits, predicted),
        "recall": ratio(hits, late),
        "f1": ratio(hits * 2, predicted + late),
    }


def threshold_metrics(scored: DataFrame, label: str, score: str, threshold: Column | float) -> DataFrame:
    """``precision``, ``recall`` and ``f1`` at a threshold; 0 where undefined."""
    counted = scored.select(
        F.col(label).cast("bigint").alias("late"), reaches(F.col(score), threshold).alias("predicted")
    ).agg(
        F.sum(F.col("late") * F.col("predicted")).alias("hits"),
        F.sum("predicted").alias("predicted"),
        F.sum("late").alias("late"),
    )
    measures = _threshold_measures(F.col("hits"), F.col("predicted"), F.col("late"))
    return counted.select([c.alias(name) for name, c in measures.items()])


def evaluate(scored: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """All five metrics in one row."""
    at_threshold = threshold_metrics(scored, label, score, threshold).select(F.struct("*").alias("at"))
    return ranking_metrics(scored, label, score).withColumn("at", at_threshold.scalar()).select(
        "pr_auc", "roc_auc", "at.*"
    )


def threshold_sweep(scored: DataFrame, label: str, score: str) -> DataFrame:
    """``(threshold, f1)`` on the grid from one pass over the rows.

    Each row is counted at the highest grid point it reaches; sums from the top of the 76
    counts then give the predictions at every point.
    """
    value = F.col(score)
    near = F.floor((value - 0.05) * 100).cast("int")
    # Rounding can put ``near`` one off, so compare with the grid points themselves.
    highest = (
        F.when(value >= threshold_at(near + 1), near + 1)
        .when(value >= threshold_at(near), near)
        .otherwise(near - 1)
    )
    reached = F.greatest(F.lit(-1), F.least(F.lit(GRID_POINTS - 1), highest))
    counts = scored.groupBy(reached.alias("point")).agg(
        F.sum(F.col(label).cast("bigint")).alias("late"), F.count("*").alias("rows")
    )
    grid = scored.sparkSession.range(-1, GRID_POINTS).select(F.col("id").cast("int").alias("point"))
    full = grid.join(counts, "point", "left").fillna(0, ["late", "rows"])
    above = Window.orderBy(F.desc("point")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = full.select(
        "point",
        F.sum("late").over(above).alias("hits"),
        F.sum("rows").over(above).alias("predicted"),
        F.sum("late").over(everything).alias("all_late"),
    )
    f1 = _threshold_measures(F.col("hits"), F.col("predicted"), F.col("all_late"))["f1"]
    return sums.where(F.col("point") >= 0).select(threshold_at(F.col("point")).alias("threshold"), f1.alias("f1"))


def best_threshold(scored: DataFrame, label: str, score: str) -> DataFrame:
    """The grid point with the highest F1, the lowest on a tie."""
    return threshold_sweep(scored, label, score).agg(
        F.max_by("threshold", F.struct(F.col("f1"), -F.col("threshold"))).alias("threshold"),
        F.max("f1").alias("f1"),
    )


def choose_model(results: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """The candidate with the highest validation average precision, the first listed on a tie.

    Input and output rows have ``model``, ``pr_auc`` and ``threshold``; other models are left out.
    """
    place = F.array_position(F.array(*map(F.lit, candidates)), F.col("model"))
    return (
        results.where(place > 0)
        .agg(F.max_by(F.struct("model", "pr_auc", "threshold"), F.struct(F.col("pr_auc"), -place)).alias("best"))
        .select("best.*")
    )
