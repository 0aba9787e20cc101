from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ordergrain.functions import scalar


def one(df, column):
    return df.select(column.alias("v")).first()["v"]


@pytest.fixture(scope="module")
def row(spark):
    return spark.range(1)


def test_no_distance_to_itself(row):
    assert one(row, scalar.haversine_km(*[F.lit(v) for v in (41.0, 29.0, 41.0, 29.0)])) == pytest.approx(0)


def test_distance_of_antipodes_is_half_the_globe(row):
    half = one(row, scalar.haversine_km(*[F.lit(v) for v in (0.0, 0.0, 0.0, 180.0)]))
    assert half == pytest.approx(math.pi * 6371.0088)


@pytest.mark.parametrize("absent", range(4))
def test_missing_coordinate_gives_no_distance(row, absent):
    places = [F.lit(v) for v in (1.0, 2.0, 3.0, 4.0)]
    places[absent] = F.lit(None).cast("double")
    assert one(row, scalar.haversine_km(*places)) is None


def test_bad_timestamp_is_null(row):
    assert one(row, scalar.parse_timestamp(F.lit("x"))) is None
    assert one(row, scalar.parse_timestamp(F.lit("2018-01-02 03:04:05"))) == datetime(2018, 1, 2, 3, 4, 5)


@pytest.mark.parametrize(("bought", "days"), [("2018-08-29 15:00:00", 0), ("2018-08-29 00:00:00", 1)])
def test_whole_days_are_floored(row, bought, days):
    start, end = (F.lit(t).cast("timestamp_ntz") for t in (bought, "2018-08-30 00:00:00"))
    assert one(row, scalar.whole_days_between(start, end)) == days


def test_monday_is_weekday_zero(row):
    assert one(row, F.weekday(F.lit("2018-01-01").cast("timestamp_ntz"))) == 0


@pytest.mark.parametrize(
    ("recency", "frequency", "segment"),
    [
        (4, 3, "Champions"), (3, 3, "Loyal"), (3, 2, "Recent"), (4, 1, "Recent"), (2, 3, "At risk"),
        (1, 1, "Hibernating"),
    ],
)
def test_segments(row, recency, frequency, segment):
    assert one(row, scalar.rfm_segment(F.lit(recency), F.lit(frequency))) == segment


def test_zero_price_has_no_ratio(row):
    assert one(row, scalar.safe_ratio(F.lit(5.0), F.lit(0.0))) is None


def test_threshold_grid_points(spark):
    points = [r["v"] for r in spark.range(76).select(scalar.threshold_at(F.col("id")).alias("v")).collect()]
    assert points[0] == 0.05 and points[57] == 0.6200000000000001 and points[75] == 0.8


@pytest.mark.parametrize(("value", "places", "rounded"), [(1.005, 2, 1.0), (2.5, 0, 3.0), (0.125, 2, 0.13)])
def test_rounding_works_on_the_double(row, value, places, rounded):
    assert one(row, scalar.round_half_away(F.lit(value), places)) == rounded


def test_report_texts(row):
    assert one(row, scalar.count_text(F.lit(99441))) == "99,441"
    assert one(row, scalar.money_text(F.lit(159.856), 2)) == "R$ 159.86"
    assert one(row, scalar.percent_text(F.lit(0.08112))) == "8.1%"
    assert one(row, scalar.percent_text(F.lit(0.0))) == "0.0%"
    assert one(row, scalar.title_text(F.lit("logistic_regression"))) == "Logistic Regression"


def test_unknown_null_policy(row):
    with pytest.raises(ValueError):
        scalar.delivery_result(F.lit(1), "other")
