"""One key with a third of the rows: right results, and the join is split at run time."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordergrain.operators.ranking import _counts_around_medians, exact_medians, grouped_medians
from ordergrain.plans.cohort import active_months
from ordergrain.plans.enrich import customers_located, enrich_orders, item_totals, zip_centroids
from ordergrain.plans.quality import table_profile

N = 60_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def lines():
    """(order, product, seller): a third on order 0, product 0 and seller 0, not the same third."""
    rng = random.Random(11)

    def key(n):
        return 0 if rng.random() < 1 / 3 else rng.randrange(1, n)

    return [(key(9000), key(500), key(60)) for _ in range(N)]


@pytest.fixture(scope="module")
def tables(spark, lines):
    items = spark.createDataFrame(
        [(o, i, p, s, p / 4, 1.0) for i, (o, p, s) in enumerate(lines)],
        "order_id int, order_item_id int, product_id int, seller_id int, price double, freight_value double",
    ).repartition(12)
    orders = spark.range(9000).select(
        F.col("id").cast("int").alias("order_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 700).cast("int").alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        F.timestamp_add("DAY", (F.col("id") % 300).cast("int"), F.lit("2018-01-01").cast("timestamp_ntz")).alias(
            "order_purchase_timestamp"
        ),
    )
    zips = [i % 40 for i in range(700)]
    return {
        "items": items,
        "orders": orders,
        "customers": spark.createDataFrame(
            [(i, i, z, f"S{z}") for i, z in enumerate(zips)],
            "customer_id int, customer_unique_id int, customer_zip_code_prefix int, customer_state string",
        ),
        "sellers": spark.createDataFrame(
            [(i, i % 40, f"S{i % 7}") for i in range(60)],
            "seller_id int, seller_zip_code_prefix int, seller_state string",
        ),
        "products": spark.createDataFrame(
            [(i, f"c{i % 9}", 1.0 * i, 1.0, 1.0, 1.0) for i in range(500)],
            "product_id int, product_category_name string, product_weight_g double,"
            " product_length_cm double, product_height_cm double, product_width_cm double",
        ),
        "translation": spark.createDataFrame(
            [("c1", "one")], "product_category_name string, product_category_name_english string"
        ),
        "geolocation": spark.createDataFrame(
            [(0 if i % 3 == 0 else i % 40, (i * 7) % 1000 / 10, (i * 13) % 1000 / 10) for i in range(30_000)],
            "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double",
        ).repartition(6),
    }


@pytest.fixture()
def small_thresholds(spark):
    before = {name: spark.conf.get(name) for name in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def executed(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_hot_order_product_and_seller(tables, lines, small_thresholds):
    df = item_totals(tables)
    rows, plan = executed(df)
    assert "Expand" not in plan
    got = {r["order_id"]: r for r in rows}
    assert plan.count("skew=true") >= 3
    per_order = {}
    for o, p, s in lines:
        per_order.setdefault(o, []).append((p, s))
    assert set(got) == set(per_order)
    for o in [0, *list(per_order)[:300]]:
        pairs = per_order[o]
        kinds = Counter("one" if p % 9 == 1 else f"c{p % 9}" for p, _ in pairs)
        states = Counter(f"S{s % 7}" for _, s in pairs)
        row = got[o]
        assert row["item_count"] == len(pairs)
        assert row["unique_product_count"] == len({p for p, _ in pairs})
        assert row["seller_count"] == len({s for _, s in pairs})
        assert row["total_price"] == sum(p for p, _ in pairs) / 4
        assert row["avg_product_weight_g"] == pytest.approx(sum(p for p, _ in pairs) / len(pairs))
        assert row["primary_category"] == min(kinds, key=lambda k: (-kinds[k], k))
        assert row["primary_seller_state"] == min(states, key=lambda k: (-states[k], k))
        assert row["avg_distance_km"] is not None


def test_hot_customer(tables, small_thresholds):
    spread = {**tables, "orders": tables["orders"].repartition(8, "order_id")}
    rows, plan = executed(enrich_orders(spread, ["order_id", "customer_state"]))
    assert len(rows) == 9000
    assert all(r["customer_state"] == "S0" for r in rows if r["order_id"] % 3 == 0)


def test_hot_customer_months(tables):
    orders = tables["orders"].withColumn("customer_unique_id", F.col("customer_id"))
    months = active_months(orders)
    hot = months.where("customer_unique_id = 0").collect()
    assert len(hot) == 10 and len({r["cohort_month"] for r in hot}) == 1


def test_hot_zip_median(tables):
    points = tables["geolocation"].toDF("zip", "lat", "lng")
    got = {
        r["zip"]: (r["lat"], r["lng"])
        for r in grouped_medians(points, "zip", ["lat", "lng"]).collect()
    }
    assert got == {r["zip"]: (r["lat"], r["lng"]) for r in zip_centroids(tables["geolocation"]).collect()}
    expected = {
        r["zip"]: (r["lat"], r["lng"])
        for r in tables["geolocation"]
        .groupBy(F.col("geolocation_zip_code_prefix").alias("zip"))
        .agg(F.median("geolocation_lat").alias("lat"), F.median("geolocation_lng").alias("lng"))
        .collect()
    }
    assert got == expected
    assert customers_located(tables).where("customer_lat IS NULL").count() == 0


def test_hot_zip_is_never_put_in_order_as_a_whole(spark):
    n = 120_000
    points = spark.range(n).selectExpr(
        "CAST(IF(id % 3 = 0, 7, id % 50) AS INT) AS zip", "id * 0.001 AS lat", "CAST(NULL AS DOUBLE) AS lng"
    ).repartition(6)
    counts = _counts_around_medians(points, "zip", ["lat", "lng"])
    hot = counts.where("grp = 7").collect()
    assert 3 <= len(hot) < n / 3 / 100  # the rows below as one, the values near the median, the missing ones
    assert max(r["count"] for r in counts.groupBy("grp").count().collect()) == len(hot)
    got = {r["zip"]: r["lat"] for r in grouped_medians(points, "zip", ["lat", "lng"]).collect()}
    expected = {r["zip"]: r["lat"] for r in points.groupBy("zip").agg(F.median("lat").alias("lat")).collect()}
    assert got == expected


def test_copies_of_one_row(tables):
    copies = tables["items"].select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b"))
    assert list(table_profile(copies, "t").first())[1:] == [N, 2, N - 1, N, 0]


def test_median_with_a_heavy_value(spark):
    df = spark.range(30_001).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 10).alias("v"), F.lit(2.0).alias("constant")
    )
    got = exact_medians(df, ["v", "constant"])
    values = sorted(5.0 if i % 3 == 0 else i / 10 for i in range(30_001))
    assert got == {"v": values[15_000], "constant": 2.0}
