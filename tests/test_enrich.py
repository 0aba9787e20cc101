from __future__ import annotations

import pytest
from commerce import commerce_tables
from pyspark.sql import functions as F

from ordergrain.operators.primary import primary_value
from ordergrain.plans.enrich import enrich_orders, parsed_orders, zip_centroids


@pytest.fixture(scope="module")
def tables(spark):
    return commerce_tables(spark)


@pytest.fixture(scope="module")
def enriched(tables):
    return {r["order_id"]: r.asDict() for r in enrich_orders(tables).collect()}


def test_one_row_per_order(enriched, tables):
    assert len(enriched) == tables["orders"].count() == enrich_orders(tables).count()


def test_many_children_do_not_multiply(enriched):
    o = enriched["o1"]
    assert (o["item_count"], o["unique_product_count"], o["seller_count"]) == (3, 2, 2)
    assert (o["total_price"], o["total_freight"], o["freight_ratio"]) == (50.0, 4.5, 0.09)
    assert (o["total_payment"], o["payment_installments"], o["payment_count"]) == (23.0, 3, 3)
    assert (o["review_score"], o["review_count"]) == (2.0, 2)


def test_product_means_skip_missing(enriched):
    assert enriched["o1"]["avg_product_weight_g"] == pytest.approx(400 / 3)
    assert enriched["o1"]["avg_product_volume_cm3"] == pytest.approx(20 / 3)
    assert enriched["o3"]["avg_product_weight_g"] is None


def test_primary_values(enriched):
    assert enriched["o1"]["primary_category"] == "beauty"
    assert enriched["o2"]["primary_category"] == "pcs"  # no translation: the original name
    assert enriched["o3"]["primary_category"] is None
    assert enriched["o1"]["primary_seller_state"] == "RJ"
    assert enriched["o1"]["primary_payment_type"] == "voucher"  # 9.0 twice: the lower sequence


def test_primary_value_tie_takes_the_smallest(table):
    rows = table("order_id int, v string", *[(1, v) for v in ("b", "b", "a", "a", None)], (2, None))
    assert [tuple(r) for r in primary_value(rows, "order_id", "v", "p").collect()] == [(1, "a")]


def test_coordinates_and_distance(enriched):
    assert (enriched["o1"]["customer_lat"], enriched["o1"]["customer_lng"]) == (3.0, 25.0)
    assert enriched["o5"]["customer_lat"] is None and enriched["o5"]["avg_distance_km"] is None
    assert enriched["o3"]["avg_distance_km"] is None  # seller ZIP without a centroid
    assert enriched["o2"]["avg_distance_km"] > 1000


def test_lateness(enriched):
    assert [enriched[f"o{n}"]["is_late"] for n in range(1, 7)] == [1, 0, 0, None, None, 0]
    assert enriched["o1"]["late_days"] == 1.0 and enriched["o1"]["delivery_days"] == 9.5
    assert enriched["o3"]["late_days"] is None


def test_orders_without_children(enriched):
    o = enriched["o6"]
    assert o["item_count"] is None and o["total_payment"] is None and o["review_score"] is None
    assert enriched["o2"]["freight_ratio"] is None  # price 0


def test_calendar(enriched):
    o = enriched["o4"]
    assert (o["purchase_year_month"], o["purchase_month"], o["purchase_weekday"], o["purchase_hour"]) == (
        "2018-07", 7, 1, 23,
    )


def test_requested_columns_equal_the_full_table(tables, enriched):
    columns = ["order_id", "freight_ratio", "seller_count", "total_payment", "avg_distance_km", "is_late"]
    for row in enrich_orders(tables, columns).collect():
        assert list(row.asDict()) == columns
        assert all(row[c] == enriched[row["order_id"]][c] for c in columns)


def test_unneeded_tables_are_not_read(tables):
    partial = {"orders": tables["orders"], "payments": tables["payments"]}
    assert enrich_orders(partial, ["order_id", "total_payment", "is_late"]).count() == 6


def test_text_dates_are_parsed(table):
    orders = parsed_orders(
        table(
            "order_id int, order_purchase_timestamp string, order_approved_at string",
            (1, "2018-01-01 10:00:00", "never"),
        )
    )
    row = orders.first()
    assert str(row["order_purchase_timestamp"]) == "2018-01-01 10:00:00" and row["order_approved_at"] is None


def test_no_nan_in_any_column(tables):
    df = enrich_orders(tables)
    doubles = [c for c, t in df.dtypes if t == "double"]
    assert df.where(" OR ".join(f"isnan({c})" for c in doubles)).count() == 0


def test_centroids_leave_null_zip_out(table):
    geo = table(
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double",
        (None, 1.0, 1.0), (1, 5.0, None), (1, 7.0, 2.0),
    )
    assert [tuple(r) for r in zip_centroids(geo).collect()] == [(1, 6.0, 2.0)]


def test_totals_do_not_depend_on_partitioning(tables):
    again = {**tables, "payments": tables["payments"].repartition(5, F.rand(3))}
    assert sorted(enrich_orders(again, ["order_id", "total_payment"]).collect()) == sorted(
        enrich_orders(tables, ["order_id", "total_payment"]).collect()
    )
