from __future__ import annotations

from datetime import date, datetime

import pytest
from commerce import commerce_tables

from ordergrain.plans import business_sql, kpis, quality
from ordergrain.plans.cohort import cohort_retention
from ordergrain.plans.enrich import enrich_orders
from ordergrain.plans.report import executive_summary, leader
from ordergrain.plans.rfm import repeat_rate, rfm, rfm_base, segment_summary
from ordergrain.session import materialize


@pytest.fixture(scope="module")
def tables(spark):
    return commerce_tables(spark)


@pytest.fixture(scope="module")
def orders(tables):
    return materialize(enrich_orders(tables))


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_month_of_unpaid_orders(spark, orders):
    month = by(kpis.monthly_kpis(orders), "purchase_year_month")["2018-03"]
    assert (month["orders"], month["revenue"], month["avg_order_value"]) == (1, 0.0, None)
    asked = by(business_sql.monthly_kpis(spark, orders), "purchase_year_month")["2018-03"]
    assert asked["revenue"] is None and asked["average_order_value"] is None


def test_months_add_up_to_the_delivered_orders(orders):
    months = kpis.monthly_kpis(orders).collect()
    assert sum(m["orders"] for m in months) == kpis.delivered_orders(orders).count() == 5


def test_plain_count_equals_distinct_count_on_order_grain(orders):
    for product in (kpis.monthly_kpis, kpis.category_performance, kpis.state_performance):
        assert sorted(product(orders).collect()) == sorted(product(orders, one_row_per_order=True).collect())


def test_null_category_is_dropped_by_the_table_and_kept_by_the_question(spark, orders):
    assert set(by(kpis.category_performance(orders), "primary_category")) == {"beauty", "pcs"}
    asked = by(business_sql.risky_categories(spark, orders, min_orders=1), "primary_category")
    assert asked[None]["delivered_orders"] == 3
    assert business_sql.risky_categories(spark, orders).count() == 0


def test_lanes_and_repeat_customers(spark, orders):
    lanes = business_sql.delivery_lanes(spark, orders, min_orders=2).collect()
    assert [(r["customer_state"], r["primary_seller_state"], r["orders"]) for r in lanes] == [("SP", "RJ", 2)]
    repeat = by(business_sql.repeat_customers(spark, orders), "customer_type")
    assert repeat["Repeat customer"]["customers"] == 2 and repeat["One order"]["customer_pct"] == 33.33


def test_questions_run_on_a_view(spark, orders):
    orders.createOrReplaceTempView("orders")
    assert business_sql.satisfaction(spark).count() == 2
    assert sorted(business_sql.monthly_kpis(spark).collect(), key=str) == sorted(
        business_sql.monthly_kpis(spark, orders).collect(), key=str
    )


def test_lateness_policies(orders):
    counts = {
        policy: {r["delivery_result"]: r["orders"] for r in kpis.review_by_delivery(orders, policy).collect()}
        for policy in ("on_time", "null", "drop")
    }
    assert counts == {
        "on_time": {"Late": 1, "On time": 4},
        "null": {"Late": 1, "On time": 3, None: 1},
        "drop": {"Late": 1, "On time": 3},
    }


def test_filters_are_inclusive_and_need_both_dates(orders):
    rows = kpis.filtered_orders(orders, start=date(2018, 7, 20), end=date(2018, 7, 31))
    assert {r["order_id"] for r in rows.collect()} == {"o3", "o4"}
    assert kpis.filtered_orders(orders, start=date(2018, 7, 20)).count() == 5
    assert {r["order_id"] for r in kpis.filtered_orders(orders, ["RJ"]).collect()} == {"o2", "o3"}
    assert kpis.filtered_orders(orders, []).count() == 0


def test_top_categories_break_ties_by_name(table):
    rows = table("primary_category string, total_payment double", ("b", 5.0), ("a", 5.0), ("c", 9.0), ("d", 1.0))
    assert [r["primary_category"] for r in kpis.top_categories(rows, 2).collect()] == ["a", "c"]


def test_review_distribution_adds_up_per_result(table):
    rows = table(
        "is_late int, review_score double", (0, 5.0), (0, 4.5), (0, 4.4), (1, 1.0), (None, 3.0), (0, None)
    )
    got = {(r["delivery_result"], r["score_bin"]): r["percent"] for r in kpis.review_distribution(rows).collect()}
    assert got == {
        ("On time", 5): pytest.approx(200 / 3), ("On time", 4): pytest.approx(100 / 3), ("Late", 1): 100.0,
        (None, 3): 100.0,
    }


def test_cohorts_are_sparse(orders):
    got = {(r["cohort_month"], r["cohort_index"]): (r["customers"], r["retention_rate"])
           for r in cohort_retention(orders).collect()}
    assert got == {("2018-01", 0): (2, 1.0), ("2018-01", 6): (2, 1.0), ("2018-03", 0): (1, 1.0)}


def test_recency_frequency_monetary(orders):
    customers = by(rfm_base(orders), "customer_unique_id")
    assert set(customers) == {"p1", "p2", "p5"}
    assert (customers["p1"]["recency_days"], customers["p1"]["frequency"]) == (0, 2)
    assert customers["p1"]["monetary"] == 28.5 and customers["p5"]["monetary"] == 0.0
    assert customers["p2"]["recency_days"] == 11  # 2018-07-20 15:00 to 2018-08-01
    assert repeat_rate(rfm_base(orders)).first()["repeat_rate"] == pytest.approx(2 / 3)


def test_segments_cover_all_customers(orders):
    scored = rfm(orders)
    assert sum(r["customers"] for r in segment_summary(scored).collect()) == scored.count() == 3


def test_quality_report(tables, orders, table):
    profile = quality.table_profile(table("a int, b string", (1, None), (1, None), (2, "x")), "t").first()
    assert (profile["rows"], profile["columns"], profile["duplicate_rows"], profile["missing_cells"]) == (3, 2, 1, 2)
    report = quality.quality_report(tables, orders).first()
    assert report["tables"]["reviews"]["rows"] == 5 and len(report["tables"]) == 9
    assert (report["orders_total"], report["delivered_orders"], report["late_rate"]) == (6, 5, 0.25)
    assert report["date_min"] == "2018-01-01 12:00:00"


def test_duplicates_by_digest(table):
    rows = [("a", None), (None, "a"), ("a", None), ("", "a"), ("a", ""), ("aa", None), (None, None), (None, None), (None, None)]
    df = table("x string, y string", *rows)
    counted = quality.duplicate_rows(df, "t")
    assert counted.first()["duplicate_rows"] == len(rows) - len(set(rows)) == 3
    shuffled = [line for line in counted._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hash" in line]
    assert shuffled and all("__digest" in line and "x#" not in line for line in shuffled)
    numbers = table("v double, n int", (0.0, 1), (-0.0, 1), (1.0, 2), (float("nan"), 2), (float("nan"), 2))
    assert quality.duplicate_rows(numbers, "t").first()["duplicate_rows"] == 2


def test_quality_rows_repeat_the_record(tables, orders):
    report = quality.quality_report(tables, orders)
    rows = {r["table"]: r for r in quality.quality_rows(report).collect()}
    assert len(rows) == 9 and all(r["orders_total"] == 6 for r in rows.values())
    assert rows["reviews"]["rows"] == report.first()["tables"]["reviews"]["rows"]


def test_profile_of_an_empty_table(table):
    empty = table("a int, b int", (1, 1)).where("a = 2")
    assert list(quality.table_profile(empty, "t").first())[1:] == [0, 2, 0, 0, 0]


def test_executive_summary(orders):
    summary = executive_summary(orders, rfm_base(orders)).first()
    assert summary["total_orders"] == "6" and summary["revenue"] == "R$ 41"
    assert summary["period_start"] == "2018-01-01" and summary["late_rate"] == "25.0%"
    assert (summary["top_state"], summary["top_state_orders"]) == ("SP", "3")


def test_leader_breaks_ties_by_name(table):
    rows = table("k string, revenue double, orders int", ("b", 5.0, 1), ("a", 5.0, 2), ("c", 1.0, 3))
    assert tuple(leader(rows, "k").first()) == ("a", 5.0, 2)


def test_metric_rows(orders):
    rows = {r["metric"]: r["value"] for r in kpis.as_metric_rows(kpis.overall_kpis(orders)).collect()}
    assert rows["orders"] == 6.0 and rows["delivered_orders"] == 5.0


def test_purchase_span_and_values(orders):
    span = kpis.purchase_span(orders).first()
    assert span["first_purchase"] == datetime(2018, 1, 1, 12)
    assert sorted(r[0] for r in kpis.distinct_values(orders, "primary_category").collect()) == ["beauty", "pcs"]
