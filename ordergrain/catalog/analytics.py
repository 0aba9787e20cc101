"""Aggregations and window operators (A, W)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ordergrain.catalog import questions
from ordergrain.catalog.oracle import PAID_MEAN, PAID_TOTAL
from ordergrain.catalog.registry import register
from ordergrain.catalog.relational import (
    CATEGORY_COLUMNS,
    COHORT_COLUMNS,
    COHORT_SQL,
    FILTER,
    FILTER_SQL,
    LANE_COLUMNS,
    OVERALL_COLUMNS,
    OVERALL_SQL,
    REVIEW_COLUMNS,
    REVIEW_PAIR,
    RFM_COLUMNS,
    RFM_SQL,
    STATE_COLUMNS,
)
from ordergrain.plans import business_sql, enrich, kpis, quality
from ordergrain.plans.cohort import active_months, cohort_counts, cohort_retention
from ordergrain.plans.late_risk import scenario
from ordergrain.plans.late_risk.features import CATEGORICAL_FEATURES, FEATURES
from ordergrain.plans.report import executive_summary
from ordergrain.plans.rfm import repeat_rate, rfm, rfm_base, rfm_scores, segment_summary
from ordergrain.session import materialize
from ordergrain.sources.tables import typed

# --- building blocks of the enriched table ---------------------------------------------------
register("a1_zip_medians", lambda i: enrich.zip_centroids(i.tables["geolocation"]), "SELECT * FROM centroids")
register(
    "a2_item_totals",
    lambda i: enrich.item_totals(i.tables),
    "SELECT * FROM item_totals",
    rounded=("avg_product_weight_g", "avg_product_volume_cm3", "avg_distance_km"),
)
register("a4_payment_totals", lambda i: enrich.payment_totals(i.tables["payments"]), "SELECT * FROM payment_totals")
register(
    "a5_review_totals",
    lambda i: enrich.review_totals(i.tables["reviews"]),
    "SELECT * FROM review_totals",
    rounded=("review_score",),
)
register(
    "a6_rfm_base",
    lambda i: rfm_base(i.orders(*RFM_COLUMNS)),
    RFM_SQL + "SELECT customer_unique_id, recency_days, frequency, monetary FROM base",
)

# --- summary tables ----------------------------------------------------------------------------
_MONTH_COLUMNS = ("order_id", "order_status", "purchase_year_month", "total_payment", "is_late", "review_score")
_KPI_SQL = f"""count(DISTINCT order_id) AS orders, {PAID_TOTAL} AS revenue, {PAID_MEAN} AS avg_order_value,
       avg(is_late) AS late_rate, avg(review_score) AS avg_review_score"""
register(
    "a7_monthly_kpis",
    lambda i: kpis.monthly_kpis(i.orders(*_MONTH_COLUMNS)),
    f"SELECT purchase_year_month, {_KPI_SQL} FROM d GROUP BY 1",
    rounded=("avg_review_score",),
)
register(
    "a8_category_kpis",
    lambda i: kpis.category_performance(i.orders(*CATEGORY_COLUMNS)),
    f"SELECT primary_category, {_KPI_SQL} FROM d WHERE primary_category IS NOT NULL GROUP BY 1",
    rounded=("avg_review_score",),
)
register(
    "a9_state_kpis",
    lambda i: kpis.state_performance(i.orders(*STATE_COLUMNS)),
    f"""SELECT customer_state, count(DISTINCT order_id) AS orders, {PAID_TOTAL} AS revenue,
        avg(is_late) AS late_rate, avg(delivery_days) AS avg_delivery_days,
        avg(review_score) AS avg_review_score FROM d WHERE customer_state IS NOT NULL GROUP BY 1""",
    rounded=("avg_delivery_days", "avg_review_score"),
)
register(
    "a10_cohort_counts",
    lambda i: cohort_counts(i.orders(*COHORT_COLUMNS)),
    COHORT_SQL + "SELECT cohort_month, cohort_index, customers FROM counted",
)

# --- the five business questions -----------------------------------------------------------------
register(
    "a11_monthly_kpis_sql",
    lambda i: business_sql.monthly_kpis(i.spark, i.orders(*_MONTH_COLUMNS)),
    questions.MONTHLY_SQL,
)
register(
    "a12_risky_categories_sql",
    lambda i: business_sql.risky_categories(i.spark, i.orders(*CATEGORY_COLUMNS)),
    questions.categories_sql(business_sql.MIN_CATEGORY_ORDERS),
)
register(
    "a13_delivery_lanes_sql",
    # The test tables have no lane of business_sql.MIN_LANE_ORDERS orders; three leave rows to compare.
    lambda i: business_sql.delivery_lanes(i.spark, i.orders(*LANE_COLUMNS), min_orders=3),
    questions.lanes_sql(3),
)
register(
    "a14_satisfaction_sql",
    lambda i: business_sql.satisfaction(i.spark, i.orders(*REVIEW_COLUMNS)),
    questions.SATISFACTION_SQL,
)
register(
    "a15_repeat_customers_sql",
    lambda i: business_sql.repeat_customers(i.spark, i.orders("order_id", "order_status", "customer_unique_id")),
    questions.REPEAT_SQL,
)

# --- filtered views --------------------------------------------------------------------------------


def _filtered(i, *columns):
    needed = dict.fromkeys(("order_status", "customer_state", "order_purchase_timestamp", *columns))
    return kpis.filtered_orders(i.orders(*needed), *FILTER)


register(
    "a16_kpi_cards",
    lambda i: kpis.kpi_cards(_filtered(i, "order_id", "total_payment", "is_late")),
    f"SELECT count(DISTINCT order_id) AS orders, {PAID_TOTAL} AS revenue, {PAID_MEAN} AS avg_order_value,"
    f" avg(is_late) AS late_rate FROM d WHERE {FILTER_SQL}",
)
register(
    "a16_monthly_trend",
    lambda i: kpis.monthly_trend(_filtered(i, "order_id", "purchase_year_month", "total_payment", "is_late")),
    f"SELECT purchase_year_month, count(DISTINCT order_id) AS orders, {PAID_TOTAL} AS revenue,"
    f" avg(is_late) AS late_rate FROM d WHERE {FILTER_SQL} GROUP BY 1",
)
register(
    "a17_category_revenue",
    lambda i: kpis.top_categories(_filtered(i, "primary_category", "total_payment")),
    f"SELECT primary_category, {PAID_TOTAL} AS total_payment FROM d"
    f" WHERE {FILTER_SQL} AND primary_category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12",
)
register(
    "a18_state_operations",
    lambda i: kpis.state_operations(_filtered(i, "order_id", "is_late", "delivery_days")),
    f"SELECT customer_state, count(DISTINCT order_id) AS orders, avg(is_late) AS late_rate,"
    f" avg(delivery_days) AS delivery_days, 100 * avg(is_late) AS late_rate_pct FROM d"
    f" WHERE {FILTER_SQL} GROUP BY 1",
    rounded=("delivery_days",),
)
register(
    "a19_review_distribution",
    lambda i: kpis.review_distribution(_filtered(i, "is_late", "review_score")),
    f"""SELECT CASE is_late WHEN 1 THEN 'Late' WHEN 0 THEN 'On time' END AS delivery_result,
        CAST(floor(review_score + 0.5e0) AS INT) AS score_bin, count(*) AS orders,
        100 * count(*) / sum(count(*)) OVER (
            PARTITION BY CASE is_late WHEN 1 THEN 'Late' WHEN 0 THEN 'On time' END) AS percent
        FROM d WHERE {FILTER_SQL} AND review_score IS NOT NULL GROUP BY is_late, 2""",
)
register(
    "a20_segment_summary",
    lambda i: segment_summary(rfm(i.orders(*RFM_COLUMNS))),
    RFM_SQL + "SELECT segment, count(*) AS customers, CAST(sum(CAST(monetary AS DECIMAL(18, 2))) AS DOUBLE)"
    " AS monetary, avg(recency_days) AS avg_recency FROM segmented GROUP BY 1",
)

# --- report numbers ----------------------------------------------------------------------------------
register(
    "a21_overall_kpis",
    lambda i: kpis.overall_kpis(i.orders(*OVERALL_COLUMNS)),
    OVERALL_SQL,
    rounded=("avg_review_score",),
)
register(
    "a22_review_by_lateness",
    lambda i: kpis.mean_review_by_lateness(i.orders(*REVIEW_COLUMNS)),
    REVIEW_PAIR,
    rounded=("on_time_review", "late_review"),
)
_RESULT_SQL = {
    "on_time": ("CASE WHEN is_late = 1 THEN 'Late' ELSE 'On time' END", "TRUE"),
    "null": ("CASE is_late WHEN 1 THEN 'Late' WHEN 0 THEN 'On time' END", "TRUE"),
    "drop": ("CASE is_late WHEN 1 THEN 'Late' WHEN 0 THEN 'On time' END", "is_late IS NOT NULL"),
}
for _policy, (_label, _kept) in _RESULT_SQL.items():
    register(
        f"a23_review_by_delivery_{_policy}",
        lambda i, policy=_policy: kpis.review_by_delivery(i.orders(*REVIEW_COLUMNS), policy),
        f"SELECT {_label} AS delivery_result, count(DISTINCT order_id) AS orders,"
        f" avg(review_score) AS average_review FROM d WHERE {_kept} GROUP BY 1",
        rounded=("average_review",),
    )
register(
    "a24_repeat_rate",
    lambda i: repeat_rate(rfm_base(i.orders(*RFM_COLUMNS))),
    RFM_SQL + "SELECT avg(CASE WHEN frequency > 1 THEN 1 ELSE 0 END) AS repeat_rate FROM base",
)
register(
    "a25_observed_categories",
    lambda i: scenario.observed_categories(i.orders("order_status", *FEATURES)),
    "\nUNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column, {c} AS value FROM d WHERE {c} IS NOT NULL" for c in CATEGORICAL_FEATURES
    ),
)
register(
    "a26_distinct_states",
    lambda i: kpis.distinct_values(i.delivered("customer_state"), "customer_state").orderBy("customer_state"),
    "SELECT DISTINCT customer_state FROM d WHERE customer_state IS NOT NULL",
)
register(
    "a27_purchase_span",
    lambda i: kpis.purchase_span(i.delivered("order_purchase_timestamp")),
    "SELECT min(order_purchase_timestamp) AS first_purchase, max(order_purchase_timestamp) AS last_purchase FROM d",
)

# --- quality -------------------------------------------------------------------------------------------
_ROLE_COLUMNS = {
    "customers": ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_state"),
    "geolocation": ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
    "items": ("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "payments": ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
    "products": (
        "product_id", "product_category_name", "product_weight_g", "product_length_cm",
        "product_height_cm", "product_width_cm",
    ),
    "reviews": ("review_id", "order_id", "review_score"),
    "sellers": ("seller_id", "seller_zip_code_prefix", "seller_state"),
    "translation": ("product_category_name", "product_category_name_english"),
}


def _profile_sql(table):
    columns = _ROLE_COLUMNS[table]
    missing = " + ".join(f"count(*) - count({c})" for c in columns)
    return (
        f"SELECT '{table}' AS \"table\", count(*) AS rows, CAST({len(columns)} AS INT) AS columns,"
        f" count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM r_{table})) AS duplicate_rows,"
        f" {missing} AS missing_cells FROM r_{table}"
    )


_PROFILES_SQL = "\nUNION ALL ".join(_profile_sql(t) for t in _ROLE_COLUMNS)
register(
    "a28_table_sizes",
    lambda i: quality.table_sizes(i.tables).select("table", "rows", "columns"),
    f'SELECT "table", rows, columns FROM ({_PROFILES_SQL})',
)
register(
    "a29_duplicate_rows",
    lambda i: quality.table_duplicates(i.tables),
    f'SELECT "table", duplicate_rows FROM ({_PROFILES_SQL})',
)
register(
    "a30_missing_cells",
    lambda i: quality.table_sizes(i.tables).select("table", "missing_cells"),
    f'SELECT "table", missing_cells FROM ({_PROFILES_SQL})',
)
_ORDER_PROFILE_COLUMNS = ("order_id", "order_status", "order_purchase_timestamp", "is_late")
_ORDER_PROFILE_SQL = """SELECT count(DISTINCT order_id) AS orders_total,
        count(DISTINCT CASE WHEN order_status = 'delivered' THEN order_id END) AS delivered_orders,
        avg(CASE WHEN order_status = 'delivered' THEN is_late END) AS late_rate,
        strftime(min(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS date_min,
        strftime(max(order_purchase_timestamp), '%Y-%m-%d %H:%M:%S') AS date_max FROM e"""
register(
    "a31_order_profile",
    lambda i: quality.order_profile(i.orders(*_ORDER_PROFILE_COLUMNS)),
    _ORDER_PROFILE_SQL,
)
register(
    "a32_category_risk",
    lambda i: kpis.category_risk(i.orders(*CATEGORY_COLUMNS)),
    f"SELECT primary_category, count(DISTINCT order_id) AS orders, {PAID_TOTAL} AS revenue,"
    " avg(is_late) AS late_rate FROM d WHERE primary_category IS NOT NULL GROUP BY 1"
    " HAVING count(DISTINCT order_id) >= 500",
)


def _quality(i):
    return quality.quality_report(i.tables, i.orders(*_ORDER_PROFILE_COLUMNS))


register("quality_report", _quality)
register(
    "quality_report_rows",
    lambda i: quality.quality_rows(_quality(i)),
    f"""SELECT "table", rows, columns, duplicate_rows, missing_cells, CAST(0 AS BIGINT) AS unreadable_cells, totals.*
    FROM ({_PROFILES_SQL}) AS profiles, ({_ORDER_PROFILE_SQL}) AS totals""",
)


def _items_as_text(i):
    """The line items as the text cells of a file, in which some numbers and dates are broken or missing."""
    return i.parquet("lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS id",
        "CASE WHEN l_orderkey % 89 = 0 THEN '12,5 R$' WHEN l_orderkey % 97 = 0 THEN 'NA' ELSE CAST(l_quantity AS STRING) END"
        " AS amount",
        "CASE WHEN l_orderkey % 101 = 0 THEN '2018-02-31' WHEN l_orderkey % 103 = 0 THEN '' ELSE CAST(l_shipdate AS STRING) END"
        " AS day",
    )


register(
    "a30_unreadable_cells",
    lambda i: quality.table_size(
        typed(_items_as_text(i), {"id": "bigint", "amount": "double", "day": "timestamp_ntz"}, unreadable=True), "items"
    ),
    """SELECT 'items' AS "table", count(*) AS rows, CAST(3 AS INT) AS columns, missing + unreadable AS missing_cells,
              unreadable AS unreadable_cells
    FROM (SELECT count(*) FILTER (l_orderkey % 89 = 0) + count(*) FILTER (l_orderkey % 101 = 0) AS unreadable,
                 count(*) FILTER (l_orderkey % 89 <> 0 AND l_orderkey % 97 = 0)
                 + count(*) FILTER (l_orderkey % 101 <> 0 AND l_orderkey % 103 = 0) AS missing FROM lineitem), lineitem
    GROUP BY missing, unreadable""",
)

# --- windows and whole products ----------------------------------------------------------------------------
register(
    "w1_first_month",
    lambda i: active_months(i.orders(*COHORT_COLUMNS)),
    COHORT_SQL + "SELECT customer_unique_id, order_month, cohort_month FROM firsts",
)
register(
    "w2_rfm_scores",
    lambda i: rfm_scores(materialize(rfm_base(i.orders(*RFM_COLUMNS)))).select(
        "customer_unique_id", "r_score", "f_score", "m_score"
    ),
    RFM_SQL + "SELECT customer_unique_id, r_score, f_score, m_score FROM scored",
)
register(
    "w3_share_of_total",
    lambda i: i.delivered("customer_state")
    .groupBy("customer_state")
    .agg(F.count("*").alias("orders"))
    .withColumn("share", F.col("orders") / F.sum("orders").over(Window.partitionBy())),
    "SELECT customer_state, count(*) AS orders, count(*) / sum(count(*)) OVER () AS share FROM d GROUP BY 1",
)
register(
    "w4_largest_payment",
    lambda i: enrich.payment_totals(i.tables["payments"], ["payment_installments", "primary_payment_type"]),
    "SELECT order_id, payment_installments, primary_payment_type FROM payment_totals",
)
register(
    "rfm_customers",
    lambda i: rfm(i.orders(*RFM_COLUMNS)),
    RFM_SQL + "SELECT * FROM segmented",
)
register(
    "cohort_retention",
    lambda i: cohort_retention(i.orders(*COHORT_COLUMNS)),
    COHORT_SQL + "SELECT *, customers / cohort_size AS retention_rate FROM counted"
    " LEFT JOIN sizes USING (cohort_month)",
)


def _executive_summary(i):
    orders = materialize(
        i.orders(
            "order_id", "order_status", "order_purchase_timestamp", "customer_unique_id", "customer_state",
            "primary_category", "total_payment", "is_late", "delivery_days", "review_score",
        )
    )
    return executive_summary(orders, rfm_base(orders))


_MONEY = "'R$ ' || format('{{:,}}', CAST(printf('%.0f', {0}) AS BIGINT))"
_COUNT = "format('{{:,}}', {0})"
register(
    "executive_summary",
    _executive_summary,
    f"""WITH o AS ({OVERALL_SQL}),
    span AS (SELECT min(order_purchase_timestamp) AS first, max(order_purchase_timestamp) AS last FROM e),
    pair AS ({REVIEW_PAIR}),
    cat AS (SELECT primary_category, {PAID_TOTAL} AS revenue, count(DISTINCT order_id) AS orders FROM d
            WHERE primary_category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1),
    st AS (SELECT customer_state, {PAID_TOTAL} AS revenue, count(DISTINCT order_id) AS orders FROM d
           WHERE customer_state IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1),
    rep AS (SELECT avg(CASE WHEN placed > 1 THEN 1 ELSE 0 END) AS repeat_rate FROM (
            SELECT count(DISTINCT order_id) AS placed FROM d WHERE customer_unique_id IS NOT NULL
            GROUP BY customer_unique_id))
    SELECT strftime(first, '%Y-%m-%d') AS period_start, strftime(last, '%Y-%m-%d') AS period_end,
           {_COUNT.format('o.orders')} AS total_orders,
           {_COUNT.format('o.delivered_orders')} AS delivered_orders,
           {_MONEY.format('o.revenue')} AS revenue,
           'R$ ' || format('{{:,}}', CAST(trunc(round(avg_order_value, 2)) AS BIGINT)) || '.'
               || right(printf('%.2f', avg_order_value), 2) AS average_order_value,
           printf('%.1f%%', late_rate * 100) AS late_rate, printf('%.1f%%', repeat_rate * 100) AS repeat_rate,
           printf('%.2f', on_time_review) AS on_time_review, printf('%.2f', late_review) AS late_review,
           primary_category AS top_category, {_MONEY.format('cat.revenue')} AS top_category_revenue,
           {_COUNT.format('cat.orders')} AS top_category_orders,
           customer_state AS top_state, {_MONEY.format('st.revenue')} AS top_state_revenue,
           {_COUNT.format('st.orders')} AS top_state_orders
    FROM o, span, pair, cat, st, rep""",
)
