"""Scans, projections, filters, joins, sorts and scalar functions (S, P, J, O, F, U)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ordergrain.catalog.oracle import PAID_SUM, PAID_TOTAL
from ordergrain.catalog.questions import lanes_sql
from ordergrain.catalog.registry import register
from ordergrain.functions import scalar
from ordergrain.operators.primary import primary_value
from ordergrain.operators.ranking import row_positions
from ordergrain.plans import business_sql, enrich, kpis
from ordergrain.plans.cohort import active_months, cohort_counts, cohort_retention
from ordergrain.plans.late_risk import scenario
from ordergrain.plans.late_risk.features import FEATURES
from ordergrain.plans.report import leader
from ordergrain.plans.rfm import reference_date, rfm, rfm_base
from ordergrain.sources.tables import register_orders_view

ENRICHED_DOUBLES = (
    "avg_product_weight_g", "avg_product_volume_cm3", "avg_distance_km", "review_score",
    "estimated_days", "delivery_days", "late_days", "freight_ratio",
)

register(
    "enriched_orders",
    lambda i: i.orders(),
    "SELECT * FROM e",
    rounded=ENRICHED_DOUBLES,
)

# --- scans -------------------------------------------------------------------------------
register(
    "s3_parquet_scan",
    lambda i: i.parquet("orders").select("o_orderkey", "o_orderstatus").where("o_orderstatus = 'F'"),
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)


def _view_query(i):
    register_orders_view(i.orders("order_id", "order_status"), "commerce_orders")
    return i.spark.sql("SELECT order_status, COUNT(*) AS orders FROM commerce_orders GROUP BY order_status")


register("s10_sql_view", _view_query, "SELECT order_status, count(*) AS orders FROM e GROUP BY order_status")

_DEFAULT_COLUMNS = ("order_status", *FEATURES)
_WHOLE = ("item_count", "unique_product_count", "seller_count", "payment_installments",
          "purchase_month", "purchase_weekday", "purchase_hour")
_MEDIAN_SQL = ",\n".join(
    f"CAST(trunc(median({c})) AS BIGINT) AS {c}" if c in _WHOLE else f"median({c}) AS {c}"
    for c in scenario.RANGES
)
_FIRST_SQL = ", ".join(
    f"min({c}) AS {c}"
    for c in ("customer_state", "primary_category", "primary_seller_state", "primary_payment_type")
)
_REAL_FEATURES = tuple(c for c in scenario.RANGES if c not in _WHOLE)
register(
    "s13_default_scenario",
    lambda i: scenario.default_scenario(i.orders(*_DEFAULT_COLUMNS)),
    f"SELECT {_MEDIAN_SQL}, {_FIRST_SQL} FROM d",
    rounded=_REAL_FEATURES,
)

# --- projections and filters ---------------------------------------------------------------
register(
    "p1_column_subset",
    lambda i: i.tables["products"].select("product_id", "product_category_name", "product_weight_g"),
    "SELECT product_id, product_category_name, product_weight_g FROM r_products",
)
register(
    "p2_renamed_columns",
    lambda i: i.tables["geolocation"].withColumnsRenamed(
        {"geolocation_zip_code_prefix": "customer_zip_code_prefix", "geolocation_lat": "customer_lat",
         "geolocation_lng": "customer_lng"}
    ),
    "SELECT geolocation_zip_code_prefix AS customer_zip_code_prefix, geolocation_lat AS customer_lat,"
    " geolocation_lng AS customer_lng FROM r_geolocation",
)
register(
    "p3_computed_columns",
    lambda i: i.orders("order_id", "purchase_date", "purchase_month", "purchase_year_month",
                       "purchase_weekday", "purchase_hour", "estimated_days", "delivery_days", "late_days"),
    "SELECT order_id, purchase_date, purchase_month, purchase_year_month, purchase_weekday,"
    " purchase_hour, estimated_days, delivery_days, late_days FROM e",
)
register(
    "p4_delivered",
    lambda i: i.delivered("order_id", "customer_id"),
    "SELECT order_id, customer_id FROM d",
)
register(
    "p5_labelled",
    lambda i: i.orders("order_id", "order_purchase_timestamp", "is_late").dropna(
        subset=["is_late", "order_purchase_timestamp"]
    ),
    "SELECT order_id, order_purchase_timestamp, is_late FROM e"
    " WHERE is_late IS NOT NULL AND order_purchase_timestamp IS NOT NULL",
)
_STATES = ["NATION_1", "NATION_4", "NATION_7"]
_STATE_LIST = ", ".join(f"'{s}'" for s in _STATES)
_FROM, _TO = date(1996, 3, 1), date(1999, 6, 30)
_PERIOD = "order_purchase_timestamp >= DATE '1996-03-01' AND order_purchase_timestamp < DATE '1999-07-01'"
FILTER = (_STATES, _FROM, _TO)
FILTER_SQL = f"customer_state IN ({_STATE_LIST}) AND {_PERIOD}"
register(
    "p6_state_filter",
    lambda i: kpis.filtered_orders(i.orders("order_id", "order_status", "customer_state"), _STATES).select(
        "order_id", "customer_state"
    ),
    f"SELECT order_id, customer_state FROM d WHERE customer_state IN ({_STATE_LIST})",
)
register(
    "p7_date_range",
    lambda i: kpis.filtered_orders(
        i.orders("order_id", "order_status", "order_purchase_timestamp"), start=_FROM, end=_TO
    ).select("order_id", "order_purchase_timestamp"),
    f"SELECT order_id, order_purchase_timestamp FROM d WHERE {_PERIOD}",
)
REVIEW_PAIR = (
    "SELECT avg(CASE WHEN is_late = 0 THEN review_score END) AS on_time_review,"
    " avg(CASE WHEN is_late = 1 THEN review_score END) AS late_review FROM d"
)
REVIEW_COLUMNS = ("order_id", "order_status", "is_late", "review_score")
register(
    "p8_masked_means",
    lambda i: kpis.mean_review_by_lateness(i.orders(*REVIEW_COLUMNS)),
    REVIEW_PAIR,
    rounded=("on_time_review", "late_review"),
)
register(
    "p9_large_categories",
    lambda i: kpis.category_performance(
        i.orders("order_id", "order_status", "primary_category", "total_payment", "is_late", "review_score")
    ).where("orders >= 500").select("primary_category", "orders", "revenue"),
    f"SELECT primary_category, count(DISTINCT order_id) AS orders, {PAID_TOTAL} AS revenue FROM d"
    " WHERE primary_category IS NOT NULL GROUP BY primary_category HAVING count(DISTINCT order_id) >= 500",
)

COHORT_COLUMNS = ("order_id", "order_status", "customer_unique_id", "order_purchase_timestamp")
COHORT_SQL = """WITH months AS (
    SELECT DISTINCT customer_unique_id, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS order_month
    FROM d WHERE customer_unique_id IS NOT NULL AND order_purchase_timestamp IS NOT NULL
), firsts AS (
    SELECT *, min(order_month) OVER (PARTITION BY customer_unique_id) AS cohort_month FROM months
), counted AS (
    SELECT strftime(cohort_month, '%Y-%m') AS cohort_month,
           CAST((year(order_month) - year(cohort_month)) * 12 + month(order_month) - month(cohort_month) AS INT)
               AS cohort_index,
           count(DISTINCT customer_unique_id) AS customers
    FROM firsts GROUP BY 1, 2
), sizes AS (
    SELECT cohort_month, customers AS cohort_size FROM counted WHERE cohort_index = 0
)
"""
register(
    "p10_cohort_sizes",
    lambda i: cohort_counts(i.orders(*COHORT_COLUMNS)).where("cohort_index = 0").select(
        "cohort_month", F.col("customers").alias("cohort_size")
    ),
    COHORT_SQL + "SELECT cohort_month, cohort_size FROM sizes",
)
register(
    "p11_casts",
    lambda i: i.parquet("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_partkey").cast("string").alias("part"), F.col("l_suppkey").cast("double").alias("supplier"),
        F.col("l_returnflag").try_cast("int").alias("unreadable"),
    ),
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS quantity, CAST(l_partkey AS VARCHAR) AS part,"
    " CAST(l_suppkey AS DOUBLE) AS supplier, TRY_CAST(l_returnflag AS INT) AS unreadable FROM lineitem",
)
_OUTSIDE = " ".join(
    f"+ CAST(coalesce({c} NOT BETWEEN {low} AND {high}, TRUE) AS INT)" for c, (low, high) in scenario.RANGES.items()
)
register(
    "p12_scenario_ranges",
    lambda i: scenario.range_violations(i.delivered("order_id", *FEATURES)).select(
        "order_id", F.size("violations").alias("violations")
    ),
    f"SELECT order_id, CAST(0 {_OUTSIDE} AS INT) AS violations FROM d",
)
OVERALL_SQL = f"""
SELECT count(DISTINCT order_id) AS orders,
       count(DISTINCT CASE WHEN order_status = 'delivered' THEN order_id END) AS delivered_orders,
       coalesce(CAST(sum(CASE WHEN order_status = 'delivered' THEN CAST(total_payment AS DECIMAL(18, 2)) END)
           AS DOUBLE), 0.0e0) AS revenue,
       CAST(sum(CASE WHEN order_status = 'delivered' THEN CAST(total_payment AS DECIMAL(18, 2)) END) AS DOUBLE)
           / count(CASE WHEN order_status = 'delivered' THEN total_payment END) AS avg_order_value,
       avg(CASE WHEN order_status = 'delivered' THEN is_late END) AS late_rate,
       avg(CASE WHEN order_status = 'delivered' THEN review_score END) AS avg_review_score
FROM e"""
OVERALL_COLUMNS = ("order_id", "order_status", "total_payment", "is_late", "review_score")
register(
    "p13_metric_rows",
    lambda i: kpis.as_metric_rows(kpis.overall_kpis(i.orders(*OVERALL_COLUMNS))),
    f"WITH o AS ({OVERALL_SQL}), w AS (SELECT CAST(orders AS DOUBLE) AS orders,"
    " CAST(delivered_orders AS DOUBLE) AS delivered_orders, revenue, avg_order_value, late_rate,"
    " avg_review_score FROM o)\nSELECT metric, value FROM (UNPIVOT w ON COLUMNS(*) INTO NAME metric VALUE value)",
    rounded=("value",),
)

# --- joins -----------------------------------------------------------------------------------
register("j1_customer_centroids", lambda i: enrich.customers_located(i.tables), "SELECT * FROM customers_located")
register("j2_seller_centroids", lambda i: enrich.sellers_located(i.tables), "SELECT * FROM sellers_located")
register("j3_translated_products", lambda i: enrich.products_described(i.tables), "SELECT * FROM products_described")
register(
    "j4_item_products",
    lambda i: enrich.item_details(i.tables, ["primary_category", "avg_product_weight_g", "avg_product_volume_cm3"]),
    "SELECT order_id, order_item_id, product_id, seller_id, price, freight_value, category,"
    " product_weight_g, product_volume_cm3 FROM item_details",
)
register(
    "j5_item_sellers",
    lambda i: enrich.item_details(i.tables, ["primary_seller_state"]),
    "SELECT order_id, order_item_id, product_id, seller_id, price, freight_value, seller_state FROM item_details",
)
register(
    "j6_order_coordinates",
    lambda i: i.orders("order_id", "customer_lat", "customer_lng"),
    "SELECT order_id, customer_lat, customer_lng FROM order_points",
)
register(
    "j7_item_distances",
    lambda i: enrich.item_details(i.tables, ["avg_distance_km"]).select(
        "order_id", "order_item_id", "product_id", "seller_id", "distance_km"
    ),
    "SELECT order_id, order_item_id, product_id, seller_id, distance_km FROM item_details",
    rounded=("distance_km",),
)
register(
    "j8_item_categories",
    lambda i: enrich.item_totals(i.tables, ["item_count", "primary_category"]),
    "SELECT order_id, item_count, primary_category FROM item_totals",
)
register(
    "j9_item_seller_states",
    lambda i: enrich.item_totals(i.tables, ["item_count", "primary_seller_state"]),
    "SELECT order_id, item_count, primary_seller_state FROM item_totals",
)
register(
    "j10_payment_types",
    lambda i: enrich.payment_totals(i.tables["payments"], ["total_payment", "primary_payment_type"]),
    "SELECT order_id, total_payment, primary_payment_type FROM payment_totals",
)
register(
    "j11_order_customers",
    lambda i: i.orders("order_id", "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_state"),
    "SELECT order_id, customer_id, customer_unique_id, customer_zip_code_prefix, customer_state FROM e",
)
register(
    "j12_order_items",
    lambda i: i.orders("order_id", "item_count", "total_price", "total_freight"),
    "SELECT order_id, item_count, total_price, total_freight FROM e",
)
register(
    "j13_order_payments",
    lambda i: i.orders("order_id", "total_payment", "payment_installments", "payment_count"),
    "SELECT order_id, total_payment, payment_installments, payment_count FROM e",
)
register(
    "j14_order_reviews",
    lambda i: i.orders("order_id", "review_score", "review_count"),
    "SELECT order_id, review_score, review_count FROM e",
    rounded=("review_score",),
)
register(
    "j15_cohort_share",
    lambda i: cohort_retention(i.orders(*COHORT_COLUMNS)).select(
        "cohort_month", "cohort_index", "customers", "cohort_size"
    ),
    COHORT_SQL + "SELECT cohort_month, cohort_index, customers, cohort_size FROM counted"
    " LEFT JOIN sizes USING (cohort_month)",
)

# --- sorts and top-k -----------------------------------------------------------------------------
register(
    "o1_first_payment",
    lambda i: enrich.payment_totals(i.tables["payments"], ["primary_payment_type"]),
    "SELECT order_id, primary_payment_type FROM primary_payments",
)
STATE_COLUMNS = ("order_id", "order_status", "customer_state", "total_payment", "is_late", "delivery_days",
                  "review_score")
register(
    "o2_states_by_revenue",
    lambda i: kpis.by_revenue(
        kpis.state_performance(i.orders(*STATE_COLUMNS)).select("customer_state", "orders", "revenue"),
        "customer_state",
    ),
    f"SELECT customer_state, count(DISTINCT order_id) AS orders, {PAID_TOTAL} AS revenue FROM d"
    " WHERE customer_state IS NOT NULL GROUP BY customer_state ORDER BY revenue DESC, customer_state",
)
LANE_COLUMNS = ("order_id", "order_status", "customer_state", "primary_seller_state", "avg_distance_km",
                 "delivery_days", "is_late")
register(
    "o3_lanes_ranked",
    lambda i: business_sql.delivery_lanes(i.spark, i.orders(*LANE_COLUMNS), min_orders=5),
    lanes_sql(5),
)
register(
    "o4_months_in_order",
    lambda i: kpis.monthly_trend(
        i.delivered("order_id", "purchase_year_month", "total_payment", "is_late")
    ).select("purchase_year_month", "orders").orderBy("purchase_year_month"),
    "SELECT purchase_year_month, count(DISTINCT order_id) AS orders FROM d GROUP BY 1 ORDER BY 1",
)
register(
    "o5_top_categories",
    lambda i: kpis.top_categories(i.delivered("primary_category", "total_payment"), 5),
    f"SELECT * FROM (SELECT primary_category, {PAID_TOTAL} AS total_payment FROM d"
    " WHERE primary_category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5) ORDER BY 2, 1 DESC",
)
CATEGORY_COLUMNS = ("order_id", "order_status", "primary_category", "total_payment", "is_late", "review_score")
register(
    "o7_leading_category",
    lambda i: leader(kpis.category_performance(i.orders(*CATEGORY_COLUMNS)), "primary_category"),
    f"SELECT primary_category, {PAID_TOTAL} AS revenue, count(DISTINCT order_id) AS orders FROM d"
    " WHERE primary_category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
)
register(
    "o8_chronological",
    lambda i: row_positions(
        i.delivered("order_id", "order_purchase_timestamp"),
        [F.col("order_purchase_timestamp"), F.col("order_id")],
    ),
    "SELECT order_id, order_purchase_timestamp,"
    " row_number() OVER (ORDER BY order_purchase_timestamp, order_id) - 1 AS position FROM d",
)

# --- scalar functions --------------------------------------------------------------------------
_DIRTY_DATE = "CASE WHEN o_orderkey % 7 = 0 THEN 'unknown' ELSE CAST(o_orderdate AS {text}) END"
register(
    "f1_parsed_timestamps",
    lambda i: i.parquet("orders").select(
        "o_orderkey", scalar.parse_timestamp(F.expr(_DIRTY_DATE.format(text="STRING"))).alias("parsed")
    ),
    f"SELECT o_orderkey, TRY_CAST({_DIRTY_DATE.format(text='VARCHAR')} AS TIMESTAMP) AS parsed FROM orders",
)
register(
    "f2_haversine",
    lambda i: i.tables["geolocation"].select(
        "geolocation_lat", "geolocation_lng",
        scalar.haversine_km(F.col("geolocation_lat"), F.col("geolocation_lng"), F.lit(-23.55), F.lit(-46.63))
        .alias("distance_km"),
    ),
    """SELECT geolocation_lat, geolocation_lng, 2 * 6371.0088 * asin(sqrt(
        power(sin((radians(-23.55) - radians(geolocation_lat)) / 2), 2)
        + cos(radians(geolocation_lat)) * cos(radians(-23.55))
          * power(sin(radians(-46.63 - geolocation_lng) / 2), 2))) AS distance_km FROM r_geolocation""",
    rounded=("distance_km",),
)
register(
    "f3_category",
    lambda i: enrich.products_described(i.tables).select("product_id", "category"),
    "SELECT product_id, category FROM products_described",
)
register(
    "f4_volume",
    lambda i: enrich.products_described(i.tables).select("product_id", "product_volume_cm3"),
    "SELECT product_id, product_volume_cm3 FROM products_described",
)
for _id, _name, _column in (
    ("f5", "date_part", "purchase_date"),
    ("f6", "month_number", "purchase_month"),
    ("f7", "year_month", "purchase_year_month"),
    ("f8", "weekday", "purchase_weekday"),
    ("f9", "hour", "purchase_hour"),
    ("f11", "late_flag", "is_late"),
):
    register(
        f"{_id}_{_name}",
        lambda i, column=_column: i.orders("order_id", column),
        f"SELECT order_id, {_column} FROM e",
    )
register(
    "f10_day_differences",
    lambda i: i.orders("order_id", "estimated_days", "delivery_days", "late_days"),
    "SELECT order_id, estimated_days, delivery_days, late_days FROM e",
)
register(
    "f12_freight_ratio",
    lambda i: i.orders("order_id", "freight_ratio"),
    "SELECT order_id, freight_ratio FROM e",
)
_REFERENCE_SQL = (
    "WITH ref AS (SELECT CAST(CAST(max(order_purchase_timestamp) AS DATE) + 1 AS TIMESTAMP) AS reference_date FROM d)"
)
register(
    "f13_reference_date",
    lambda i: reference_date(i.orders("order_status", "order_purchase_timestamp")),
    _REFERENCE_SQL + "\nSELECT reference_date FROM ref",
)


def _recency_per_order(i):
    orders = i.orders("order_id", "order_status", "order_purchase_timestamp")
    as_of = reference_date(orders).scalar()
    return kpis.delivered_orders(orders).select(
        "order_id", scalar.whole_days_between(F.col("order_purchase_timestamp"), as_of).alias("recency_days")
    )


_RECENCY = "CAST(floor((epoch_us(reference_date) - epoch_us({ts})) / 86400000000e0) AS BIGINT)"
register(
    "f14_whole_days",
    _recency_per_order,
    _REFERENCE_SQL + "\nSELECT order_id, " + _RECENCY.format(ts="order_purchase_timestamp")
    + " AS recency_days FROM d, ref",
)
register(
    "f16_month_difference",
    lambda i: active_months(i.orders(*COHORT_COLUMNS)).select(
        "customer_unique_id", "order_month",
        scalar.months_between_months(F.col("cohort_month"), F.col("order_month")).alias("cohort_index"),
    ),
    COHORT_SQL + "SELECT customer_unique_id, order_month, CAST((year(order_month) - year(cohort_month)) * 12"
    " + month(order_month) - month(cohort_month) AS INT) AS cohort_index FROM firsts",
)
register(
    "f17_case_label",
    lambda i: i.delivered("order_id", "is_late").select(
        "order_id", scalar.delivery_result(F.col("is_late")).alias("delivery_result")
    ),
    "SELECT order_id, CASE WHEN is_late = 1 THEN 'Late' ELSE 'On time' END AS delivery_result FROM d",
)
register(
    "f18_rounding",
    lambda i: i.delivered("order_id", "avg_distance_km", "delivery_days", "review_score").select(
        "order_id", scalar.round_half_away(F.col("avg_distance_km")).alias("km"),
        scalar.round_half_away(F.col("delivery_days"), 1).alias("days"),
        scalar.round_half_away(F.col("review_score"), 2).alias("score"),
    ),
    "SELECT order_id, round(avg_distance_km, 0) AS km, round(delivery_days, 1) AS days,"
    " round(review_score, 2) AS score FROM d",
)
register(
    "f19_value_map",
    lambda i: i.delivered("order_id", "is_late").select(
        "order_id", scalar.delivery_result(F.col("is_late"), "null").alias("delivery_result")
    ),
    "SELECT order_id, CASE is_late WHEN 1 THEN 'Late' WHEN 0 THEN 'On time' END AS delivery_result FROM d",
)
register(
    "f20_percent",
    lambda i: i.delivered("purchase_year_month", "is_late").groupBy("purchase_year_month").agg(
        scalar.percent(F.avg("is_late")).alias("late_pct")
    ),
    "SELECT purchase_year_month, 100 * avg(is_late) AS late_pct FROM d GROUP BY 1",
)
register(
    "f21_retention_ratio",
    lambda i: cohort_retention(i.orders(*COHORT_COLUMNS)).select("cohort_month", "cohort_index", "retention_rate"),
    COHORT_SQL + "SELECT cohort_month, cohort_index, customers / cohort_size AS retention_rate FROM counted"
    " LEFT JOIN sizes USING (cohort_month)",
)
register(
    "f22_report_text",
    lambda i: kpis.monthly_kpis(
        i.orders("order_id", "order_status", "purchase_year_month", "total_payment", "is_late", "review_score")
    ).select(
        scalar.title_text(F.concat(F.lit("month_"), "purchase_year_month")).alias("month"),
        scalar.count_text(F.col("orders")).alias("orders"),
        scalar.money_text(F.col("revenue")).alias("revenue"),
        scalar.number_text(F.col("avg_review_score"), 2).alias("review"),
        scalar.percent_text(F.col("late_rate")).alias("late_rate"),
    ),
    f"""SELECT 'Month ' || purchase_year_month AS month, format('{{:,}}', count(DISTINCT order_id)) AS orders,
        'R$ ' || format('{{:,}}', CAST(printf('%.0f', {PAID_SUM}) AS BIGINT)) AS revenue,
        printf('%.2f', round(avg(review_score), 9)) AS review,
        printf('%.1f%%', round(avg(is_late) * 100, 9)) AS late_rate
        FROM d GROUP BY purchase_year_month""",
)


def _thresholded(i):
    return i.delivered("order_id").select(
        "order_id", (F.col("order_id") * 7919 % 1000 / 1000.0).alias("score")
    ).withColumn("point", (F.col("order_id") % 76).cast("int")).select(
        "order_id",
        scalar.threshold_at(F.col("point")).alias("threshold"),
        scalar.reaches(F.col("score"), scalar.threshold_at(F.col("point"))).alias("predicted"),
    )


register(
    "f24_threshold_grid",
    lambda i: _thresholded(i).select("order_id", "threshold"),
    "SELECT order_id, 0.05e0 + (order_id % 76) * 0.01e0 AS threshold FROM d",
)
register(
    "f25_threshold_compare",
    lambda i: _thresholded(i).select("order_id", "predicted"),
    "SELECT order_id, CASE WHEN (order_id * 7919 % 1000) / 1000e0 >= 0.05e0 + (order_id % 76) * 0.01e0"
    " THEN 1 ELSE 0 END AS predicted FROM d",
)

# --- per-customer and per-order labels -------------------------------------------------------------
RFM_COLUMNS = ("order_id", "order_status", "customer_unique_id", "order_purchase_timestamp", "total_payment")
# The segment of each recency score (row, from 1) and frequency score (column, from 1).
_SEGMENT_GRID = (
    ("Hibernating", "Hibernating", "At risk", "At risk"),
    ("Hibernating", "Hibernating", "At risk", "At risk"),
    ("Recent", "Recent", "Loyal", "Loyal"),
    ("Recent", "Recent", "Champions", "Champions"),
)
_SEGMENT_ROWS = " UNION ALL ".join(
    f"SELECT {r} AS r_score, {f} AS f_score, '{segment}' AS segment"
    for r, labels in enumerate(_SEGMENT_GRID, 1)
    for f, segment in enumerate(labels, 1)
)
RFM_SQL = _REFERENCE_SQL + f""", base AS (
    SELECT customer_unique_id, {_RECENCY.format(ts="max(order_purchase_timestamp)")} AS recency_days,
           count(DISTINCT order_id) AS frequency, {PAID_TOTAL} AS monetary
    FROM d, ref WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id, reference_date
), placed AS (
    SELECT *, count(*) OVER () AS n,
           row_number() OVER (ORDER BY recency_days, customer_unique_id) AS r,
           row_number() OVER (ORDER BY frequency, customer_unique_id) AS f,
           row_number() OVER (ORDER BY monetary, customer_unique_id) AS m
    FROM base
), scored AS (
    SELECT customer_unique_id, recency_days, frequency, monetary,
           CAST(5 - (4 * r + n - 1) // n AS INT) AS r_score,
           CAST((4 * f + n - 1) // n AS INT) AS f_score,
           CAST((4 * m + n - 1) // n AS INT) AS m_score
    FROM placed
), segmented AS (
    SELECT scored.*, segment FROM scored JOIN ({_SEGMENT_ROWS}) AS grid USING (r_score, f_score)
)
"""
register(
    "f15_quartile_buckets",
    lambda i: rfm(i.orders(*RFM_COLUMNS)).select("customer_unique_id", "m_score"),
    RFM_SQL + "SELECT customer_unique_id, m_score FROM scored",
)
register(
    "u1_segments",
    lambda i: rfm(i.orders(*RFM_COLUMNS)).select("customer_unique_id", "segment"),
    RFM_SQL + "SELECT customer_unique_id, segment FROM segmented",
)
register(
    "u2_recency",
    lambda i: rfm_base(i.orders(*RFM_COLUMNS)).select("customer_unique_id", "recency_days"),
    RFM_SQL + "SELECT customer_unique_id, recency_days FROM base",
)
register(
    "u3_assigned_label",
    lambda i: i.delivered("order_id", "is_late", "review_score")
    .where(F.col("review_score").isNotNull())
    .withColumn("delivery_result", scalar.delivery_result(F.col("is_late"), "null"))
    .select("order_id", "delivery_result"),
    "SELECT order_id, CASE is_late WHEN 1 THEN 'Late' WHEN 0 THEN 'On time' END AS delivery_result FROM d"
    " WHERE review_score IS NOT NULL",
)
register(
    "a3_primary_category",
    lambda i: primary_value(
        enrich.item_details(i.tables, ["primary_category"]), "order_id", "category", "primary_category"
    ),
    "SELECT order_id, primary_category FROM primary_categories",
)
