"""The commerce tables and the enriched orders written as SQL common tables."""

from __future__ import annotations

_ROLES = """
r_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END
               AS order_status,
           o_orderdate + to_minutes(o_orderkey % 1440) AS order_purchase_timestamp,
           o_orderdate + to_minutes(o_orderkey % 1440 + 30) AS order_approved_at,
           o_orderdate + to_hours(24) AS order_delivered_carrier_date,
           CASE WHEN o_orderkey % 97 <> 0
                THEN o_orderdate + to_hours(24 + (o_orderkey * 31 + o_custkey) % 936) END
               AS order_delivered_customer_date,
           CASE WHEN o_orderkey % 211 <> 0
                THEN o_orderdate + to_days(CAST(15 + o_orderkey % 20 AS INT)) END
               AS order_estimated_delivery_date
    FROM orders
),
r_customers AS (
    SELECT c_custkey AS customer_id, c_custkey - c_custkey % 2 AS customer_unique_id,
           CAST(CASE WHEN c_custkey % 50 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS INT)
               AS customer_zip_code_prefix,
           n_name AS customer_state
    FROM customer JOIN nation ON n_nationkey = c_nationkey
),
r_geolocation AS (
    SELECT CAST(c_nationkey AS INT) AS geolocation_zip_code_prefix,
           CAST(-33 + (c_custkey * 7 % 380) / CAST(10 AS DOUBLE) AS DOUBLE) AS geolocation_lat,
           CAST(-73 + (c_custkey * 13 % 380) / CAST(10 AS DOUBLE) AS DOUBLE) AS geolocation_lng
    FROM customer
),
r_sellers AS (
    SELECT s_suppkey AS seller_id, CAST(s_nationkey AS INT) AS seller_zip_code_prefix,
           n_name AS seller_state
    FROM supplier JOIN nation ON n_nationkey = s_nationkey
),
r_products AS (
    SELECT p_partkey AS product_id,
           CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS product_category_name,
           CASE WHEN p_partkey % 60 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
           CAST(10 + p_size AS DOUBLE) AS product_length_cm,
           CAST(5 + p_partkey % 40 AS DOUBLE) AS product_height_cm,
           CAST(8 + p_partkey % 25 AS DOUBLE) AS product_width_cm
    FROM part
),
r_translation(product_category_name, product_category_name_english) AS (
    VALUES ('STANDARD', 'standard'), ('SMALL', 'small'), ('LARGE', 'large'),
           ('ECONOMY', 'economy'), ('MEDIUM', 'medium')
),
r_items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
           l_suppkey AS seller_id, l_extendedprice AS price, l_quantity AS freight_value
    FROM lineitem
),
r_payments AS (
    SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
           CAST(1 + l_linenumber % 10 AS INT) AS payment_installments,
           l_extendedprice AS payment_value
    FROM lineitem
),
r_reviews AS (
    SELECT event_id AS review_id, event_id - event_id % 3 AS order_id,
           CAST(1 + (event_id - event_id % 3 + event_id % 2) * 7 % 5 AS INT) AS review_score
    FROM events
)"""

_ENRICHED = """
centroids AS (
    SELECT geolocation_zip_code_prefix AS zip, median(geolocation_lat) AS lat, median(geolocation_lng) AS lng
    FROM r_geolocation GROUP BY geolocation_zip_code_prefix
),
customers_located AS (
    SELECT c.*, g.lat AS customer_lat, g.lng AS customer_lng
    FROM r_customers c LEFT JOIN centroids g ON g.zip = c.customer_zip_code_prefix
),
sellers_located AS (
    SELECT s.*, g.lat AS seller_lat, g.lng AS seller_lng
    FROM r_sellers s LEFT JOIN centroids g ON g.zip = s.seller_zip_code_prefix
),
products_described AS (
    SELECT p.*, t.product_category_name_english,
           coalesce(t.product_category_name_english, p.product_category_name) AS category,
           product_length_cm * product_height_cm * product_width_cm AS product_volume_cm3
    FROM r_products p LEFT JOIN r_translation t ON t.product_category_name = p.product_category_name
),
order_points AS (
    SELECT o.order_id, c.customer_lat, c.customer_lng
    FROM r_orders o LEFT JOIN customers_located c ON c.customer_id = o.customer_id
),
item_details AS (
    SELECT i.*, p.category, p.product_weight_g, p.product_volume_cm3, s.seller_state,
           s.seller_lat, s.seller_lng, q.customer_lat, q.customer_lng,
           2 * 6371.0088 * asin(sqrt(
               power(sin((radians(s.seller_lat) - radians(q.customer_lat)) / 2), 2)
               + cos(radians(q.customer_lat)) * cos(radians(s.seller_lat))
                 * power(sin(radians(s.seller_lng - q.customer_lng) / 2), 2))) AS distance_km
    FROM r_items i
    LEFT JOIN products_described p ON p.product_id = i.product_id
    LEFT JOIN sellers_located s ON s.seller_id = i.seller_id
    LEFT JOIN order_points q ON q.order_id = i.order_id
),
primary_categories AS (
    SELECT order_id, category AS primary_category FROM (
        SELECT order_id, category,
               row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, category) AS place
        FROM item_details WHERE category IS NOT NULL GROUP BY order_id, category
    ) WHERE place = 1
),
primary_states AS (
    SELECT order_id, seller_state AS primary_seller_state FROM (
        SELECT order_id, seller_state,
               row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, seller_state) AS place
        FROM item_details WHERE seller_state IS NOT NULL GROUP BY order_id, seller_state
    ) WHERE place = 1
),
item_sums AS (
    SELECT order_id, count(order_item_id) AS item_count,
           count(DISTINCT product_id) AS unique_product_count,
           count(DISTINCT seller_id) AS seller_count,
           CAST(sum(CAST(price AS DECIMAL(18, 2))) AS DOUBLE) AS total_price,
           CAST(sum(CAST(freight_value AS DECIMAL(18, 2))) AS DOUBLE) AS total_freight,
           avg(product_weight_g) AS avg_product_weight_g,
           avg(product_volume_cm3) AS avg_product_volume_cm3,
           avg(distance_km) AS avg_distance_km
    FROM item_details GROUP BY order_id
),
item_totals AS (
    SELECT i.*, c.primary_category, s.primary_seller_state
    FROM item_sums i
    LEFT JOIN primary_categories c ON c.order_id = i.order_id
    LEFT JOIN primary_states s ON s.order_id = i.order_id
),
payment_sums AS (
    SELECT order_id, CAST(sum(CAST(payment_value AS DECIMAL(18, 2))) AS DOUBLE) AS total_payment,
           max(payment_installments) AS payment_installments,
           count(payment_sequential) AS payment_count
    FROM r_payments GROUP BY order_id
),
primary_payments AS (
    SELECT order_id, payment_type AS primary_payment_type FROM (
        SELECT order_id, payment_type, row_number() OVER (
                   PARTITION BY order_id
                   ORDER BY payment_value DESC, payment_sequential, payment_type) AS place
        FROM r_payments
    ) WHERE place = 1
),
payment_totals AS (
    SELECT a.*, b.primary_payment_type
    FROM payment_sums a LEFT JOIN primary_payments b ON b.order_id = a.order_id
),
review_totals AS (
    SELECT order_id, avg(review_score) AS review_score, count(DISTINCT review_id) AS review_count
    FROM r_reviews GROUP BY order_id
),
joined AS (
    SELECT o.*, c.* EXCLUDE (customer_id), i.* EXCLUDE (order_id), p.* EXCLUDE (order_id),
           v.* EXCLUDE (order_id)
    FROM r_orders o
    LEFT JOIN customers_located c ON c.customer_id = o.customer_id
    LEFT JOIN item_totals i ON i.order_id = o.order_id
    LEFT JOIN payment_totals p ON p.order_id = o.order_id
    LEFT JOIN review_totals v ON v.order_id = o.order_id
),
e AS (
    SELECT *,
           CAST(order_purchase_timestamp AS DATE) AS purchase_date,
           CAST(month(order_purchase_timestamp) AS INT) AS purchase_month,
           strftime(order_purchase_timestamp, '%Y-%m') AS purchase_year_month,
           CAST(isodow(order_purchase_timestamp) - 1 AS INT) AS purchase_weekday,
           CAST(hour(order_purchase_timestamp) AS INT) AS purchase_hour,
           (epoch_us(order_estimated_delivery_date) - epoch_us(order_purchase_timestamp)) / 86400000000e0
               AS estimated_days,
           (epoch_us(order_delivered_customer_date) - epoch_us(order_purchase_timestamp)) / 86400000000e0
               AS delivery_days,
           (epoch_us(order_delivered_customer_date) - epoch_us(order_estimated_delivery_date))
               / 86400000000e0 AS late_days,
           CASE WHEN order_delivered_customer_date IS NOT NULL THEN
               CASE WHEN order_delivered_customer_date > order_estimated_delivery_date THEN 1 ELSE 0 END
           END AS is_late,
           total_freight / nullif(total_price, 0) AS freight_ratio
    FROM joined
),
d AS (
    SELECT * FROM e WHERE order_status = 'delivered'
)"""

# r_<table> are the commerce tables, e the enriched orders, d the delivered ones among them.
ROLES_AND_ENRICHED = f"WITH {_ROLES.strip()},{_ENRICHED}"

# Money: exact total, and mean as exact total over count.
PAID_SUM = "CAST(sum(CAST(total_payment AS DECIMAL(18, 2))) AS DOUBLE)"
PAID_TOTAL = f"coalesce({PAID_SUM}, 0.0e0)"
PAID_MEAN = f"{PAID_SUM} / count(total_payment)"
