"""A small hand-made set of the nine tables with text ids."""

from __future__ import annotations

from datetime import datetime


def at(text):
    return datetime.fromisoformat(text) if text else None


def commerce_tables(spark):
    def build(schema, rows):
        return spark.createDataFrame(rows, schema)

    orders = build(
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
        " order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
        " order_estimated_delivery_date timestamp_ntz",
        [
            # late by a day
            ("o1", "c1", "delivered", at("2018-01-01 12:00"), None, None, at("2018-01-11 00:00"), at("2018-01-10 00:00")),
            # exactly on time
            ("o2", "c2", "delivered", at("2018-01-05 00:00"), None, None, at("2018-01-09 00:00"), at("2018-01-09 00:00")),
            # delivered without a promise
            ("o3", "c3", "delivered", at("2018-07-20 15:00"), None, None, at("2018-07-25 00:00"), None),
            # marked delivered, but no date
            ("o4", "c1", "delivered", at("2018-07-31 23:59:59"), None, None, None, at("2018-08-20 00:00")),
            ("o5", "c4", "shipped", at("2018-08-02 10:00"), None, None, None, at("2018-08-30 00:00")),
            # a month with an unpaid order only
            ("o6", "c5", "delivered", at("2018-03-03 03:03"), None, None, at("2018-03-05 00:00"), at("2018-03-20 00:00")),
        ],
    )
    customers = build(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_state string",
        [
            ("c1", "p1", 1037, "SP"), ("c2", "p2", 2000, "RJ"), ("c3", "p2", 2000, "RJ"),
            ("c4", "p4", 9999, "MG"), ("c5", "p5", 1037, "SP"),
        ],
    )
    geolocation = build(
        "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double",
        [(1037, 1.0, 10.0), (1037, 2.0, 20.0), (1037, 4.0, 30.0), (1037, 9.0, 90.0), (2000, -22.9, -43.2)],
    )
    items = build(
        "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double",
        [
            ("o1", 1, "x", "s1", 10.0, 1.0), ("o1", 2, "x", "s1", 10.0, 1.0), ("o1", 3, "y", "s2", 30.0, 2.5),
            ("o2", 1, "y", "s2", 0.0, 5.0),
            ("o3", 1, "z", "s3", 7.0, 0.7), ("o4", 1, "w", "s1", 5.0, 0.5), ("o5", 1, "x", "s1", 1.0, 1.0),
        ],
    )
    payments = build(
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
        [
            ("o1", 1, "card", 3, 5.0), ("o1", 3, "slip", 1, 9.0), ("o1", 2, "voucher", 2, 9.0),
            ("o2", 1, "card", 1, 5.0), ("o3", 1, "card", 1, 7.7), ("o4", 1, "slip", 1, 5.5), ("o5", 1, "card", 8, 2.0),
        ],
    )
    reviews = build(
        "review_id string, order_id string, review_score int",
        [("r1", "o1", 1), ("r2", "o1", 2), ("r2", "o1", 3), ("r3", "o2", 5), ("r4", "o3", 4)],
    )
    products = build(
        "product_id string, product_category_name string, product_weight_g double, product_length_cm double,"
        " product_height_cm double, product_width_cm double",
        [
            ("x", "beleza", 100.0, 1.0, 2.0, 3.0), ("y", "pcs", 200.0, 2.0, 2.0, 2.0),
            ("z", None, None, 1.0, 1.0, None), ("w", None, 50.0, 1.0, 1.0, 1.0),
        ],
    )
    sellers = build(
        "seller_id string, seller_zip_code_prefix int, seller_state string",
        [("s1", 2000, "RJ"), ("s2", 1037, "SP"), ("s3", 5555, "PR")],
    )
    translation = build(
        "product_category_name string, product_category_name_english string", [("beleza", "beauty")]
    )
    return {
        "customers": customers, "geolocation": geolocation, "items": items, "orders": orders, "payments": payments,
        "products": products, "reviews": reviews, "sellers": sellers, "translation": translation,
    }
