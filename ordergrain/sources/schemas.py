"""Names and types of the source tables and of the enriched order table."""

from __future__ import annotations

# How the names of the nine source files end, by table.
SOURCE_FILES = {
    "customers": "customers_dataset.csv",
    "geolocation": "geolocation_dataset.csv",
    "items": "order_items_dataset.csv",
    "orders": "orders_dataset.csv",
    "payments": "order_payments_dataset.csv",
    "products": "products_dataset.csv",
    "reviews": "order_reviews_dataset.csv",
    "sellers": "sellers_dataset.csv",
    "translation": "product_category_name_translation.csv",
}

# Columns that are not text, by table.
SOURCE_TYPES = {
    "customers": {"customer_zip_code_prefix": "int"},
    "geolocation": {
        "geolocation_zip_code_prefix": "int",
        "geolocation_lat": "double",
        "geolocation_lng": "double",
    },
    "items": {"order_item_id": "int", "price": "double", "freight_value": "double"},
    "orders": {
        "order_purchase_timestamp": "timestamp_ntz",
        "order_approved_at": "timestamp_ntz",
        "order_delivered_carrier_date": "timestamp_ntz",
        "order_delivered_customer_date": "timestamp_ntz",
        "order_estimated_delivery_date": "timestamp_ntz",
    },
    "payments": {
        "payment_sequential": "int",
        "payment_installments": "int",
        "payment_value": "double",
    },
    "products": {
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
    "reviews": {"review_score": "int"},
    "sellers": {"seller_zip_code_prefix": "int"},
    "translation": {},
}

# Tables with typed-in text, whose cells may span lines.
FREE_TEXT_TABLES = ("reviews",)

# Types of the derived tables when they are read back from CSV.
DERIVED_TYPES = {
    "monthly": {
        "orders": "bigint", "revenue": "double", "avg_order_value": "double",
        "late_rate": "double", "avg_review_score": "double",
    },
    "category": {
        "orders": "bigint", "revenue": "double", "avg_order_value": "double",
        "late_rate": "double", "avg_review_score": "double",
    },
    "state": {
        "orders": "bigint", "revenue": "double", "late_rate": "double",
        "avg_delivery_days": "double", "avg_review_score": "double",
    },
    "cohort": {
        "cohort_index": "int", "customers": "bigint", "cohort_size": "bigint",
        "retention_rate": "double",
    },
    "rfm": {
        "recency_days": "bigint", "frequency": "bigint", "monetary": "double",
        "r_score": "int", "f_score": "int", "m_score": "int",
    },
    "predictions": {
        "order_purchase_timestamp": "timestamp_ntz", "is_late": "int",
        "late_probability": "double", "predicted_late": "int",
    },
    "importance": {"importance": "double"},
}

# Columns of the enriched order table that each joined part contributes.
CUSTOMER_COLUMNS = (
    "customer_unique_id", "customer_zip_code_prefix", "customer_state",
    "customer_lat", "customer_lng",
)
ITEM_COLUMNS = (
    "item_count", "unique_product_count", "seller_count", "total_price", "total_freight",
    "avg_product_weight_g", "avg_product_volume_cm3", "avg_distance_km",
    "primary_category", "primary_seller_state",
)
PAYMENT_COLUMNS = (
    "total_payment", "payment_installments", "payment_count", "primary_payment_type",
)
REVIEW_COLUMNS = ("review_score", "review_count")
DERIVED_COLUMNS = (
    "purchase_date", "purchase_month", "purchase_year_month", "purchase_weekday",
    "purchase_hour", "estimated_days", "delivery_days", "late_days", "is_late",
    "freight_ratio",
)
