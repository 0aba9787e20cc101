"""One row per order out of the nine source tables.

Items, payments and reviews are each aggregated to one row per order before they are joined, so
several of each on one order cannot multiply. All three are keyed by ``order_id``, so the joins
reuse the partitioning of the aggregates. No side is broadcast by hint: Spark broadcasts the
lookup tables when their measured size allows it, and otherwise splits hot keys of the
sort-merge join at run time (see ``ordergrain.session``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordergrain.functions import scalar
from ordergrain.functions.aggregates import money_sum_or_zero
from ordergrain.operators.primary import largest_payment_type, most_frequent
from ordergrain.operators.ranking import grouped_medians
from ordergrain.sources.schemas import (
    CUSTOMER_COLUMNS,
    DERIVED_COLUMNS,
    ITEM_COLUMNS,
    PAYMENT_COLUMNS,
    REVIEW_COLUMNS,
    SOURCE_TYPES,
)

Tables = Mapping[str, DataFrame]

# Derived columns that read a joined part, and what they read.
_READS = {"freight_ratio": ("total_freight", "total_price")}


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """Exact median coordinates per ZIP prefix: ``(zip, lat, lng)``."""
    points = geolocation.selectExpr(
        "geolocation_zip_code_prefix AS zip", "geolocation_lat AS lat", "geolocation_lng AS lng"
    )
    return grouped_medians(points, "zip", ["lat", "lng"])


def _located(df: DataFrame, centroids: DataFrame, role: str) -> DataFrame:
    key = f"{role}_zip_code_prefix"
    points = centroids.withColumnsRenamed({"zip": key, "lat": f"{role}_lat", "lng": f"{role}_lng"})
    return df.join(points, key, "left")


def customers_located(tables: Tables, centroids: DataFrame | None = None) -> DataFrame:
    if centroids is None:
        centroids = zip_centroids(tables["geolocation"])
    return _located(tables["customers"], centroids, "customer")


def sellers_located(tables: Tables, centroids: DataFrame | None = None) -> DataFrame:
    if centroids is None:
        centroids = zip_centroids(tables["geolocation"])
    return _located(tables["sellers"], centroids, "seller")


def products_described(tables: Tables) -> DataFrame:
    """Products with their English category where there is one, and their volume."""
    return (
        tables["products"]
        .join(tables["translation"], "product_category_name", "left")
        .withColumns(
            {
                "category": F.coalesce("product_category_name_english", "product_category_name"),
                "product_volume_cm3": scalar.box_volume(
                    F.col("product_length_cm"),
                    F.col("product_height_cm"),
                    F.col("product_width_cm"),
                ),
            }
        )
    )


_PRODUCT_INPUTS = {
    "primary_category": "category",
    "avg_product_weight_g": "product_weight_g",
    "avg_product_volume_cm3": "product_volume_cm3",
}


def item_details(
    tables: Tables, columns: Iterable[str] = ITEM_COLUMNS, centroids: DataFrame | None = None
) -> DataFrame:
    """Order items with the product, seller and customer facts that ``columns`` need."""
    columns = set(columns)
    details = tables["items"]
    product_facts = [fact for column, fact in _PRODUCT_INPUTS.items() if column in columns]
    if product_facts:
        details = details.join(
            products_described(tables).select("product_id", *product_facts), "product_id", "left"
        )
    distance = "avg_distance_km" in columns
    if distance and centroids is None:
        centroids = zip_centroids(tables["geolocation"])
    seller_facts = ["seller_state"] if "primary_seller_state" in columns else []
    if distance or seller_facts:
        sellers = sellers_located(tables, centroids) if distance else tables["sellers"]
        seller_facts += ["seller_lat", "seller_lng"] if distance else []
        details = details.join(sellers.select("seller_id", *seller_facts), "seller_id", "left")
    if distance:
        order_points = (
            tables["orders"]
            .select("order_id", "customer_id")
            .join(
                customers_located(tables, centroids).select("customer_id", "customer_lat", "customer_lng"),
                "customer_id",
                "left",
            )
            .select("order_id", "customer_lat", "customer_lng")
        )
        details = details.join(order_points, "order_id", "left").withColumn(
            "distance_km",
            scalar.haversine_km(
                F.col("customer_lat"), F.col("customer_lng"), F.col("seller_lat"), F.col("seller_lng")
            ),
        )
    return details


def item_totals(
    tables: Tables, columns: Iterable[str] = ITEM_COLUMNS, centroids: DataFrame | None = None
) -> DataFrame:
    """Per order: counts, price and freight totals, product means and primary values.

    Every distinct count is two narrow aggregates of its own over the bare items. Together, or with the
    others, every item would be copied for each count.
    """
    wanted = [c for c in ITEM_COLUMNS if c in set(columns)]
    counted = {"unique_product_count": "product_id", "seller_count": "seller_id"}
    measures = {
        "item_count": lambda: F.count("order_item_id"),
        "total_price": lambda: money_sum_or_zero(F.col("price")),
        "total_freight": lambda: money_sum_or_zero(F.col("freight_value")),
        "avg_product_weight_g": lambda: F.avg("product_weight_g"),
        "avg_product_volume_cm3": lambda: F.avg("product_volume_cm3"),
        "avg_distance_km": lambda: F.avg("distance_km"),
        "primary_category": lambda: most_frequent(F.col("category")),
        "primary_seller_state": lambda: most_frequent(F.col("seller_state")),
    }
    items = tables["items"].where(F.col("order_id").isNotNull())
    sides = []
    others = [c for c in wanted if c in measures]
    if others:
        details = item_details({**tables, "items": items}, others, centroids)
        sides.append(details.groupBy("order_id").agg(*[measures[name]().alias(name) for name in others]))
    for name in wanted:
        if name in counted:
            pairs = items.select("order_id", counted[name]).distinct()
            sides.append(pairs.groupBy("order_id").agg(F.count(counted[name]).alias(name)))
    return reduce(lambda a, b: a.join(b, "order_id"), sides).select("order_id", *wanted)


def payment_totals(payments: DataFrame, columns: Iterable[str] = PAYMENT_COLUMNS) -> DataFrame:
    """Per order: amount paid, most installments, payment count, type of the largest payment."""
    wanted = [c for c in PAYMENT_COLUMNS if c in set(columns)]
    amount = F.col("payment_value")
    measures = {
        "total_payment": lambda: money_sum_or_zero(amount),
        "payment_installments": lambda: F.max("payment_installments"),
        "payment_count": lambda: F.count("payment_sequential"),
        "primary_payment_type": lambda: largest_payment_type(
            F.col("payment_type"), amount, F.col("payment_sequential")
        ),
    }
    return (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(*[measures[name]().alias(name) for name in wanted])
    )


def review_totals(reviews: DataFrame, columns: Iterable[str] = REVIEW_COLUMNS) -> DataFrame:
    """Per order: mean score and number of different reviews."""
    wanted = [c for c in REVIEW_COLUMNS if c in set(columns)]
    measures = {
        "review_score": lambda: F.avg("review_score"),
        "review_count": lambda: F.count_distinct("review_id"),
    }
    return (
        reviews.where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(*[measures[name]().alias(name) for name in wanted])
    )


def order_times(df: DataFrame) -> DataFrame:
    """Add calendar parts, promised and actual durations and the late flag."""
    bought = F.col("order_purchase_timestamp")
    promised = F.col("order_estimated_delivery_date")
    arrived = F.col("order_delivered_customer_date")
    return df.withColumns(
        {
            "purchase_date": F.to_date(bought),
            "purchase_month": F.month(bought),
            "purchase_year_month": scalar.year_month(bought),
            "purchase_weekday": F.weekday(bought),
            "purchase_hour": F.hour(bought),
            "estimated_days": scalar.days_between(bought, promised),
            "delivery_days": scalar.days_between(bought, arrived),
            "late_days": scalar.days_between(promised, arrived),
            "is_late": scalar.late_flag(arrived, scalar.days_between(promised, arrived)),
        }
    )


def parsed_orders(orders: DataFrame) -> DataFrame:
    """Orders whose five dates are timestamps; text that is no date becomes null."""
    texts = [c for c in SOURCE_TYPES["orders"] if dict(orders.dtypes).get(c) == "string"]
    return orders.withColumns({c: scalar.parse_timestamp(F.col(c)) for c in texts}) if texts else orders


def enrich_orders(tables: Tables, columns: Iterable[str] | None = None) -> DataFrame:
    """The order-grain table, or only the given columns of it.

    With ``columns``, tables and aggregates that none of them needs are not read at all.
    """
    asked = None if columns is None else list(columns)
    needed = set(asked or ())
    for column in asked or ():
        needed.update(_READS.get(column, ()))

    def part(names: tuple[str, ...]) -> list[str]:
        return [n for n in names if asked is None or n in needed]

    result = parsed_orders(tables["orders"])
    customer, item = part(CUSTOMER_COLUMNS), part(ITEM_COLUMNS)
    coordinates = "customer_lat" in customer or "customer_lng" in customer
    centroids = None
    if coordinates or "avg_distance_km" in item:
        centroids = zip_centroids(tables["geolocation"])
    if customer:
        facts = customers_located(tables, centroids) if coordinates else tables["customers"]
        if asked is not None:
            facts = facts.select("customer_id", *customer)
        result = result.join(facts, "customer_id", "left")
    if item:
        result = result.join(item_totals(tables, item, centroids), "order_id", "left")
    payment = part(PAYMENT_COLUMNS)
    if payment:
        result = result.join(payment_totals(tables["payments"], payment), "order_id", "left")
    review = part(REVIEW_COLUMNS)
    if review:
        result = result.join(review_totals(tables["reviews"], review), "order_id", "left")
    if asked is None or needed.intersection(DERIVED_COLUMNS):
        result = order_times(result)
    if asked is None or "freight_ratio" in needed:
        result = result.withColumn(
            "freight_ratio", scalar.safe_ratio(F.col("total_freight"), F.col("total_price"))
        )
    return result if asked is None else result.select(*asked)
