"""The nine commerce tables as projections of the test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordergrain.sources.tables import literal_table

# Translated product types; PROMO is left without a translation.
TRANSLATIONS = {
    "STANDARD": "standard",
    "SMALL": "small",
    "LARGE": "large",
    "ECONOMY": "economy",
    "MEDIUM": "medium",
}


# The columns of the test tables. Declared, so that no query opens a file to look them up.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

Reader = Callable[[str], DataFrame]


def _after(unit: str, amount: str) -> str:
    return f"timestampadd({unit}, CAST({amount} AS INT), o_orderdate)"


def _orders(read: Reader) -> DataFrame:
    return read("orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'"
        " ELSE 'canceled' END AS order_status",
        _after("MINUTE", "o_orderkey % 1440") + " AS order_purchase_timestamp",
        _after("MINUTE", "o_orderkey % 1440 + 30") + " AS order_approved_at",
        _after("HOUR", "24") + " AS order_delivered_carrier_date",
        "CASE WHEN o_orderkey % 97 <> 0 THEN "
        + _after("HOUR", "24 + (o_orderkey * 31 + o_custkey) % 936")
        + " END AS order_delivered_customer_date",
        "CASE WHEN o_orderkey % 211 <> 0 THEN "
        + _after("DAY", "15 + o_orderkey % 20")
        + " END AS order_estimated_delivery_date",
    )


def _customers(read: Reader) -> DataFrame:
    nation = read("nation").select("n_nationkey", "n_name")
    return (
        read("customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "c_custkey AS customer_id",
            "c_custkey - c_custkey % 2 AS customer_unique_id",
            "CAST(CASE WHEN c_custkey % 50 = 0 THEN c_nationkey + 100 ELSE c_nationkey END"
            " AS INT) AS customer_zip_code_prefix",
            "n_name AS customer_state",
        )
    )


def _geolocation(read: Reader) -> DataFrame:
    return read("customer").selectExpr(
        "CAST(c_nationkey AS INT) AS geolocation_zip_code_prefix",
        "CAST(-33 + (c_custkey * 7 % 380) / CAST(10 AS DOUBLE) AS DOUBLE) AS geolocation_lat",
        "CAST(-73 + (c_custkey * 13 % 380) / CAST(10 AS DOUBLE) AS DOUBLE) AS geolocation_lng",
    )


def _sellers(read: Reader) -> DataFrame:
    nation = read("nation").select("n_nationkey", "n_name")
    return (
        read("supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "s_suppkey AS seller_id",
            "CAST(s_nationkey AS INT) AS seller_zip_code_prefix",
            "n_name AS seller_state",
        )
    )


def _products(read: Reader) -> DataFrame:
    return read("part").selectExpr(
        "p_partkey AS product_id",
        "CASE WHEN p_partkey % 40 <> 0 THEN p_type END AS product_category_name",
        "CASE WHEN p_partkey % 60 <> 0 THEN CAST(p_size * 100 AS DOUBLE) END AS product_weight_g",
        "CAST(10 + p_size AS DOUBLE) AS product_length_cm",
        "CAST(5 + p_partkey % 40 AS DOUBLE) AS product_height_cm",
        "CAST(8 + p_partkey % 25 AS DOUBLE) AS product_width_cm",
    )


def _items(read: Reader) -> DataFrame:
    return read("lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_extendedprice AS price",
        "l_quantity AS freight_value",
    )


def _payments(read: Reader) -> DataFrame:
    return read("lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        "l_returnflag AS payment_type",
        "CAST(1 + l_linenumber % 10 AS INT) AS payment_installments",
        "l_extendedprice AS payment_value",
    )


def _reviews(read: Reader) -> DataFrame:
    return read("events").selectExpr(
        "event_id AS review_id",
        "event_id - event_id % 3 AS order_id",
        "CAST(1 + (event_id - event_id % 3 + event_id % 2) * 7 % 5 AS INT) AS review_score",
    )


_PROJECTIONS: dict[str, Callable[[Reader], DataFrame]] = {
    "customers": _customers,
    "geolocation": _geolocation,
    "items": _items,
    "orders": _orders,
    "payments": _payments,
    "products": _products,
    "reviews": _reviews,
    "sellers": _sellers,
}


class RoleTables(Mapping[str, DataFrame]):
    """The nine tables of one test-data folder; a table's files are opened when it is first used."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark = spark
        self._folder = folder
        self._opened: dict[str, DataFrame] = {}
        self._files: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self._spark.read.schema(SCHEMAS[name]).parquet(f"{self._folder}/{name}.parquet")
        return self._files[name]

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._opened:
            if table == "translation":
                rows = [
                    {"product_category_name": name, "product_category_name_english": english}
                    for name, english in TRANSLATIONS.items()
                ]
                self._opened[table] = literal_table(self._spark, rows)
            else:
                self._opened[table] = _PROJECTIONS[table](self._read)
        return self._opened[table]

    def __iter__(self) -> Iterator[str]:
        return iter([*_PROJECTIONS, "translation"])

    def __len__(self) -> int:
        return len(_PROJECTIONS) + 1
