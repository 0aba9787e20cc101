"""Reading source and derived tables."""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordergrain.functions.scalar import null_if_missing
from ordergrain.sources.schemas import (
    DERIVED_TYPES,
    FREE_TEXT_TABLES,
    SOURCE_FILES,
    SOURCE_TYPES,
)


# Column in which a reader counts, per row, the cells whose text is no value of their type.
UNREADABLE = "_unreadable_cells"


def typed(df: DataFrame, types: dict[str, str], *, unreadable: bool = False) -> DataFrame:
    """Null the missing-value texts, then cast by name; unreadable cells become null, and are counted if asked for."""
    columns, lost = [], [F.lit(0)]
    for name in df.columns:
        cell = null_if_missing(F.col(f"`{name}`"))
        value = cell.try_cast(types[name]) if name in types else cell
        columns.append(value.alias(name))
        if name in types:
            lost.append((cell.isNotNull() & value.isNull()).cast("int"))
    counted = [reduce(lambda a, b: a + b, lost).alias(UNREADABLE)] if unreadable else []
    return df.select(*columns, *counted)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    types: dict[str, str],
    *,
    line_breaks: bool = True,
    unreadable: bool = False,
) -> DataFrame:
    """Read a CSV by its header; every cell starts as text, so column order is free.

    The parts of one table must have equal headers, or reading them fails. ``line_breaks`` accepts
    quoted cells that span lines. Such a file cannot be split, so each part is one task; without them
    Spark reads a large file in parallel. ``unreadable`` adds the column ``UNREADABLE``.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
    reader = reader.option("multiLine", line_breaks)
    return typed(reader.csv(path), types, unreadable=unreadable)


def _source_of(path: str, folder: str, prefix: str, search: bool) -> tuple[str, str] | None:
    """Table and place (the file, or the folder of its parts) of one CSV file; None if it is foreign.

    A table is the file ``<prefix><file name>``, with or without a part number before the ending
    (``orders_dataset-00001.csv``), or any CSV file in a folder of that name with or without the ending.
    """
    *folders, file = path.removeprefix(folder).strip("/").split("/")
    for table, name in SOURCE_FILES.items():
        stem = re.escape((prefix + name).removesuffix(".csv"))
        if folders and re.fullmatch(rf"{stem}(\.csv)?", folders[-1]) and (search or len(folders) == 1):
            return table, path.rsplit("/", 1)[0]
        if not folders or search:
            if re.fullmatch(rf"{stem}\.csv", file):
                return table, path
            if re.fullmatch(rf"{stem}[-_.]\d+\.csv", file):
                return table, path.rsplit("/", 1)[0]
    return None


def find_sources(spark: SparkSession, folder: str, *, prefix: str = "", search: bool = False) -> dict[str, list[str]]:
    """All files of each source table in ``folder``, for the tables that are there.

    Names have to fit exactly. ``search`` also looks in all folders below. A table found in two
    places (two files, two folders, or a file and parts) is ambiguous and raises. Only names are
    listed; no file is opened. The driver holds the names of the CSV files.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(folder)
        .select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"))
    )
    root = re.sub(r"^file:/*", "/", folder).rstrip("/")
    found: dict[str, dict[str, list[str]]] = {}
    for row in listing.collect():
        path = re.sub(r"^file:/*", "/", row["path"])
        source = _source_of(path, root, prefix, search)
        if source:
            found.setdefault(source[0], {}).setdefault(source[1], []).append(path)
    for table, places in found.items():
        if len(places) > 1:
            raise ValueError(f"Source table {table} is in several places: " + ", ".join(sorted(places)))
    return {table: sorted(*places.values()) for table, places in found.items()}


def read_sources(
    spark: SparkSession,
    folder: str,
    *,
    prefix: str = "",
    search: bool = False,
    free_text: tuple[str, ...] = FREE_TEXT_TABLES,
    unreadable: bool = False,
) -> dict[str, DataFrame]:
    """The nine source tables, each with all its parts; names every missing file before reading any.

    ``unreadable`` adds the column ``UNREADABLE`` to each, for the quality record.
    """
    paths = find_sources(spark, folder, prefix=prefix, search=search)
    missing = [prefix + name for table, name in SOURCE_FILES.items() if table not in paths]
    if missing:
        raise FileNotFoundError("Missing source files: " + ", ".join(missing))
    return {
        table: read_csv(spark, paths[table], SOURCE_TYPES[table], line_breaks=table in free_text, unreadable=unreadable)
        for table in SOURCE_FILES
    }


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """The enriched orders, whether or not they were written in month folders."""
    orders = spark.read.parquet(path)
    # A folder name such as 2018-01 carries no type.
    return orders.withColumn("purchase_year_month", F.col("purchase_year_month").cast("string"))


def read_derived(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A summary table written by :func:`ordergrain.sources.sinks.write_summary`."""
    return read_csv(spark, path, DERIVED_TYPES[table], line_breaks=False)


def read_record(spark: SparkSession, path: str) -> DataFrame:
    """A one-record JSON document such as the model metrics."""
    return spark.read.option("multiLine", True).json(path)


def literal_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A small table from records. Through Arrow it becomes a local relation of known size."""
    return spark.createDataFrame(pa.Table.from_pylist(rows))


def register_orders_view(orders: DataFrame, name: str = "orders") -> None:
    orders.createOrReplaceTempView(name)
