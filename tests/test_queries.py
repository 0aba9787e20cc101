"""Every registered query against its SQL counterpart in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from ordergrain.catalog import all_queries

FOLDERS = (entry_point.SMOKE_FOLDER, "/root/testdata/sf0.01")
VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()
OWN = set(all_queries())  # without those of the optional subpackage, which has tests of its own
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}
# These train models; tests/test_late_risk.py covers them on smaller forests.
TRAINED = {
    "m10_logistic_regression", "m11_random_forest", "m12_predictions", "m18_validation_metrics",
    "m19_feature_importance", "o6_top_importances", "m20_metrics_record", "m20_test_comparison",
    "f22_model_summary", "scenario_scores",
}

pytestmark = pytest.mark.skipif(not Path(FOLDERS[0]).exists(), reason="no test data")


@pytest.fixture(scope="module", params=FOLDERS)
def tables(request):
    """A test-data folder and a DuckDB connection with its tables."""
    connection = duckdb.connect()
    for view in VIEWS:
        connection.sql(f"CREATE VIEW {view} AS SELECT * FROM '{request.param}/{view}.parquet'")
    return request.param, connection


def in_order(rows, columns):
    places = [list(columns).index(c) for c in sorted(columns)]
    return sorted((tuple(row[p] for p in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(OWN & set(ORACLES)))
def test_same_rows_as_sql(spark, tables, name):
    folder, duck = tables
    df = QUERIES[name](spark, folder)
    expected = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert in_order(df.collect(), df.columns) == in_order(expected.fetchall(), expected.columns)


def test_only_trained_products_and_records_lack_sql():
    assert OWN - set(ORACLES) == TRAINED | {"quality_report"}


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0


def test_quality_record(spark):
    assert len(QUERIES["quality_report"](spark, FOLDERS[0]).first()["tables"]) == 9
