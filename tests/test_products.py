from __future__ import annotations

import pytest
from commerce import commerce_tables
from test_late_risk import SCHEMA, make_orders

from ordergrain.plans import kpis
from ordergrain.plans.late_risk.train import load_model, score
from ordergrain.plans.products import read_products, write_model_products, write_products


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("products"))
    write_products(commerce_tables(spark), path, spark)
    write_model_products(spark.createDataFrame(make_orders(300), SCHEMA), path, trees=5, depth=4)
    return path


def test_products_read_back(spark, folder):
    products = read_products(spark, folder, keep=True)
    assert products["orders"].count() == 6
    assert dict(products["orders"].dtypes)["purchase_year_month"] == "string"
    assert products["category"].first()["primary_category"] == "beauty"
    assert [r["purchase_year_month"] for r in products["monthly"].collect()] == ["2018-01", "2018-03", "2018-07"]
    assert products["rfm"].count() == 3 and products["importance"].count() <= 30
    assert products["metrics"].first()["train_rows"] == 240
    for name in products:
        products[name].unpersist()


def test_stored_summaries_equal_fresh_ones(spark, folder):
    products = read_products(spark, folder)
    fresh = kpis.state_performance(products["orders"])
    assert products["state"].dtypes == fresh.dtypes
    assert sorted(products["state"].collect()) == sorted(fresh.collect())


def test_stored_model_scores(spark, folder):
    rows = spark.createDataFrame(make_orders(20, seed=9), SCHEMA)
    assert score(load_model(f"{folder}/model"), rows).where("late_probability BETWEEN 0 AND 1").count() == 20
    assert spark.read.option("header", True).csv(f"{folder}/predictions").count() == 60
