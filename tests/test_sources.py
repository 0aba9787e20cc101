from __future__ import annotations

import pytest
from commerce import commerce_tables
from pyspark.sql import functions as F

from ordergrain.plans import kpis, quality
from ordergrain.plans.enrich import enrich_orders
from ordergrain.plans.products import write_products
from ordergrain.sources import sinks, tables as readers
from ordergrain.sources.schemas import SOURCE_FILES, SOURCE_TYPES


@pytest.fixture()
def folder(tmp_path, spark):
    """The nine CSV files of the hand-made tables."""
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    for name, df in commerce_tables(spark).items():
        df.toPandas().to_csv(deep / f"shop_{SOURCE_FILES[name]}", index=False)
    return deep


def test_all_missing_files_are_named(spark, folder):
    for name in ("sellers", "items"):
        (folder / f"shop_{SOURCE_FILES[name]}").unlink()
    for search in (False, True):
        with pytest.raises(FileNotFoundError) as error:
            readers.read_sources(spark, str(folder), prefix="shop_", search=search)
        assert SOURCE_FILES["sellers"] in str(error.value) and SOURCE_FILES["items"] in str(error.value)


@pytest.mark.parametrize("search", [False, True])
def test_csv_sources_give_the_same_enriched_table(spark, folder, search):
    source = folder.parent.parent if search else folder
    loaded = readers.read_sources(spark, str(source), prefix="shop_", search=search)
    for name, types in SOURCE_TYPES.items():
        assert all(dict(loaded[name].dtypes)[c] == t for c, t in types.items())
    expected = enrich_orders(commerce_tables(spark)).orderBy("order_id").collect()
    got = enrich_orders(loaded).orderBy("order_id").select(list(expected[0].asDict())).collect()
    assert got == expected


def test_a_table_in_two_places_is_ambiguous(spark, folder):
    copy = folder.parent / "z"
    copy.mkdir()
    (copy / f"shop_{SOURCE_FILES['items']}").write_text((folder / f"shop_{SOURCE_FILES['items']}").read_text())
    with pytest.raises(ValueError, match="items"):
        readers.read_sources(spark, str(folder.parent), prefix="shop_", search=True)
    assert readers.read_sources(spark, str(folder), prefix="shop_")["items"].count() == 7


@pytest.mark.parametrize("layout", ["numbered", "folder", "folder.csv"])
def test_all_parts_of_a_table_are_read(spark, folder, layout):
    whole = folder / f"shop_{SOURCE_FILES['reviews']}"
    whole.unlink()
    stem = whole.name.removesuffix(".csv")
    parts = [folder / f"{stem}-00000.csv", folder / f"{stem}-00001.csv"]
    if layout != "numbered":
        below = folder / stem if layout == "folder" else whole
        below.mkdir()
        parts = [below / "part-a.csv", below / "part-b.csv"]
    parts[0].write_text("review_id,order_id,review_score\nr1,o1,5\nr2,o2,4\n")
    parts[1].write_text("review_id,order_id,review_score\nr3,o3,3\nr4,o4,2\nr5,o5,1\n")
    reviews = readers.read_sources(spark, str(folder), prefix="shop_")["reviews"]
    assert sorted(r["review_id"] for r in reviews.collect()) == ["r1", "r2", "r3", "r4", "r5"]
    assert len({r[0] for r in reviews.select(F.spark_partition_id()).collect()}) == 2


def test_parts_with_other_headers_are_refused(spark, folder):
    whole = folder / f"shop_{SOURCE_FILES['sellers']}"
    whole.unlink()
    stem = whole.name.removesuffix(".csv")
    (folder / f"{stem}-0.csv").write_text("seller_id,seller_state\ns1,SP\n")
    (folder / f"{stem}-1.csv").write_text("seller_state,seller_id\nSP,s2\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_sources(spark, str(folder), prefix="shop_")["sellers"].collect()


def test_foreign_files_are_not_taken(spark, folder):
    (folder / "returned_orders_dataset.csv").write_text("order_id\nx\n")
    (folder / "shop_orders_dataset_old.csv").write_text("order_id\nx\n")
    expected = commerce_tables(spark)["orders"].count()
    assert readers.read_sources(spark, str(folder), prefix="shop_")["orders"].count() == expected


def test_quoted_cells(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text('review_id,text,review_score\nr1,"two\nlines, ""quoted""",5\nr2,NA,\nr3,na,bad\n')
    rows = {r["review_id"]: r for r in readers.read_csv(spark, str(path), {"review_score": "int"}).collect()}
    assert len(rows) == 3
    assert rows["r1"]["text"] == 'two\nlines, "quoted"' and rows["r1"]["review_score"] == 5
    assert rows["r2"]["text"] is None and rows["r2"]["review_score"] is None
    assert rows["r3"]["text"] == "na" and rows["r3"]["review_score"] is None


@pytest.mark.parametrize("line_breaks", [False, True])
def test_byte_order_mark_is_not_part_of_the_header(spark, tmp_path, line_breaks):
    path = tmp_path / "bom.csv"
    path.write_bytes("\ufeffname,english\r\nbeleza_saúde,beauty\r\n".encode())
    df = readers.read_csv(spark, str(path), {}, line_breaks=line_breaks)
    assert df.columns == ["name", "english"]
    assert tuple(df.first()) == ("beleza_saúde", "beauty")


def test_header_order_decides(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("price,order_id\n2.5,7\n")
    row = readers.read_csv(spark, str(path), {"price": "double"}).first()
    assert (row["order_id"], row["price"]) == ("7", 2.5)


def test_enriched_round_trip(spark, tmp_path):
    orders = enrich_orders(commerce_tables(spark))
    sinks.write_enriched(orders, str(tmp_path / "enriched"))
    back = readers.read_enriched(spark, str(tmp_path / "enriched"))
    assert back.count() == 6
    assert (tmp_path / "enriched" / "purchase_year_month=2018-01").is_dir()
    assert sorted(kpis.state_performance(back).collect()) == sorted(kpis.state_performance(orders).collect())
    sinks.write_enriched(orders, str(tmp_path / "plain"), partition_by_month=False)
    assert readers.read_enriched(spark, str(tmp_path / "plain")).count() == 6


def test_filter_and_columns_reach_the_parquet_scan(spark, tmp_path):
    sinks.write_enriched(enrich_orders(commerce_tables(spark)), str(tmp_path / "e"), partition_by_month=False)
    cards = kpis.kpi_cards(kpis.filtered_orders(readers.read_enriched(spark, str(tmp_path / "e")), ["SP"]))
    plan = cards._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered), EqualTo(cus" in plan  # Spark cuts the list here
    assert "avg_distance_km" not in plan.split("ReadSchema")[1]


def test_summary_round_trip(spark, tmp_path):
    monthly = kpis.monthly_kpis(enrich_orders(commerce_tables(spark)))
    sinks.write_summary(monthly, str(tmp_path / "monthly"))
    back = readers.read_derived(spark, str(tmp_path / "monthly"), "monthly")
    assert back.dtypes == monthly.dtypes
    assert sorted(back.collect(), key=str) == sorted(monthly.collect(), key=str)


def test_record_round_trip(spark, tmp_path):
    record = spark.sql("SELECT named_struct('pr_auc', 0.5D) AS test, 3 AS rows, CAST(NULL AS STRING) AS gap")
    sinks.write_record(record, str(tmp_path / "r"))
    back = readers.read_record(spark, str(tmp_path / "r")).first()
    assert back["test"]["pr_auc"] == 0.5 and back["rows"] == 3 and "gap" in back.asDict()


def test_orders_view(spark):
    readers.register_orders_view(readers.literal_table(spark, [{"order_id": 1}, {"order_id": 2}]), "v_orders")
    assert spark.sql("SELECT count(*) AS n FROM v_orders").first()["n"] == 2


def test_unreadable_cells_are_counted(spark, tmp_path):
    file = tmp_path / "orders.csv"
    file.write_text("id,amount,day,note\n1,2.5,2018-01-01 10:00:00,x\n2,\"2,5\",2018-02-30,y\n3,,NA,z\nfour,nan,,\n")
    types = {"id": "int", "amount": "double", "day": "timestamp_ntz"}
    df = readers.read_csv(spark, str(file), types, unreadable=True)
    assert [r[readers.UNREADABLE] for r in df.orderBy("note").collect()] == [1, 0, 2, 0]
    profile = quality.table_profile(df, "t").first()
    assert list(profile) == ["t", 4, 4, 0, 8, 3]  # table, rows, columns, duplicates, null cells, unreadable ones
    assert quality.table_profile(df.drop(readers.UNREADABLE), "t").first()["unreadable_cells"] == 0


def test_marked_sources_give_the_same_products(spark, folder, tmp_path):
    loaded = readers.read_sources(spark, str(folder), prefix="shop_", unreadable=True)
    orders = write_products(loaded, str(tmp_path / "out"), spark)
    assert orders.count() == 6 and readers.UNREADABLE not in orders.columns
    record = readers.read_record(spark, str(tmp_path / "out" / "quality")).first()
    assert record["tables"]["orders"]["unreadable_cells"] == 0
