from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from ordergrain.operators import ranking
from ordergrain.operators.ranking import (
    Place,
    exact_medians,
    grouped_medians,
    order_statistics,
    quartile_scores,
    row_positions,
    running_totals,
)


def ties(n, seed=5):
    """Rows (id, value): a third of the values equal."""
    rng = random.Random(seed)
    return [(i, 7.0 if rng.random() < 0.34 else float(rng.randrange(n))) for i in rng.sample(range(n * 3), n)]


def test_positions_of_the_whole_table(table):
    rows = ties(3000)
    df = table("id int, v double", *rows).repartition(6)
    got = {r["id"]: r["position"] for r in row_positions(df, [F.col("v"), F.col("id")]).collect()}
    expected = {i: p for p, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == expected


def test_positions_descending_with_groups_and_sizes(table):
    rows = [(g, i) for g in ("a", "b", "c") for i in range({"a": 2000, "b": 3, "c": 40}[g])]
    df = table("g string, i int", *rows).repartition(5)
    for r in row_positions(df, [F.col("i").desc()], ["g"], size="n").collect():
        n = {"a": 2000, "b": 3, "c": 40}[r["g"]]
        assert (r["n"], r["position"]) == (n, n - 1 - r["i"])


def test_running_totals_span_partitions(table):
    rows = [(g, i, (i * 7) % 11) for g in ("big", "small") for i in range(2500 if g == "big" else 5)]
    df = table("g string, i int, w int", *rows).repartition(7)
    expected = {}
    for group in ("big", "small"):
        total = 0
        for g, i, w in rows:
            if g == group:
                expected[g, i] = total
                total += w
        expected[group] = total
    for r in running_totals(df, [F.col("i")], {"w": "before"}, ["g"]).collect():
        assert r["before"] == expected[r["g"], r["i"]] and r["before_total"] == expected[r["g"]]


def test_a_group_of_a_third_of_the_rows_is_split(spark):
    """The hot group must not end in one partition of the sort."""
    from ordergrain.operators.ranking import _SLICE, _sorted_slices

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(90_000).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("g"), F.col("id").alias("v")
        )
        slices = _sorted_slices(df, ["g"], [F.col("v")])
        per_slice = slices.where("g = 0").groupBy(_SLICE).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_slice) >= 2 and max(r["count"] for r in per_slice) < 30_000


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 101, 2000])
def test_exact_medians(table, n):
    rows = [(float(v), i if i % 3 else None) for i, (_, v) in enumerate(ties(n))]
    got = exact_medians(table("a double, b int", *rows).repartition(3), ["a", "b"])
    assert got["a"] == statistics.median(a for a, _ in rows)
    known = [b for _, b in rows if b is not None]
    assert got["b"] == (statistics.median(known) if known else None)


def test_grouped_medians(table):
    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 2, 3]), rng.choice([0.5, rng.random()]), rng.randrange(9)) for _ in range(2000)]
    got = grouped_medians(table("g int, a double, b int", *rows).repartition(4), "g", ["a", "b"]).collect()
    assert {r["g"] for r in got} == {1, 2, 3}
    for r in got:
        assert r["a"] == pytest.approx(statistics.median(a for g, a, _ in rows if g == r["g"]))
        assert r["b"] == statistics.median(b for g, _, b in rows if g == r["g"])


@pytest.mark.parametrize("n", [5, 400, 6000])
def test_order_statistics_with_ties(table, n):
    rows = ties(n)
    df = table("id int, v double", *rows).repartition(4)
    positions = sorted({0, n // 3, n // 2, n - 1})
    got = order_statistics(df, {"v": lambda total: positions}, "id")
    expected = sorted((v, i) for i, v in rows)
    assert got == {Place("v", p): expected[p] for p in positions}


def test_order_statistics_without_values(table):
    assert order_statistics(table("id int, v double", (1, None)), {"v": lambda n: [0]}, "id") == {}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 59, 744, 1000])
def test_quartile_scores_follow_the_cut(table, n):
    rows = ties(n, seed=n)
    df = table("id int, v double", *rows).repartition(3)
    scored = quartile_scores(df, {"v": "s"}, "id").collect()
    order = {i: r for r, (i, _) in enumerate(sorted(rows, key=lambda x: (x[1], x[0])), start=1)}
    for row in scored:
        assert row["s"] == -(-4 * order[row["id"]] // n)
    if n == 5:
        assert sorted(r["s"] for r in scored) == [1, 2, 3, 4, 4]


def test_quartile_scores_descending(table):
    df = table("id string, v int", *[(c, i) for i, c in enumerate("abcde")])
    got = {r["id"]: r["s"] for r in quartile_scores(df, {"v": "s"}, "id", descending=["v"]).collect()}
    assert got == {"a": 4, "b": 3, "c": 2, "d": 1, "e": 1}


def test_results_are_the_same_for_any_partitioning(table):
    rows = ties(800)
    base = table("id int, v double", *rows)
    one, many = (
        {r["id"]: r["s"] for r in quartile_scores(df, {"v": "s"}, "id").collect()}
        for df in (base.coalesce(1), base.repartition(13))
    )
    assert one == many


def test_a_missed_bracket_is_widened(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_BRACKETS", (-0.4, 1.0))
    df = spark.range(1000).selectExpr("CAST(id AS double) AS v")
    assert ranking.exact_medians(df, ["v"]) == {"v": 499.5}
