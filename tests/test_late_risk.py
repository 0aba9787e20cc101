from __future__ import annotations

import random
import threading
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ordergrain.plans.late_risk import features, metrics, scenario, train, trees
from ordergrain.plans.report import model_summary
from ordergrain.sources import sinks

FACTS = ", ".join(
    [f"{c} double" for c in features.NUMERIC_FEATURES] + [f"{c} string" for c in features.CATEGORICAL_FEATURES]
)
SCHEMA = (
    "order_id string, order_purchase_timestamp timestamp_ntz, order_status string, is_late int, " + FACTS
)


def make_orders(n, seed=1):
    """Synthetic orders whose lateness depends on the distance and the state."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        numbers = [round(rng.uniform(1, 10), 3) for _ in features.NUMERIC_FEATURES]
        numbers[4] = None if rng.random() < 0.1 else numbers[4]
        numbers[1] = 3.0  # a constant column
        state = rng.choice(["SP", "SP", "RJ", "MG", None])
        kinds = [state, rng.choice(["a", "b"]), rng.choice(["SP", "PR"]), "rare" if i % 50 == 7 else "card"]
        chance = 0.05 + 0.07 * numbers[7] + (0.2 if state == "RJ" else 0.0)
        rows.append(
            (f"o{i:05d}", datetime(2018, 1, 1) + timedelta(minutes=rng.randrange(20_000)), "delivered",
             int(rng.random() < chance), *numbers, *kinds)
        )
    return rows


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(make_orders(600), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def rows(orders):
    return features.model_rows(orders).persist()


@pytest.fixture(scope="module")
def run(orders):
    return train.train_late_risk(orders, trees=15, depth=6)


def scored_frame(spark, labels, scores, parts=4):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(labels, scores)], "y int, p double").repartition(parts)


def brute_metrics(labels, scores, threshold):
    labels, scores = np.asarray(labels), np.asarray(scores)
    order = np.argsort(-scores, kind="stable")
    y, s = labels[order], scores[order]
    last = np.r_[np.flatnonzero(np.diff(s)), len(s) - 1]
    hits, n = np.cumsum(y)[last], last + 1
    precision, recall = hits / n, hits / y.sum()
    ap = float(np.sum(np.diff(np.r_[0, recall]) * precision))
    pos, neg = scores[labels == 1], scores[labels == 0]
    auc = float(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))
    return ap, auc, *brute_threshold(labels, scores >= threshold)


def brute_threshold(labels, predicted):
    tp = int((labels & predicted).sum())
    p, late = int(predicted.sum()), int(labels.sum())
    return tp / p if p else 0.0, tp / late if late else 0.0, 2 * tp / (p + late) if p + late else 0.0


# --- features and split -----------------------------------------------------------------------


def test_features_exclude_outcomes():
    assert not set(features.FEATURES) & set(features.OUTCOMES)
    with pytest.raises(ValueError, match="Outcome"):
        features.check_features(["item_count", "late_days"], ["item_count", "late_days"])
    with pytest.raises(ValueError, match="missing"):
        features.check_features(["item_count"], [])


def test_model_rows_need_delivery_label_and_time(spark, table):
    base = make_orders(4)
    changed = [base[0], (*base[1][:2], "shipped", *base[1][3:]), (*base[2][:3], None, *base[2][4:]),
               (base[3][0], None, *base[3][2:])]
    assert [r["order_id"] for r in features.model_rows(table(SCHEMA, *changed)).collect()] == ["o00000"]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 333])
def test_chronological_split(table, n):
    df = features.model_rows(table(SCHEMA, *make_orders(n)).repartition(3))
    got = {r["order_id"]: r["split"] for r in features.chronological_split(df).collect()}
    order = [r[0] for r in sorted(make_orders(n), key=lambda r: (r[1], r[0]))]
    train_rows = int(n * 0.80)
    fit_rows = int(train_rows * 0.80)
    expected = ["fit"] * fit_rows + ["validation"] * (train_rows - fit_rows) + ["test"] * (n - train_rows)
    assert got == dict(zip(order, expected))


def test_split_with_one_purchase_time(table):
    same = [(r[0], datetime(2018, 1, 1), *r[2:]) for r in make_orders(50)]
    split = features.chronological_split(features.model_rows(table(SCHEMA, *same)))
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts == {"fit": 32, "validation": 8, "test": 10}


def test_learned_statistics_equal_numpy(rows):
    learned = features.learn_statistics(rows)
    pdf = rows.toPandas()
    for c in features.NUMERIC_FEATURES:
        filled = pdf[c].fillna(pdf[c].median())
        assert learned.medians[c] == pytest.approx(pdf[c].median())
        assert learned.means[c] == pytest.approx(filled.mean())
        assert learned.scales[c] == pytest.approx(filled.std(ddof=0) or 1.0)
    assert learned.scales["unique_product_count"] == 1.0
    assert learned.most_frequent["customer_state"] == "SP"
    assert learned.with_rare == ("primary_payment_type",)  # 12 rows
    assert [tuple(r) for r in learned.rare.collect()] == [("primary_payment_type", "rare")]


def test_rare_and_unseen_categories(table):
    base = make_orders(120)
    kinds = ["x"] * 20 + ["y"] * 19 + ["z"] * 81
    fit = features.model_rows(table(SCHEMA, *[(*r[:-1], k) for r, k in zip(base, kinds)]))
    learned = features.learn_statistics(fit)
    assert features.slot_labels(learned)["primary_payment_type"] == ["x", "z", features.INFREQUENT]
    names = features.feature_names(learned)
    stages = features.preparation_stages(fit, learned)
    probe = features.model_rows(
        table(SCHEMA, *[(*r[:-1], k) for r, k in zip(base, ["x", "y", "never seen", None, "it's"])])
    )
    vectors = {
        r["primary_payment_type"]: r["v"]
        for r in PipelineModel(stages).transform(probe)
        .select("primary_payment_type", vector_to_array("features").alias("v")).collect()
    }
    slots = [i for i, name in enumerate(names) if name.startswith("categorical__primary_payment_type_")]
    assert len(vectors["x"]) == len(names)
    assert [[vectors[k][i] for i in slots] for k in ("x", "y", "never seen", None, "it's")] == [
        [1, 0, 0], [0, 0, 1], [0, 0, 0], [0, 1, 0], [0, 0, 0],
    ]


def test_category_names_with_quotes(table):
    fit = features.model_rows(table(SCHEMA, *[(*r[:-1], "o'neil\\") for r in make_orders(30)]))
    learned = features.learn_statistics(fit)
    stages = features.preparation_stages(fit, learned)
    assert PipelineModel(stages).transform(fit).where("slot__primary_payment_type <> primary_payment_type").count() == 0


def test_a_hundred_thousand_categories(spark, tmp_path):
    n = 100_000
    numbers = [F.lit(1.0).alias(c) if k else (F.col("id") % 7).cast("double").alias(c) for k, c in enumerate(features.NUMERIC_FEATURES)]
    kinds = [F.when(F.col("id") % 4 == 0, "common").otherwise(F.concat(F.lit("it's "), "id")).alias(c) for c in features.CATEGORICAL_FEATURES[:1]]
    kinds += [F.lit("one").alias(c) for c in features.CATEGORICAL_FEATURES[1:]]
    rows = spark.range(4 * n // 3 + 1).select(
        F.col("id").alias("order_id"), F.timestamp_add("MINUTE", F.col("id").cast("int"), F.lit("2018-01-01").cast("timestamp_ntz")).alias("order_purchase_timestamp"),
        (F.col("id") % 5 == 0).cast("int").alias("is_late"), *numbers, *kinds,
    )
    learned = features.learn_statistics(rows)
    assert learned.frequent["customer_state"] == ["common"] and learned.rare.count() == n
    stages = features.preparation_stages(rows, learned)
    assert len(stages[1].getStatement()) < 5_000
    train.save_model(PipelineModel(stages), str(tmp_path / "stages"))
    probe = rows.where("order_id IN (4, 5)").unionByName(rows.limit(1).withColumns({"order_id": F.lit(-1).cast("long"), "customer_state": F.lit("new")}))
    for model in (PipelineModel(stages), train.load_model(str(tmp_path / "stages"))):
        slots = {r["order_id"]: r["v"][13:15] for r in model.transform(probe).select("order_id", vector_to_array("features").alias("v")).collect()}
        assert slots == {4: [1.0, 0.0], 5: [0.0, 1.0], -1: [0.0, 0.0]}


# --- metrics -------------------------------------------------------------------------------------


@pytest.mark.parametrize("steps", [5, 1_000_000])
def test_ranking_and_threshold_metrics(spark, steps):
    rng = np.random.default_rng(steps)
    labels = rng.integers(0, 2, 3000)
    scores = np.floor((0.3 * labels + 0.7 * rng.random(3000)) * steps) / steps
    got = metrics.evaluate(scored_frame(spark, labels, scores), "y", "p", 0.5).first()
    assert tuple(got) == pytest.approx(brute_metrics(labels, scores, 0.5))


def test_constant_score(spark):
    got = metrics.evaluate(scored_frame(spark, [1, 0, 0, 0], [0.25] * 4), "y", "p", 0.5).first()
    assert tuple(got) == (0.25, 0.5, 0.0, 0.0, 0.0)


def test_threshold_sweep_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, 500)
    grid = np.array([0.05 + i * 0.01 for i in range(76)])
    scores = np.r_[grid, np.nextafter(grid, 0), rng.random(500 - 2 * 76)]
    got = metrics.threshold_sweep(scored_frame(spark, labels, scores), "y", "p").orderBy("threshold").collect()
    assert [r["threshold"] for r in got] == list(grid)
    assert [r["f1"] for r in got] == [brute_threshold(labels, scores >= t)[2] for t in grid]


def test_equal_f1_takes_the_lowest_threshold(spark):
    best = metrics.best_threshold(scored_frame(spark, [1, 0], [0.5, 0.3]), "y", "p").first()
    assert best["threshold"] == pytest.approx(0.31) and best["f1"] == 1.0


def test_model_choice_ignores_the_baseline(table):
    results = table("model string, pr_auc double, threshold double", ("dummy", 0.9, 0.5), ("a", 0.2, 0.1), ("b", 0.3, 0.2))
    assert tuple(metrics.choose_model(results, ("a", "b")).first()) == ("b", 0.3, 0.2)


def test_the_first_of_equal_models_is_chosen(table):
    results = table("model string, pr_auc double, threshold double", ("x", 0.3, 0.1), ("dummy", 0.3, 0.5), ("b", 0.3, 0.2), ("a", 0.3, 0.4))
    assert metrics.choose_model(results, ("b", "x", "a")).first()["model"] == "b"
    assert train.CANDIDATES[0] == "logistic_regression"


# --- models ------------------------------------------------------------------------------------------


def test_class_weights(table):
    got = {r["is_late"]: r["weight"] for r in train.class_weights(table("is_late int", (1,), (0,), (0,), (0,))).collect()}
    assert got == {1: 2.0, 0: pytest.approx(2 / 3)}


def test_logistic_regression_solves_the_weighted_l2_problem(rows):
    fitted = train.fit_model(rows, "logistic_regression")
    model = fitted.pipeline.stages[-1]
    prepared = PipelineModel(fitted.pipeline.stages[:-1]).transform(rows)
    data = prepared.select("is_late", vector_to_array("features").alias("x")).collect()
    y = np.array([r["is_late"] for r in data])
    x = np.array([r["x"] for r in data])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    b = model.coefficients.toArray()
    residual = weight * (1 / (1 + np.exp(-(x @ b + model.intercept))) - y)
    gradient = np.r_[x.T @ residual + b, residual.sum()]
    assert np.abs(gradient).max() < 0.02
    checked = train.optimum(fitted, rows).first()
    assert checked["gradient"] == pytest.approx(np.abs(gradient).max() / len(y), rel=1e-3, abs=1e-12)
    margin = x @ b + model.intercept
    loss = (weight * np.logaddexp(0, np.where(y == 1, -margin, margin))).mean() + b @ b / 2 / len(y)
    assert checked["loss"] == pytest.approx(loss) and checked["loss"] < checked["shifted_loss"]
    importance = train.feature_importance(fitted, 1000).collect()
    assert {r["feature"] for r in importance} == set(features.feature_names(fitted.learned))
    assert importance[0]["importance"] == pytest.approx(np.abs(b).max())


def test_optimum_reads_the_rows_once(rows):
    """One aggregation by sign, without a row per row and feature."""
    fitted = train.fit_model(rows, "logistic_regression")
    plan = train.optimum(fitted, rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "scalar-subquery" not in plan


def test_refit_uses_its_own_statistics(run):
    whole = run.split.where("split <> 'test'").drop("split")
    assert run.fitted.learned == features.learn_statistics(whole)


def test_training_products(run, tmp_path, spark):
    results = {r["model"]: r for r in run.validation.collect()}
    assert set(results) == {"dummy", "logistic_regression", "random_forest"}
    assert results["dummy"]["roc_auc"] == 0.5 and results["logistic_regression"]["roc_auc"] > 0.55
    best = max((m for m in results if m != "dummy"), key=lambda m: results[m]["pr_auc"])
    assert run.fitted.name == best and run.threshold == results[best]["threshold"]

    predicted = run.predictions()
    assert predicted.columns == [
        "order_id", "order_purchase_timestamp", "is_late", "late_probability", "predicted_late",
    ]
    assert predicted.count() == 120
    assert predicted.where(F.col("predicted_late") != (F.col("late_probability") >= run.threshold).cast("int")).count() == 0

    record = train.metrics_record(run).first()
    assert (record["train_rows"], record["test_rows"]) == (480, 120)
    assert record["train_end"] <= record["test_start"]
    assert record["baseline_test"]["pr_auc"] == pytest.approx(record["positive_rate_test"])
    assert record["features"] == list(features.FEATURES)
    assert record["validation"][best]["threshold"] == run.threshold
    assert train.comparison_rows(train.metrics_record(run)).count() == 2
    assert model_summary(train.metrics_record(run)).first()["test_rows"] == "120"
    sinks.write_record(train.metrics_record(run), str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first()["test"]["f1"] == record["test"]["f1"]

    importance = run.importance().collect()
    assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)
    top = train.top_importances(run.importance(), 5).collect()
    assert [r["feature"] for r in reversed(top)] == [r["feature"] for r in importance[:5]]


def test_forest_importance_adds_up(rows):
    fitted = train.fit_model(rows, "random_forest", trees=5, depth=4)
    importance = train.feature_importance(fitted, 1000)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_rows_of_few_partitions_are_kept_in_several_places(rows, monkeypatch):
    levels, grow = [], train.grow_forest
    monkeypatch.setattr(train, "grow_forest", lambda data, **options: levels.append(data.storageLevel) or grow(data, **options))
    train.fit_model(rows, "random_forest", trees=2, depth=2)
    monkeypatch.setattr(train, "FOREST_PARTITION_ROWS", 50)
    train.fit_model(rows, "random_forest", trees=2, depth=2)
    assert [level.replication for level in levels] == [train.FOREST_COPIES, 1]


def test_many_rows_are_grown_on_few_partitions_without_their_plan(rows, monkeypatch):
    found = []

    def noted(data, **options):
        found.append((data.rdd.getNumPartitions(), data._jdf.queryExecution().analyzed().toString()))
        return grow(data.limit(300), **options)

    grow = train.grow_forest
    monkeypatch.setattr(train, "grow_forest", noted)
    many = rows.crossJoin(rows.sparkSession.range(150)).drop("id")
    train.fit_model(many, "random_forest", train.learn_statistics(rows), trees=1, depth=2)
    ((parts, plan),) = found
    assert parts == 1
    assert "LogicalRDD" in plan and "Repartition" not in plan


def test_a_forest_is_grown_on_all_rows(rows, monkeypatch):
    """However many there are: 2,040,000 here, of which 40,000 were left out when two million were the most."""
    found = []

    def noted(data, **options):
        found.append(data.count())
        return grow(data.limit(300), **options)

    grow = train.grow_forest
    monkeypatch.setattr(train, "grow_forest", noted)
    copies = rows.sparkSession.range(3400).select(F.col("id").cast("string").alias("copy"))
    many = rows.crossJoin(copies).withColumn("order_id", F.concat("order_id", F.lit("-"), "copy")).drop("copy")
    train.fit_model(many, "random_forest", train.learn_statistics(rows), trees=1, depth=2)
    assert found == [600 * 3400]


def test_trees_at_once():
    """A tree on one partition has one task at a time, so that more of them cover more cores, to a bound."""
    assert [train.trees_at_once(cores, 1) for cores in (2, 8, 12, 400)] == [16, 16, 24, 32]
    assert train.trees_at_once(12, 8) == 16 and train.trees_at_once(12, 0) == 24


def test_candidates_are_fitted_at_the_same_time(rows, monkeypatch):
    met, fit = threading.Barrier(2), train.fit_model

    def waiting(*args, **options):
        met.wait(timeout=60)  # broken if the one is fitted before the other
        return fit(*args, **options)

    monkeypatch.setattr(train, "fit_model", waiting)
    results = train.validate(rows.where("order_id < 'o00400'"), rows.where("order_id >= 'o00400'"), trees=2, depth=2)
    assert [r["model"] for r in results.collect()] == ["dummy", *train.CANDIDATES]


def prepared_rows(spark, labels, seed=3):
    rng = random.Random(seed)
    rows = [(label, k, [rng.uniform(0, 1) + 0.5 * label, rng.uniform(0, 1)]) for k, label in enumerate(labels)]
    frame = spark.createDataFrame(rows, "is_late int, row long, x array<double>")
    return frame.select("is_late", "row", array_to_vector("x").alias("features")).persist()


def test_draws_are_poisson(spark):
    drawn = spark.range(20_000).select(train.draws(F.col("id"), F.lit(7)).alias("n"))
    shares = {r["n"]: r["count"] / 20_000 for r in drawn.groupBy("n").count().collect()}
    for n, expected in enumerate([0.3679, 0.3679, 0.1839, 0.0613, 0.0153]):
        assert shares[n] == pytest.approx(expected, abs=0.012)
    other = spark.range(20_000).select(train.draws(F.col("id"), F.lit(8)).alias("n"))
    assert drawn.collect() != other.collect()
    again = spark.range(20_000).repartition(7).select("id", train.draws(F.col("id"), F.lit(7)).alias("n")).orderBy("id")
    assert [r["n"] for r in again.collect()] == [r["n"] for r in drawn.collect()]


def test_draws_are_compiled(spark):
    plan = spark.range(10).select(train.draws(F.col("id"), F.lit(7)))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_trees_do_not_share_local_properties(spark, monkeypatch):
    """Fits that share them take each other's execution ids for their own and fail now and then."""
    plain, seen = train.tree, []

    def noted(number, depth):
        seen.append(spark._jvm.java.lang.System.identityHashCode(spark.sparkContext._jsc.sc().getLocalProperties()))
        return plain(number, depth)

    monkeypatch.setattr(train, "tree", noted)
    train.grow_forest(prepared_rows(spark, [int(k % 5 == 0) for k in range(100)]), trees=4, depth=2)
    assert len(set(seen)) == 4


def tree_weights(data, trees):
    found = {}
    for r in train.bootstrap_weights(data, trees).collect():
        found.setdefault(r["tree"], {})[r["is_late"]] = r["weight"]
    return found


def test_bootstraps_are_balanced_each(spark):
    data = prepared_rows(spark, [int(k % 9 == 0) for k in range(900)])
    trees = 6
    each = data.select("is_late", "row", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    each.select("*", train.draws(F.col("row"), F.col("tree")).alias("n")).createOrReplaceTempView("drawn")
    counted = spark.sql("SELECT tree, is_late, sum(n) AS drawn, count_if(n > 0) AS chosen FROM drawn GROUP BY tree, is_late").collect()
    found = train.bootstrap_weights(data, trees).collect()
    assert {(r["tree"], r["is_late"]): r["drawn"] for r in found} == {(r["tree"], r["is_late"]): r["drawn"] for r in counted}
    weights = tree_weights(data, trees)
    assert len({w[1] for w in weights.values()}) == trees  # the draws differ, so do the weights
    for number in range(trees):
        sums = train.bootstrap(data, number, weights[number]).groupBy("is_late").agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
        sums = {r["is_late"]: r for r in sums.collect()}
        half = sum(r["drawn"] for r in counted if r["tree"] == number) / 2
        assert sums[0]["w"] == pytest.approx(half) and sums[1]["w"] == pytest.approx(half)
        assert {(number, c, r["n"]) for c, r in sums.items()} == {(number, r["is_late"], r["chosen"]) for r in counted if r["tree"] == number}


def test_forest_is_the_mean_of_its_trees(spark):
    data = prepared_rows(spark, [int(k % 5 == 0) for k in range(400)])
    model = train.grow_forest(data, trees=4, depth=5)
    assert model.getNumTrees == 4 and model.numClasses == 2
    weights = tree_weights(data, 4)
    chance = vector_to_array("probability")[1].alias("p")
    alone = []
    for number in range(4):
        single = train.tree(number, 5).fit(train.bootstrap(data, number, weights[number]))
        assert single.trees[0].toDebugString.split("\n", 1)[1] == model.trees[number].toDebugString.split("\n", 1)[1]
        alone.append([r["p"] for r in single.transform(data).orderBy("row").select(chance).collect()])
    got = [r["p"] for r in model.transform(data).orderBy("row").select(chance).collect()]
    assert got == pytest.approx(np.mean(alone, axis=0))


def test_forest_of_one_late_row(spark):
    """Some trees draw no late row; they know both classes all the same."""
    model = train.grow_forest(prepared_rows(spark, [0] * 40 + [1]), trees=6, depth=3)
    assert model.numClasses == 2 and len(model.trees) == 6
    assert {t.numClasses for t in model.trees} == {2}
    tiny = train.grow_forest(prepared_rows(spark, [0, 1]), trees=30, depth=2)
    assert 0 < len(tiny.trees) < 30


def test_draws_in_a_task_are_the_same(spark):
    numbers = np.random.default_rng(5).integers(-(2**63), 2**63, 5_000)
    frame = spark.createDataFrame([(int(n),) for n in numbers], "row long").select("row", train.draws(F.col("row"), F.lit(7)).alias("n"))
    found = {r["row"]: r["n"] for r in frame.collect()}
    again = trees.draws(numbers, 7, train.FOREST_SEED, train.DRAW_SHARES)
    assert [found[int(n)] for n in numbers] == again.tolist()


def one_partition(rows, copies):
    """Prepared rows, numbers and categories, as a forest of so many of them is grown on."""
    learned = features.learn_statistics(rows)
    many = PipelineModel(features.preparation_stages(rows, learned)).transform(rows.crossJoin(rows.sparkSession.range(copies)))
    return many.select("is_late", F.xxhash64("order_id", "id").alias("row"), "features").repartition(1).persist()


@pytest.mark.parametrize("copies", [1, 30, 70])
def test_trees_grown_in_a_task_are_those_of_spark(rows, monkeypatch, copies):
    """With all rows as candidates of a split, and with 10,000 drawn from more and from many more rows."""
    data = one_partition(rows, copies)
    forest = train.grow_forest(data, trees=3, depth=8)
    monkeypatch.setattr(train, "FOREST_TASK_CELLS", 0)
    level_by_level = train.grow_forest(data, trees=3, depth=8)
    one, other = ([t.toDebugString.split("\n", 1)[1] for t in model.trees] for model in (forest, level_by_level))
    assert one == other and "in {" in one[0] and "<=" in one[0]
    assert forest.featureImportances == level_by_level.featureImportances
    chance = [[r[0] for r in m.transform(data.orderBy("row").limit(300)).select(vector_to_array("probability")[1]).collect()] for m in (forest, level_by_level)]
    assert chance[0] == chance[1]


def test_a_tree_is_no_job_a_level(rows, monkeypatch):
    def refused(*_):
        raise AssertionError("fitted level by level")

    monkeypatch.setattr(train.RandomForestClassifier, "fit", refused)
    assert train.grow_forest(one_partition(rows, 1), trees=2, depth=20).getNumTrees == 2


def test_saved_forest_scores_the_same(rows, tmp_path):
    fitted = train.fit_model(rows, "random_forest", trees=3, depth=4)
    train.save_model(fitted.pipeline, str(tmp_path / "forest"))
    loaded = train.load_model(str(tmp_path / "forest"))
    assert len(loaded.stages[-1].trees) == 3
    chance = [train.score(p, rows).orderBy("order_id").select("late_probability").collect() for p in (fitted.pipeline, loaded)]
    assert chance[0] == chance[1]


def test_saved_model_scores_the_same(run, tmp_path, rows):
    path = str(tmp_path / "model")
    train.save_model(run.fitted.pipeline, path)
    train.save_model(run.fitted.pipeline, path)  # overwrites
    loaded = train.load_model(path)
    sample = rows.limit(50)
    assert train.score(loaded, sample).collect() == train.score(run.fitted.pipeline, sample).collect()


def test_scores_do_not_depend_on_partitioning(run, rows):
    one, many = (
        {r["order_id"]: r["late_probability"] for r in train.score(run.fitted.pipeline, df).collect()}
        for df in (rows.coalesce(1), rows.repartition(7))
    )
    assert one == many


# --- scenarios ------------------------------------------------------------------------------------------


def test_scenarios(run, orders, table):
    default = scenario.default_scenario(orders)
    row = default.first()
    assert row["item_count"] == int(row["item_count"]) and row["customer_state"] == "MG"
    scored = scenario.scenario_scores(run.fitted.pipeline, default).first()
    assert 0 < scored["late_probability"] < 1

    broken = default.withColumn("item_count", F.lit(21)).withColumn("estimated_days", F.lit(0.5))
    assert scenario.range_violations(broken).first()["violations"] == ["item_count", "estimated_days"]
    rejected = scenario.scenario_scores(run.fitted.pipeline, broken).first()
    assert rejected["late_probability"] is None and rejected["violations"] == ["item_count", "estimated_days"]
    assert scenario.valid_scenarios(broken).count() == 0
    assert scenario.valid_scenarios(default.withColumn("purchase_hour", F.lit(23))).count() == 1
    seen = {(r["column"], r["value"]) for r in scenario.observed_categories(orders).collect()}
    assert ("primary_payment_type", "rare") in seen and ("customer_state", None) not in seen
