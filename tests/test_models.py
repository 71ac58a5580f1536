"""Features, metrics, calibration, importance and tuning."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from profitlens.ml import features as f
from profitlens.ml import importance, metrics, models, report, tuning
from profitlens.plans.models import run_models
from profitlens.plans.queries import all_queries
from profitlens.session import stage
from profitlens.sources import star

SMALL = models.TreeSettings(trees=4, depth=3, learning_rate=0.2, row_share=1.0)


def pairs_auc(scores, labels):
    positives = [s for s, y in zip(scores, labels) if y]
    negatives = [s for s, y in zip(scores, labels) if not y]
    return np.mean([[1.0 if p > n else 0.5 if p == n else 0.0 for n in negatives] for p in positives])


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(5)
    labels = rng.integers(0, 2, 400).tolist()
    scores = [round(float(v), 1) for v in rng.normal(size=400) + np.array(labels)]
    df = spark.createDataFrame(list(zip(scores, labels)), "s double, y int").repartition(3)
    assert metrics.roc_auc(df, "s", "y").first()["auc"] == pytest.approx(pairs_auc(scores, labels), abs=1e-6)


def test_auc_per_group_and_with_one_class(spark):
    df = spark.createDataFrame([("a", 0.1, 0), ("a", 0.9, 1), ("b", 0.5, 1)], "g string, s double, y int")
    assert dict(metrics.roc_auc(df, "s", "y", group=("g",)).collect()) == {"a": 1.0, "b": None}


def test_brier(spark):
    df = spark.createDataFrame([(0.5, 1), (0.0, 0)], "p double, y int")
    assert metrics.brier_score(df, "p", "y").first()[0] == 0.125


def test_codes_are_alphabetical_and_missing_is_text(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("z",)], "c string")
    got = {r["c"]: r["c_code"] for r in f.label_encode(df, ("c",)).collect()}
    assert got == {"a": 0, "b": 1, "nan": 2, "z": 3}


def test_codes_of_very_many_categories(spark):
    names = sorted(f"c{i * 7919 % 20011}" for i in range(20_000))
    df = spark.createDataFrame([(n, n[:2]) for n in names], "c string, d string").repartition(6)
    rows = f.label_encode(df, ("c", "d")).collect()
    assert {r["c"]: r["c_code"] for r in rows} == {n: i for i, n in enumerate(names)}
    assert {r["d"]: r["d_code"] for r in rows} == {n: i for i, n in enumerate(sorted({n[:2] for n in names}))}


def test_text_that_was_not_learnt_has_a_code_of_its_own(spark):
    codes = f.category_codes(spark.createDataFrame([("a",), ("b",)], "c string"), ("c",))
    got = f.with_codes(spark.createDataFrame([("b",), ("new",)], "c string"), codes, ("c",))
    assert {r["c"]: r["c_code"] for r in got.collect()} == {"b": 1, "new": -1}


@pytest.fixture(scope="module")
def margin(spark, data):
    made = f.margin_risk_features(star.transactions(spark, data))
    return made.with_table(stage(made.table, "margin"))


def test_split_is_complete_repeatable_and_balanced(margin):
    train, test = f.holdout_split(margin, 0.25)
    assert train.count() + test.count() == margin.table.count()
    assert test.count() == f.holdout_split(margin.with_table(margin.table.repartition(5)), 0.25)[1].count()
    shares = {r["part"]: (r["rows"], r["positive_share"]) for r in f.split_summary(margin, 0.25).collect()}
    assert shares["test"][0] / margin.table.count() == pytest.approx(0.25, abs=0.001)
    assert shares["test"][1] == pytest.approx(shares["train"][1], abs=0.001)


def test_rare_labels_are_split_exactly(spark):
    rows = [(i, float(i), int(i % 50 == 0)) for i in range(1500)]
    features = f.FeatureSet(spark.createDataFrame(rows, "id long, x double, label int"), ("x",), (), "label", ("id",))
    train, test = f.holdout_split(features, 0.25)
    assert (test.count(), test.filter("label = 1").count()) == (376, 8)  # 368 and 8: 367.5 and 7.5, rounded up
    assert train.count() == 1500 - 376
    folds = f.with_fold(features, 5).groupBy("fold", "label").count().collect()
    assert {(r["label"], r["count"]) for r in folds} == {(0, 294), (1, 6)} and len(folds) == 10


def test_every_row_is_scored_and_keeps_its_columns(spark, margin):
    broken = margin.table.limit(50).withColumns({
        "unit_price": F.lit(None).cast("double"), "quantity": F.lit(float("nan")), "market": F.lit(None).cast("string"),
    })
    table = margin.table.unionByName(broken)
    model = models.fit_trees(margin.with_table(table), SMALL)
    scored = model.score(table, "p")
    assert scored.count() == table.count() and scored.filter("p is null").isEmpty()
    assert scored.columns == [*table.columns, "p"]


def test_scores_separate_losses(margin):
    train, test = f.holdout_split(margin, 0.25)
    model = models.fit_trees(margin.with_table(train), SMALL)
    scored = models.with_flag(model.score(test, "p"), "p", "flag")
    low, high = scored.agg(F.min("p"), F.max("p")).first()
    assert 0.0 <= low < high <= 1.0
    assert metrics.roc_auc(scored, "p", "label").first()["auc"] > 0.8
    assert scored.filter((F.col("p") > 0.5) != (F.col("flag") == 1)).isEmpty()
    assert "features" not in scored.columns and "market_code" not in scored.columns
    gains = models.feature_importance(model, margin).collect()
    assert sum(r["importance"] for r in gains) == pytest.approx(1.0)


def test_calibration_is_monotone_and_calibrated_scores_are_probabilities(margin):
    model = models.fit_calibrated(margin, SMALL, folds=2)
    scored = model.score(margin.table, "p")
    assert set(scored.columns) == {*margin.table.columns, "p"}
    low, high, mean, rate = scored.agg(F.min("p"), F.max("p"), F.avg("p"), F.avg("label")).first()
    assert 0.0 <= low < high <= 1.0 and mean == pytest.approx(rate, abs=0.05)
    plain = models.fit_calibration(
        margin.table.withColumn("s", F.col("unit_price") / 10000), "s", "label"
    )
    predictions = list(plain.predictions)
    assert predictions == sorted(predictions)


def test_importance_finds_the_only_useful_feature(spark):
    rng = np.random.default_rng(6)
    rows = [(i, float(x), float(z), int(x > 0)) for i, (x, z) in enumerate(rng.normal(size=(600, 2)))]
    table = spark.createDataFrame(rows, "id long, useful double, noise double, label int")
    features = f.FeatureSet(table, ("useful", "noise"), (), "label", ("id",))
    model = models.fit_trees(features, SMALL)
    got = dict(importance.permutation_importance(model.score, features, repeats=2).collect())
    assert got["useful"] > 0.3 and abs(got["noise"]) < 0.02


def test_tuning_returns_trials_and_the_best(spark):
    rng = np.random.default_rng(7)
    rows = [(i, float(x), "ab"[i % 2], int(x > 0.2)) for i, x in enumerate(rng.normal(size=300))]
    table = spark.createDataFrame(rows, "id long, x double, c string, label int")
    space = tuning.SearchSpace(trees=(1, 2), depth=(1, 2), learning_rate=(0.1, 0.3))
    trials, best = tuning.tune(f.FeatureSet(table, ("x",), ("c",), "label", ("id",)), space, trials=2, folds=2)
    found = trials.orderBy(F.col("cv_auc").desc()).first()
    assert trials.count() == 2 and (best.trees, best.depth) == (found["trees"], found["depth"])


def test_report_needs_enough_rows(spark):
    table = spark.createDataFrame([(i, float(i), i % 2) for i in range(20)], "id long, x double, label int")
    features = f.FeatureSet(table, ("x",), (), "label", ("id",))
    model, row = report.train_and_report(features, SMALL, "tiny")
    assert model is None and row.first()["holdout_auc"] == 0.0


def test_all_models_are_written(spark, data, tmp_path):
    quick = models.TreeSettings(trees=2, depth=2, learning_rate=0.3, row_share=1.0)
    space = tuning.SearchSpace(trees=(1, 2), depth=(1, 2), learning_rate=(0.1, 0.3))
    run_models(
        star.transactions(spark, data), str(tmp_path), margin=quick, churn=quick, delivery_space=space, ltv_space=space,
        delivery_trials=1, ltv_trials=1, folds=2, repeats=1,
    )
    orders = spark.read.parquet(str(tmp_path / "margin_risk_scored_orders.parquet"))
    assert orders.filter("margin_risk_probability BETWEEN 0 AND 1 AND margin_risk_flag IN (0, 1)").count() == orders.count() > 0
    items = star.transactions(spark, data)
    assert orders.count() == items.count() and set(items.columns) < set(orders.columns)
    late = spark.read.parquet(str(tmp_path / "delivery_risk_scored_orders.parquet"))
    assert late.count() == items.count() and set(items.columns) < set(late.columns)
    customers = spark.read.parquet(str(tmp_path / "customer_ltv_scored.parquet"))
    assert customers.count() == items.select("customer_id").distinct().count()
    assert {"customer_id", "total_profit", "ltv_probability", "high_value_label"} <= set(customers.columns)
    found = spark.read.schema(report.REPORT_SCHEMA).json(str(tmp_path / "model_report.json")).collect()
    assert {r["model"] for r in found} >= {"margin_risk", "delivery_risk", "customer_ltv"}
    assert all(r["settings"]["trees"] in ("1", "2") and r["feature_importance"] for r in found)
    assert all(0.0 <= r["holdout_auc"] <= 1.0 for r in found)
    assert spark.read.option("header", True).csv(str(tmp_path / "customer_ltv_trials.csv")).count() == 1


def test_high_sales_label_and_no_leak(spark, data):
    features = f.ltv_features(star.transactions(spark, data))
    assert "total_sales" not in features.features
    share = features.table.agg(F.avg("label")).first()[0]
    assert share == pytest.approx(0.25, abs=0.02)


def test_registered_gains_of_the_margin_model(spark, data):
    found = all_queries()["margin_importance"](spark, data).collect()
    wanted = f.margin_risk_features(star.transactions(spark, data))
    assert sorted(r["feature"] for r in found) == sorted(wanted.features) and len(found) == 7
    assert {"shipping_mode", "market", "customer_segment", "category_name"} <= {re.sub("_(code|encoded)$", "", r["feature"]) for r in found}
    assert {(r["model"], r["trees"], r["depth"]) for r in found} == {("margin_risk", "300", "6")}
    assert sum(r["gain"] for r in found) == pytest.approx(1.0) and all(0.0 <= r["gain"] <= 1.0 for r in found)
