"""Splits, oversampling, models and metrics on small frames."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bizlens.operators import evaluation, features, models
from bizlens.sources import sinks


@pytest.fixture(scope="module")
def rare(spark):
    return spark.range(3_000).select(
        "id", (F.col("id") % 30 == 0).cast("int").alias("label"), F.rand(1).alias("x"),
        (F.rand(2) + F.when(F.col("id") % 30 == 0, 1.5).otherwise(0)).alias("y")).checkpoint()


def test_split_keeps_the_share_of_every_class(rare):
    train, test = features.stratified_split(rare, "label", "id")
    assert train.count() + test.count() == 3_000 and train.join(test, "id").count() == 0
    assert abs(test.where("label = 1").count() - 20) <= 1 and abs(test.where("label = 0").count() - 580) <= 1
    again = features.stratified_split(rare.repartition(7), "label", "id")[1]
    assert again.select("id").exceptAll(test.select("id")).count() == 0


def test_scaler_is_fitted_on_the_training_rows(spark):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, b double")
    scaler = features.fit_standardizer(train, ["a", "b"])
    assert scaler["a"] == (1.5, 0.5)
    other = spark.createDataFrame([(3.0, 6.0)], "a double, b double")
    assert tuple(features.standardize(other, scaler).first()) == (3.0, 1.0)


@pytest.mark.parametrize("cell_rows", [4_000, 20])
def test_oversampling_balances_the_classes(rare, cell_rows):
    balanced = features.smote(rare, ["x", "y"], "label", "id", cell_rows=cell_rows)
    counts = {r["label"]: r["count"] for r in balanced.groupBy("label").count().collect()}
    assert counts == {0: 2_900, 1: 2_900}
    made = np.array([[r.x, r.y] for r in balanced.where("id IS NULL").collect()])
    real = np.array([[r.x, r.y] for r in rare.where("label = 1").collect()])
    assert (made >= real.min(axis=0) - 1e-9).all() and (made <= real.max(axis=0) + 1e-9).all()


def test_oversampled_rows_lie_between_near_neighbours(rare):
    real = np.array([[r.x, r.y] for r in rare.where("label = 1").collect()])
    gaps = np.linalg.norm(real[:, None] - real[None], axis=2)
    near = np.argsort(gaps + np.eye(len(real)) * 1e9, axis=1)[:, :5]
    made = features.smote(rare, ["x", "y"], "label", "id").where("id IS NULL").limit(50).collect()
    for row in made:
        point, fits = np.array([row.x, row.y]), False
        for i, neighbours in enumerate(near):
            for j in neighbours:
                line = real[j] - real[i]
                share = np.dot(point - real[i], line) / np.dot(line, line)
                fits |= -1e-9 <= share <= 1 + 1e-9 and np.allclose(real[i] + share * line, point, atol=1e-9)
        assert fits


def test_copies_of_one_point_do_not_pile_up(spark):
    frame = spark.range(1_000).select("id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    cells = features._cells(frame, ["x", "y"], "id", 50).groupBy("_cell").count()
    assert cells.agg(F.max("count")).first()[0] <= 80


def test_time_split(spark):
    frame = spark.range(10).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    train, test = features.time_split(frame, "d")
    assert (train.count(), test.count()) == (8, 2)
    assert train.agg(F.max("d")).first()[0] < test.agg(F.min("d")).first()[0]


def test_features_do_not_cross_series(spark):
    rows = [(s, d, float(10 * s + d)) for s in (1, 2) for d in range(5)]
    frame = spark.createDataFrame(rows, "s int, d int, u double")
    lagged = features.add_rolling(features.add_lags(frame, ["s"], "d", "u", [1]), ["s"], "d", "u", [3])
    found = {(r.s, r.d): r for r in lagged.collect()}
    assert found[2, 0].lag_1 is None and found[2, 2].roll_3 is None
    assert found[2, 3].roll_3 == 21.0 and found[2, 3].lag_1 == 22.0


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(3)
    rows = [(i, int(draw.random() < 0.3), draw.choice([0.01, 0.29, 0.5, 0.57, 0.58, 0.99, draw.random()])) for i in range(300)]
    return rows, spark.createDataFrame(rows, "id int, label int, score double")


def test_auc_counts_pairs(scored):
    rows, frame = scored
    wins = [(p > n) + (p == n) / 2 for _, a, p in rows if a for _, b, n in rows if not b]
    expected = sum(wins) / len(wins)
    assert evaluation.roc_auc(frame).first()[0] == pytest.approx(expected)
    assert evaluation.roc_auc(frame, group_rows=5, slices=4, small_bytes=0).first()[0] == pytest.approx(expected)


def test_threshold_costs(scored):
    rows, frame = scored
    found = evaluation.threshold_costs(frame).collect()
    assert len(found) == 99
    for r in found:
        fp = sum(1 for _, a, s in rows if not a and s >= r.threshold)
        fn = sum(1 for _, a, s in rows if a and s < r.threshold)
        assert (r.false_positives, r.false_negatives, r.total_cost) == (fp, fn, 1000 * fn + 50 * fp)
    best = evaluation.best_threshold(evaluation.threshold_costs(frame)).first()
    assert best.total_cost == min(r.total_cost for r in found)


def test_no_positive_predictions(spark):
    frame = spark.createDataFrame([(0, 0), (1, 0), (0, 0)], "label int, prediction int")
    found = {r["class"]: r for r in evaluation.classification_report(frame).collect()}
    assert found["1"].precision == 0.0 and found["1"].recall == 0.0 and found["1"].support == 1
    assert found["accuracy"].f1 == pytest.approx(2 / 3) and found["macro avg"].recall == 0.5


def test_curve_ends_at_full_recall(scored):
    rows, frame = scored
    curve = evaluation.pr_curve(frame).orderBy("threshold").collect()
    assert curve[0].recall == 1.0 and len(curve) == len({s for _, _, s in rows})


def test_models_learn(rare, tmp_path):
    train, test = features.stratified_split(rare, "label", "id")
    logistic = models.fit_logistic(features.smote(train, ["x", "y"], "label", "id"), ["x", "y"], "label")
    found = models.score(logistic, test, ["id", "label"])
    assert evaluation.roc_auc(found).first()[0] > 0.95
    weighted = features.class_weights(train, "label")
    forest = models.fit_forest_classifier(weighted, ["x", "y"], "label", trees=10, depth=4, weight="weight")
    assert evaluation.roc_auc(models.score(forest, test, ["id", "label"])).first()[0] > 0.9
    assert models.feature_importance(forest, ["x", "y"], rare.sparkSession).first().feature == "y"
    loaded = sinks.load_model(sinks.save_model(logistic, str(tmp_path / "model")))
    assert models.score(loaded, test, ["id"]).exceptAll(models.score(logistic, test, ["id"])).count() == 0


def test_linear_model_is_the_least_squares_fit(spark):
    draw = np.random.default_rng(4)
    rows = draw.normal(size=(200, 3))
    target = rows @ [1.5, -2.0, 0.3] + 4 + draw.normal(size=200)
    frame = spark.createDataFrame([(*map(float, r), float(y)) for r, y in zip(rows, target)], "a double, b double, c double, y double")
    model = models.fit_linear(frame, ["a", "b", "c"], "y").stages[-1]
    expected = np.linalg.lstsq(np.column_stack([rows, np.ones(200)]), target, rcond=None)[0]
    assert np.allclose([*model.coefficients, model.intercept], expected, atol=1e-6)


def test_logistic_penalty_is_one_over_rows(rare):
    model = models.fit_logistic(rare, ["x", "y"], "label")
    points = np.array([[r.x, r.y, r.label] for r in rare.collect()])
    weights = np.array([*model.stages[-1].coefficients, model.stages[-1].intercept])
    inputs = np.column_stack([points[:, :2], np.ones(len(points))])
    chance = 1 / (1 + np.exp(-inputs @ weights))
    gradient = inputs.T @ (chance - points[:, 2]) + np.array([weights[0], weights[1], 0.0])
    assert np.abs(gradient).max() < 0.5


def test_regression(spark):
    frame = spark.range(50).select(F.col("id").cast("double").alias("x"), (3 * F.col("id") + 1).cast("double").alias("y"))
    out = models.forecast_output(models.fit_linear(frame, ["x"], "y"), frame, ["x"], "y")
    errors = evaluation.regression_metrics(out).first()
    assert errors.rmse < 1e-6 and errors.r2 == pytest.approx(1.0)
    forest = models.fit_forest_regressor(frame, ["x"], "y", trees=5, depth=5)
    assert evaluation.regression_metrics(models.forecast_output(forest, frame, ["x"], "y")).first().r2 > 0.9


def test_forests_are_fitted_in_parts_of_few_rows(spark, monkeypatch):
    frame = spark.range(1000).selectExpr("id % 10 * 1.0 AS x", "id % 2 * 1.0 AS y").coalesce(1)
    fitted = []
    fit = models._fit
    monkeypatch.setattr(models, "_fit", lambda train, *rest: fitted.append((train.rdd.getNumPartitions(), train.count())) or fit(train, *rest))
    monkeypatch.setattr(models, "FOREST_ROWS", 300)
    models.fit_forest_classifier(frame, ["x"], "y", trees=2, depth=2)
    models.fit_forest_regressor(frame, ["x"], "y", trees=2, depth=2)
    monkeypatch.setattr(models, "FOREST_ROWS", 1000)
    models.fit_forest_classifier(frame, ["x"], "y", trees=2, depth=2)
    assert fitted == [(4, 1000), (4, 1000), (1, 1000)]
