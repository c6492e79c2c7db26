"""Closed least squares and Newton steps against numpy and Spark ML."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from bizlens.operators import linear, models, summary


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4_000).select(
        F.round(F.randn(1), 3).alias("a"), F.round(F.randn(2) * 5 + 100, 3).alias("b"), F.round(F.rand(3), 3).alias("c"),
    ).withColumn("y", F.round(F.lit(3) + 2 * F.col("a") - F.col("b") / 4 + F.randn(4) / 10, 3)).withColumn(
        "hit", (F.col("a") + F.col("c") + F.randn(5) > 1).cast("int")).checkpoint()


@pytest.fixture(scope="module", autouse=True)
def folder(spark):
    from bizlens.session import checkpoint_folder

    checkpoint_folder(spark)


def test_line_equals_numpy(rows):
    found = linear.fit_line(rows, ["a", "b", "c"], "y", digits=3)
    data = np.array(rows.select("a", "b", "c", "y").collect(), float)
    expected = np.linalg.lstsq(np.column_stack([np.ones(len(data)), data[:, :3]]), data[:, 3], rcond=None)[0]
    assert [found.intercept, *found.weights] == pytest.approx(expected, abs=1e-9)
    assert linear.fit_line(rows.repartition(7), ["a", "b", "c"], "y", digits=3) == found  # exact sums do not depend on the dealing


def test_correlations_equal_the_matrix(spark, rows):
    plain = {(r["x"], r["y"]): r["correlation"] for r in summary.corr_matrix(rows, ["a", "b", "y"]).collect()}
    found = {(r["x"], r["y"]): r["correlation"] for r in linear.gram(rows, ["a", "b", "y"], 3).correlations(spark).collect()}
    assert found == pytest.approx(plain, abs=1e-9)


def test_determined_and_constant_columns_get_no_weight(spark):
    frame = spark.createDataFrame([(float(i), 2.0 * i, 5.0, 3.0 * i + 1) for i in range(9)] + [(None, 1.0, 5.0, 7.0)], "a double, b double, k double, y double")
    found = linear.fit_line(frame, ["a", "b", "k"], "y")
    assert found.intercept == pytest.approx(1) and found.weights == (pytest.approx(3), 0.0, 0.0)
    assert linear.gram(frame, ["a", "k"]).correlation("a", "k") is None
    assert linear.fit_line(frame.limit(0), ["a"], "y") == linear.Coefficients(("a",), 0.0, (0.0,))


def test_sums_beyond_the_digits_raise(spark):
    frame = spark.createDataFrame([(1e11,)] * 3, "v double").crossJoin(spark.range(50_000))
    with pytest.raises(OverflowError):
        linear.gram(frame, ["v"], 6)


def test_solve_singular():
    assert linear.solve([[Fraction(1), Fraction(2)], [Fraction(2), Fraction(4)]], [Fraction(3), Fraction(6)]).count(0) == 1


@pytest.mark.parametrize("c", [1.0, 0.01])
def test_newton_equals_the_library(rows, c):
    found = linear.fit_log_odds(rows, ["a", "c"], "hit", c)
    fitted = models._fit(rows, ["a", "c"], models.LogisticRegression(
        labelCol="hit", maxIter=1000, regParam=1 / (c * rows.count()), elasticNetParam=0.0, standardization=False, tol=1e-14)).stages[-1]
    assert [found.intercept, *found.weights] == pytest.approx([fitted.intercept, *fitted.coefficients], abs=1e-6)
    scored = models.predict(found, rows, ["hit"])
    assert scored.where("(prediction = 1) != (score >= 0.5)").count() == 0 and scored.where("prediction = hit").count() > 2_400


def test_newton_with_one_class_separated_or_missing_rows(spark):
    frame = spark.createDataFrame([(float(i), int(i > 4)) for i in range(10)] + [(None, 1)], "x double, y int")
    apart = linear.fit_log_odds(frame, ["x"], "y", c=1e6)
    assert np.isfinite([apart.intercept, *apart.weights]).all() and apart.weights[0] > 1
    alone = linear.fit_log_odds(frame.where("y = 1"), ["x"], "y")
    assert np.isfinite([alone.intercept, *alone.weights]).all()
    assert linear.fit_log_odds(frame.limit(0), ["x"], "y").weights == (0.0,)


def test_saved_coefficients_come_back(spark, tmp_path):
    for logistic in (False, True):
        model = linear.Coefficients(("b", "a"), 0.1, (1 / 3, -2.0), logistic)
        assert linear.Coefficients.load(spark, model.save(spark, str(tmp_path / str(logistic)))) == model
