"""Fitting and scoring with Spark ML, and scoring with fitted coefficients."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.operators.linear import Coefficients

#: Training rows of one task of a forest.  Every row visits every tree at every level, so far fewer rows than Spark deals by their bytes.
FOREST_ROWS = 20_000


def _fit(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    vectors = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[vectors, estimator]).fit(train)


def dealt(train: DataFrame, rows: int | None = None) -> DataFrame:
    """``train`` in parts of about ``rows``, where it has more; a smaller one stays as it is."""
    parts = -(-train.count() // (FOREST_ROWS if rows is None else rows))
    return train.repartition(parts) if parts > 1 else train


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 1000, c: float = 1.0):
    """Logistic regression with the L2 penalty ``1 / (c * rows)`` on unscaled features."""
    penalty = 1.0 / (c * max(train.count(), 1))
    return _fit(train, features, LogisticRegression(
        labelCol=label, maxIter=max_iter, regParam=penalty, elasticNetParam=0.0, standardization=False))


def fit_forest_classifier(
    train: DataFrame, features: Sequence[str], label: str, trees: int = 200, depth: int = 12, seed: int = 42,
    weight: str | None = None,
):
    """Random forest; pass the column of ``class_weights`` for balanced classes."""
    forest = RandomForestClassifier(
        labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed)
    return _fit(dealt(train), features, forest.setWeightCol(weight) if weight else forest)


def fit_linear(train: DataFrame, features: Sequence[str], label: str):
    return _fit(train, features, LinearRegression(labelCol=label, regParam=0.0))


def fit_forest_regressor(
    train: DataFrame, features: Sequence[str], label: str, trees: int = 300, depth: int = 30, seed: int = 42
):
    """Random forest on all features per split; 30 is the deepest tree Spark grows."""
    return _fit(dealt(train), features, RandomForestRegressor(
        labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=seed))


def predict(model: Coefficients, df: DataFrame, keep: Sequence[str | Column], threshold: float = 0.5) -> DataFrame:
    """Kept columns and the ``score``; for log-odds also the ``prediction`` of class 1 from ``threshold`` on."""
    scored = df.select(*keep, model.score().alias("score"))
    return scored.withColumn("prediction", (F.col("score") >= threshold).cast("double")) if model.logistic else scored


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns, ``prediction`` and, for classifiers, the ``score`` of class 1."""
    out = model.transform(df)
    added = [F.col("prediction")]
    if "probability" in out.columns:
        added.append(vector_to_array("probability")[1].alias("score"))
    return out.select(*keep, *added)


def forecast_output(model: PipelineModel | Coefficients, test: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Keys, actual and predicted value; the keys travel through the model with their row."""
    if isinstance(model, Coefficients):
        return test.select(*keys, F.col(label).alias("actual"), model.score().alias("predicted"))
    return model.transform(test).select(
        *keys, F.col(label).alias("actual"), F.col("prediction").alias("predicted"))


def feature_importance(model: PipelineModel, names: Sequence[str], spark, n: int = 10) -> DataFrame:
    """The ``n`` most important features of a fitted forest."""
    weights = model.stages[-1].featureImportances.toArray().tolist()
    ranked = sorted(zip(names, weights), key=lambda pair: (-pair[1], pair[0]))[:n]
    return spark.createDataFrame(ranked, "feature string, importance double")
