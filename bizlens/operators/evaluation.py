"""Metrics of classifiers and regressors, as aggregates over scored rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizlens.functions import per
from bizlens.operators.scale import running


def confusion_counts(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n"))


def classification_report(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages.

    A class without predictions (or rows) has precision (or recall) 0.
    """
    cells = confusion_counts(
        scored.select(F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")))
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("class"), F.lit(0).alias("side"), F.col("n"), (
            F.col("label") == F.col("prediction")).alias("hit")),
        F.struct(F.col("prediction").alias("class"), F.lit(1).alias("side"), F.col("n"), F.lit(False).alias("hit")))))
    classes = sides.groupBy("class").agg(
        F.coalesce(F.sum(F.when(F.col("side") == 0, F.col("n"))), F.lit(0)).alias("support"),
        F.coalesce(F.sum(F.when(F.col("side") == 1, F.col("n"))), F.lit(0)).alias("predicted"),
        F.coalesce(F.sum(F.when(F.col("hit"), F.col("n"))), F.lit(0)).alias("hits"))
    zero = F.lit(0.0)
    classes = classes.withColumns({
        "precision": F.coalesce(per(F.col("hits"), F.col("predicted")), zero),
        "recall": F.coalesce(per(F.col("hits"), F.col("support")), zero),
        "f1": F.coalesce(per(2 * F.col("hits"), F.col("support") + F.col("predicted")), zero),
    })
    scores = ("precision", "recall", "f1")
    rows = classes.select(
        F.format_string("%.0f", "class").alias("class"), *scores, "support", "hits")
    everything = rows.agg(
        F.struct(F.lit("accuracy").alias("class"), *[
            per(F.sum("hits"), F.sum("support")).alias(s) for s in scores], F.sum("support").alias("support")).alias("a"),
        F.struct(F.lit("macro avg").alias("class"), *[F.avg(s).alias(s) for s in scores],
                 F.sum("support").alias("support")).alias("m"),
        F.struct(F.lit("weighted avg").alias("class"), *[
            per(F.sum(F.col(s) * F.col("support")), F.sum("support")).alias(s) for s in scores],
            F.sum("support").alias("support")).alias("w"))
    return rows.drop("hits").unionByName(everything.select(F.inline(F.array("a", "m", "w"))))


def _by_score(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score: what every ranking metric needs."""
    return scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))


def roc_auc(scored: DataFrame, label: str = "label", score: str = "score", **scale) -> DataFrame:
    """Area under the ROC curve; equal scores count half."""
    steps = running(_by_score(scored, label, score), [], ["score"], {"_below": F.col("negatives")}, **scale)
    won = F.col("positives") * (F.col("_below") - F.col("negatives") / 2)
    return steps.agg(per(
        F.sum(won.cast("decimal(38,1)")).cast("double"),
        F.sum("positives").cast("double") * F.sum("negatives").cast("double")).alias("roc_auc"))


def pr_curve(scored: DataFrame, label: str = "label", score: str = "score", **scale) -> DataFrame:
    """Precision and recall when everything from a score upwards is called positive, one row per score."""
    steps = running(
        _by_score(scored, label, score), [], [F.desc("score")],
        {"tp": F.col("positives"), "fp": F.col("negatives")}, **scale)
    positives = scored.agg(F.count_if(F.col(label) == 1)).scalar()
    return steps.select(
        F.col("score").alias("threshold"), "tp", "fp",
        per(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), per(F.col("tp"), positives).alias("recall"))


def threshold_costs(
    scored: DataFrame, label: str = "label", score: str = "score", fn_cost: int = 1000, fp_cost: int = 50,
    steps: int = 100,
) -> DataFrame:
    """False positives, false negatives and their cost for the thresholds 1/steps … (steps-1)/steps.

    One pass: scores are counted by the highest threshold they reach, then cumulated over those few rows.
    """
    value, width = F.col(score).cast("double"), F.lit(float(steps))
    guess = F.floor(value * width)
    reached = guess + F.when(value >= (guess + 1) / width, 1).when(value < guess / width, -1).otherwise(0)
    reached = F.greatest(F.lit(0), F.least(reached, F.lit(steps - 1)))
    counts = scored.groupBy(reached.cast("int").alias("step")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"))
    every = scored.sparkSession.range(0, steps).select(F.col("id").cast("int").alias("step"))
    filled = every.join(counts, "step", "left").fillna(0)
    upward = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    downward = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    summed = filled.select(
        "step", (F.col("step") / F.lit(float(steps))).alias("threshold"),
        F.sum("negatives").over(upward).alias("false_positives"),
        F.sum("positives").over(downward).alias("false_negatives"))
    cost = F.col("false_negatives") * fn_cost + F.col("false_positives") * fp_cost
    return summed.where("step > 0").select(
        "threshold", "false_positives", "false_negatives", cost.alias("total_cost"))


def best_threshold(costs: DataFrame) -> DataFrame:
    """The cheapest threshold, the lowest one on a tie."""
    return costs.orderBy("total_cost", "threshold").limit(1)


def detected_and_missed(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Positives found and overlooked."""
    actual = F.col(label) == 1
    return scored.agg(
        F.count_if(actual & (F.col(prediction) == 1)).alias("detected"),
        F.count_if(actual & (F.col(prediction) == 0)).alias("missed"))


def regression_metrics(scored: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Root mean square error, mean absolute percentage error and R²."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    squared = F.sum((y - p) * (y - p))
    spread = F.var_pop(y) * F.count(y)
    return scored.agg(
        F.sqrt(squared / F.count(y)).alias("rmse"),
        F.avg(F.abs(F.try_divide(y - p, y))).alias("mape"),
        (F.lit(1.0) - F.try_divide(squared, spread)).alias("r2"))
