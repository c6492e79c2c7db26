"""Bins, histograms and label summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions import bin_floor, cut, value_bucket
from bizlens.operators.scale import exact_quantiles


def cut_column(
    df: DataFrame, column: str, bins: Sequence[float | None], labels: Sequence[str], into: str, **options
) -> DataFrame:
    return df.withColumn(into, cut(column, bins, labels, **options))


def qcut(df: DataFrame, column: str, q: int, labels: Sequence[str], into: str = "bin", **scale) -> DataFrame:
    """Labels by equal-frequency bins, cut at the exact quantiles; the first bin includes the minimum."""
    points = exact_quantiles(df, {column: column}, [i / q for i in range(1, q)], **scale)[column]
    if points and points[0] is None:
        return df.withColumn(into, F.lit(None).cast("string"))
    return df.withColumn(into, cut(F.col(column).cast("double"), [None, *points, None], labels))


def histogram(df: DataFrame, column: str, size: float, origin: float = 0.0) -> DataFrame:
    """Rows per fixed-width bin, named by its lower edge."""
    return (
        df.where(F.col(column).isNotNull()).groupBy(bin_floor(column, size, origin).alias("bin_start"))
        .agg(F.count("*").alias("n"))
    )


def equal_width_histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Rows in ``bins`` equal intervals between minimum and maximum, the last one closed on both sides.

    Empty intervals are listed with 0.
    """
    value = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high")).alias("ends")).scalar()
    width = (ends["high"] - ends["low"]) / F.lit(float(bins))
    place = F.when(value == ends["high"], bins - 1).otherwise(
        F.least(F.floor(F.try_divide(value - ends["low"], width)), F.lit(bins - 1)))
    counts = (
        df.where(value.isNotNull()).groupBy(F.coalesce(place, F.lit(0)).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (ends["low"] + F.col("bin") * width).alias("bin_start"), F.coalesce("n", F.lit(0)).alias("n"))


def bucket_summary(
    df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], missing: str = "Unknown"
) -> DataFrame:
    """Rows and sum per value class."""
    return df.groupBy(value_bucket(column, edges, labels, missing).alias("bucket")).agg(
        F.count("*").alias("n"), F.sum(column).alias("total"))


def repeat_summary(df: DataFrame, customer: str, amount: str) -> DataFrame:
    """Customers and revenue of repeat and one-time buyers, labelled per customer."""
    per_customer = df.groupBy(customer).agg(F.count("*").alias("_n"), F.sum(amount).alias("_amount"))
    label = F.when(F.col("_n") > 1, "Repeat").otherwise("One-time")
    return per_customer.groupBy(label.alias("buyer")).agg(
        F.count("*").alias("customers"), F.sum("_amount").alias("revenue"))


