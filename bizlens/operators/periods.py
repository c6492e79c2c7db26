"""Reports by day, week day, month, month of year and fiscal year; growth and moving averages.

The windows here run over frames that hold one row per calendar period, so their size is bounded by the
calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.functions import direction, mean, month_start, pct, total, weekday_name

PERIODS = {
    "day": lambda d: F.col(d).cast("date"),
    "month": lambda d: month_start(d),
    "month_of_year": lambda d: F.month(d),
    "year": lambda d: F.year(d),
}


def period_summary(
    df: DataFrame, date: str, period: str, measures: dict[str, Column], by: Sequence[str] = ()
) -> DataFrame:
    """Measures per period (rows without a date left out) and optional further keys."""
    dated = df.where(F.col(date).isNotNull())
    return dated.groupBy(PERIODS[period](date).alias("period"), *by).agg(*[c.alias(n) for n, c in measures.items()])


def weekday_summary(df: DataFrame, date: str, amount: str) -> DataFrame:
    """Rows, revenue and mean per week day, Monday first."""
    return (
        df.groupBy(F.weekday(date).alias("weekday_no"), weekday_name(date).alias("weekday"))
        .agg(F.count("*").alias("tx_count"), total(amount).alias("revenue"), mean(amount).alias("avg_order"))
        .orderBy("weekday_no")
    )


def moving_average(df: DataFrame, date: str, amount: str, rows: int = 7, digits: int = 2) -> DataFrame:
    """Daily revenue and its mean over the last ``rows`` days that have sales; shorter at the start."""
    daily = df.groupBy(F.col(date).cast("date").alias(date)).agg(F.sum(amount).alias("daily_revenue"))
    window = Window.orderBy(date).rowsBetween(1 - rows, 0)
    average = F.sum("daily_revenue").over(window).cast("double") / F.count("daily_revenue").over(window)
    return daily.withColumn("moving_avg", F.round(average, digits))


def period_growth(df: DataFrame, date: str, amount: str, period: str = "month") -> DataFrame:
    """Revenue per period, the period before, the change in per cent and its label."""
    grouped = period_summary(df, date, period, {"revenue": F.sum(amount)})
    previous = F.lag("revenue").over(Window.orderBy("period"))
    grown = grouped.withColumn("previous", previous)
    return grown.withColumn("growth_pct", pct(F.col("revenue") - F.col("previous"), F.col("previous"))).withColumn(
        "growth", direction("growth_pct"))


def year_month_matrix(df: DataFrame, date: str, amount: str, wide: bool = True) -> DataFrame:
    """Revenue by year and month of year; wide has the columns m1 to m12."""
    if not wide:
        return df.groupBy(F.year(date).alias("year"), F.month(date).alias("month")).agg(F.sum(amount).alias("revenue"))
    months = df.withColumn("_month", F.month(date)).groupBy(F.year(date).alias("year"))
    table = months.pivot("_month", list(range(1, 13))).agg(F.sum(amount))
    return table.select("year", *[F.col(str(m)).alias(f"m{m}") for m in range(1, 13)])


def product_months(df: DataFrame, date: str, keys: Sequence[str], amount: str, n: int | None = None) -> DataFrame:
    """Revenue per month and product, ordered within the month; ``n`` limits the listing."""
    grouped = period_summary(df, date, "month", {"revenue": F.sum(amount)}, keys)
    listed = grouped.orderBy("period", F.desc("revenue"), *keys)
    return listed if n is None else listed.limit(n)
