"""Open, high, low, close and volume by fiscal year or month, for one or several tickers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions import fiscal_year, fiscal_year_label, month_start

#: Columns of a daily price table (fixed values).
PRICE_COLUMNS = ("open", "close", "high", "low", "volume")


def stack_tickers(frames: dict[str, DataFrame]) -> DataFrame:
    """One frame from the per-ticker tables, with a ``ticker`` column."""
    return reduce(DataFrame.unionByName, [df.withColumn("ticker", F.lit(t)) for t, df in frames.items()])


def with_fiscal_period(df: DataFrame, date: str, first_month: int = 4) -> DataFrame:
    """Fiscal year label, its start year, and the month."""
    return df.withColumns({
        "fiscal_year": fiscal_year_label(date, first_month), "fiscal_start": fiscal_year(date, first_month),
        "month": month_start(date)})


def ohlcv_ranges(df: DataFrame, by: Sequence[str | Column], columns: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """Minimum and maximum of every column per group."""
    return df.groupBy(*by).agg(*[
        f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))])


def roll_up_ranges(ranges: DataFrame, by: Sequence[str | Column], columns: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """Coarser ranges from finer ones, without going back to the days."""
    return ranges.groupBy(*by).agg(*[
        f(f"{name}_{c}").alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))])


def volume_by_year(df: DataFrame, by: Sequence[str | Column], volume: str = "volume") -> DataFrame:
    return df.groupBy(*by).agg(F.sum(volume).alias("total_volume"), F.count(volume).alias("days"))
