"""Cleaning: dates, numbers, labels, missing values, duplicates, calendar columns, lags in days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizlens.functions import (
    as_date, clean_number, fiscal_year, map_labels, month_label, month_start, parse_date, tenure, weekday_name,
)
from bizlens.operators.scale import exact_quantiles


def on_day(df: DataFrame, date: str, day, columns: Sequence[str]) -> DataFrame:
    """The given columns of the rows of one day."""
    return df.where(F.col(date) == as_date(day)).select(*columns)


def where_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def in_fiscal_year(df: DataFrame, date: str, year: int, first_month: int = 4) -> DataFrame:
    """Rows of the fiscal year that starts in ``year``: a range on the date, so it is pushed to the scan."""
    start = F.make_date(F.lit(year), F.lit(first_month), F.lit(1))
    end = F.make_date(F.lit(year + 1), F.lit(first_month), F.lit(1))
    return df.where((F.col(date) >= start) & (F.col(date) < end))


def between_filter(df: DataFrame, column: str, low, high) -> DataFrame:
    """Inclusive range on numbers, dates or strings."""
    return df.where(F.col(column).between(F.lit(low), F.lit(high)))


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns)) if columns else df.dropna()


def is_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def rename(df: DataFrame, names: dict[str, str] | Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed(names) if isinstance(names, dict) else df.toDF(*names)


def parse_dates(
    df: DataFrame, column: str, formats: Sequence[str] | None = None, day_first: bool = True, into: str | None = None
) -> DataFrame:
    """Text dates to dates; text that fits no format becomes null."""
    return df.withColumn(into or column, parse_date(column, formats, day_first))


def count_invalid_dates(
    df: DataFrame, column: str, formats: Sequence[str] | None = None, day_first: bool = True
) -> DataFrame:
    """Values that are missing or not a date."""
    return df.agg(F.count_if(parse_date(column, formats, day_first).isNull()).alias("invalid_dates"))


def clean_numeric(df: DataFrame, column: str, into: str | None = None, keep_sign: bool = False) -> DataFrame:
    return df.withColumn(into or column, clean_number(column, keep_sign))


def map_values(df: DataFrame, column: str, mapping: dict[str, str], into: str | None = None) -> DataFrame:
    return df.withColumn(into or column, map_labels(column, mapping))


def fill_missing(df: DataFrame, rules: dict[str, object]) -> DataFrame:
    """Fill nulls: ``"median"`` and ``"mean"`` of the column, anything else is a constant."""
    medians = [c for c, rule in rules.items() if rule == "median"]
    found = exact_quantiles(df, {c: c for c in medians}, (0.5,)) if medians else {}
    means = [c for c, rule in rules.items() if rule == "mean"]
    averages = df.agg(F.struct(*[F.avg(c).alias(c) for c in means])).scalar() if means else None
    filled = {}
    for c, rule in rules.items():
        value = F.lit(found[c][0]) if rule == "median" else averages[c] if rule == "mean" else F.lit(rule)
        filled[c] = F.coalesce(F.col(c), value)
    return df.withColumns(filled)


def fill_median_date(df: DataFrame, column: str) -> DataFrame:
    """Fill null dates with the median date (the earlier day when it falls between two)."""
    middle = exact_quantiles(df, {"d": F.unix_date(column)}, (0.5,), few_values=True)["d"][0]
    if middle is None:
        return df
    return df.withColumn(column, F.coalesce(F.col(column), F.date_from_unix_date(F.lit(int(middle // 1)))))


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedupe_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "first") -> DataFrame:
    """The first (or last) row per key in ``order_by``.

    An aggregate, not a window: partial results shrink a key with very many rows before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    pick = F.min_by if keep == "first" else F.max_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order_by)).alias("_row"))
    return chosen.select(*keys, "_row.*").select(*df.columns)


def with_calendar(df: DataFrame, date: str) -> DataFrame:
    """Month start, ``yyyy-MM`` text, weekday name and number (Monday 0), fiscal year."""
    return df.withColumns({
        "month_start": month_start(date), "tx_month": month_label(date), "tx_weekday": weekday_name(date),
        "weekday_no": F.weekday(date), "fiscal_year": fiscal_year(date),
    })


def late_flag(df: DataFrame, start: str, end: str, days: int = 5, into: str = "delivery") -> DataFrame:
    """``Late`` when ``end`` is more than ``days`` days after ``start``; unknown dates count as ``On Time``."""
    return df.withColumn(into, F.when(F.date_diff(end, start) > days, "Late").otherwise("On Time"))


def day_lag(df: DataFrame, start: str, end: str, into: str = "days") -> DataFrame:
    return df.withColumn(into, F.date_diff(end, start))


def tenure_text(df: DataFrame, start: str, end: str, as_of, into: str = "tenure") -> DataFrame:
    return df.withColumn(into, tenure(start, end, as_of))


