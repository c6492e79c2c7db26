"""Aggregate expressions with the rounding and null rules the reports use.

Sums and means of decimals are exact until the final division, so a rerun on another partitioning gives
the same digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bizlens.functions.dates import column


def _rounded(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


def total(c: Column | str, digits: int | None = None) -> Column:
    return _rounded(F.sum(column(c)), digits)


def per(numerator: Column, denominator: Column, digits: int | None = None, scale: float = 1.0) -> Column:
    """``scale * numerator / denominator`` as double; null when the denominator is 0 or null."""
    top = numerator.cast("double") if scale == 1.0 else F.lit(scale) * numerator.cast("double")
    return _rounded(F.try_divide(top, denominator.cast("double")), digits)


def pct(numerator: Column, denominator: Column, digits: int | None = 2) -> Column:
    return per(numerator, denominator, digits, 100.0)


def mean(c: Column | str, digits: int | None = None) -> Column:
    """Mean of the non-null values."""
    return per(F.sum(column(c)), F.count(column(c)), digits)


def n_rows() -> Column:
    return F.count("*")


def n_where(condition: Column) -> Column:
    return F.count_if(condition)


def rate(condition: Column, digits: int | None = 2) -> Column:
    """Per cent of the rows that meet ``condition``."""
    return pct(F.count_if(condition), F.count("*"), digits)


def distinct(c: Column | str, approximate: bool = False) -> Column:
    """Number of distinct values; ``approximate`` uses a mergeable sketch instead of a shuffle by value."""
    return F.approx_count_distinct(column(c)) if approximate else F.count_distinct(column(c))
