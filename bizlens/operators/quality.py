"""Data quality: missing values, duplicates, invalid and mismatching amounts, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Text of an unsigned number (fixed value); a minus sign does not pass.
NUMBER_PATTERN = r"^[0-9]+(\.[0-9]+)?$"


def null_counts(df: DataFrame, columns: Sequence[str] | None = None, blank_as_null: bool = False) -> DataFrame:
    """Missing values per column, all in one aggregate."""
    def missing(c: str) -> Column:
        empty = F.col(c).isNull()
        return empty | (F.trim(F.col(c).cast("string")) == "") if blank_as_null else empty

    return df.agg(*[F.count_if(missing(c)).alias(f"null_{c}") for c in columns or df.columns])


def duplicates(df: DataFrame, keys: Sequence[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Key values that occur more than once, with their count and further aggregates."""
    extra = [c.alias(name) for name, c in (extra or {}).items()]
    return df.groupBy(*keys).agg(F.count("*").alias("duplicate_count"), *extra).where("duplicate_count > 1")


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    counts = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def invalid_amounts(df: DataFrame, columns: Sequence[str], min_exclusive: float = 0) -> DataFrame:
    """Rows with any of the amounts at or below the limit."""
    condition = F.lit(False)
    for c in columns:
        condition |= F.col(c) <= min_exclusive
    return df.where(condition)


def date_order_violations(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where ``later`` lies before ``earlier``."""
    return df.where(F.col(later) < F.col(earlier))


def amount_mismatch(df: DataFrame, qty: str, price: str, total: str, digits: int = 2) -> DataFrame:
    """Rows whose total is not quantity times price, with the expected amount."""
    expected = F.round(F.col(qty) * F.col(price), digits)
    return df.withColumn("expected", expected).where(expected != F.round(F.col(total), digits))


def amount_mismatch_count(df: DataFrame, qty: str, price: str, total: str, digits: int = 2) -> DataFrame:
    return amount_mismatch(df, qty, price, total, digits).agg(F.count("*").alias("mismatch_count"))


def non_numeric(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text is missing or not an unsigned number."""
    return df.where(F.col(column).isNull() | ~F.col(column).rlike(NUMBER_PATTERN))


def _moments(df: DataFrame, column: str) -> Column:
    """Mean and population standard deviation as one scalar subquery."""
    value = F.col(column).cast("double")
    return df.agg(F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("stddev"))).scalar()


def with_scalars(df: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    """Adds whole-frame aggregates to every row through one scalar subquery."""
    row = df.agg(F.struct(*[c.alias(name) for name, c in aggregates.items()])).scalar()
    return df.withColumns({name: row[name] for name in aggregates})


def outliers_above(df: DataFrame, column: str, k: float = 3, keep_stats: bool = False) -> DataFrame:
    """Rows above mean plus ``k`` population standard deviations."""
    stats = _moments(df, column)
    found = df.where(F.col(column) > stats["mean"] + F.lit(float(k)) * stats["stddev"])
    return found.withColumns({"mean": stats["mean"], "stddev": stats["stddev"]}) if keep_stats else found


def zscore_outliers(df: DataFrame, column: str, k: float = 3) -> DataFrame:
    """Rows whose z-score exceeds ``k`` in absolute value, with the score."""
    stats = _moments(df, column)
    z = F.try_divide(F.col(column).cast("double") - stats["mean"], stats["stddev"])
    return df.withColumn("z_score", z).where(F.abs("z_score") > k)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows without a parent."""
    parents = parent.select(F.col(parent_key or key).alias("_parent"))
    return child.join(parents, child[key] == parents["_parent"], "left_anti")


