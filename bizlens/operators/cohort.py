"""Cohorts: members by first month, their later activity, retention, revenue and churn.

All counts start from one row per key and month.  That frame is built with map-side partial sums, so a
key with a large part of all rows is reduced before it is shuffled, and a key has at most as many rows as
there are months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bizlens.functions import month_start, months_apart, per, whole_months
from bizlens.operators.joins import with_group_value
from bizlens.operators.scale import settled


def _index(mode: str, start: Column, end: Column, base: int) -> Column:
    apart = {"calendar": months_apart, "elapsed": whole_months}[mode](start, end)
    return (apart + base).cast("int")


def cohort_index(
    df: DataFrame, key: str, date: str, cohort_date: str | None = None, base: int = 0, mode: str = "calendar", **scale
) -> DataFrame:
    """Adds ``cohort_month``, ``activity_month`` and ``cohort_index`` to every row.

    The cohort is the month of the key's first ``cohort_date`` (default ``date``).  ``base`` is the index
    of that month; ``mode`` counts calendar months or elapsed whole months between month starts.  Rows
    without a key are left out.
    """
    known = df.where(F.col(key).isNotNull())
    first = month_start(F.min(cohort_date or date))
    joined = with_group_value(known, key, first, "cohort_month", **scale).withColumn("activity_month", month_start(date))
    return joined.withColumn("cohort_index", _index(mode, F.col("cohort_month"), F.col("activity_month"), base))


def cohort_months(
    df: DataFrame, key: str, date: str, amount: str | None = None, cohort_date: str | None = None,
    base: int = 0, mode: str = "calendar",
) -> DataFrame:
    """One row per key and active month: ``cohort_month``, ``cohort_index``, ``rows`` and ``revenue``.

    Rows without a key are left out: they belong to no member.
    """
    measures = [F.count("*").alias("rows"), F.min(cohort_date or date).alias("_first")]
    if amount:
        measures.append(F.sum(amount).alias("revenue"))
    monthly = df.where(F.col(key).isNotNull()).groupBy(key, month_start(date).alias("activity_month")).agg(*measures)
    first = F.min("_first").over(Window.partitionBy(key))
    return (
        monthly.withColumn("cohort_month", month_start(first)).drop("_first")
        .withColumn("cohort_index", _index(mode, F.col("cohort_month"), F.col("activity_month"), base))
    )


def _active(months: DataFrame) -> DataFrame:
    return months.where(F.col("activity_month").isNotNull())


def cohort_counts(months: DataFrame) -> DataFrame:
    """Active members per cohort and index, from :func:`cohort_months`."""
    return _active(months).groupBy("cohort_month", "cohort_index").agg(F.count("*").alias("active"))


def cohort_sizes(months: DataFrame, key: str, size: str = "all", base: int = 0) -> DataFrame:
    """Members per cohort: all of them, or those active at the first index."""
    if size == "all":
        return (
            months.groupBy("cohort_month", key).agg(F.lit(1).alias("_one"))
            .groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
        )
    return (
        _active(months).where(F.col("cohort_index") == base)
        .groupBy("cohort_month").agg(F.count("*").alias("cohort_size"))
    )


def cohort_retention(
    df: DataFrame, key: str, date: str, cohort_date: str | None = None, size: str = "all", base: int = 0,
    mode: str = "calendar",
) -> DataFrame:
    """Active members, cohort size and retention per cent, per cohort and index."""
    months = cohort_months(df, key, date, cohort_date=cohort_date, base=base, mode=mode)
    joined = cohort_counts(months).join(cohort_sizes(months, key, size, base), "cohort_month")
    return joined.withColumn("retention_pct", per(F.col("active"), F.col("cohort_size"), 2, 100.0))


def cohort_revenue(months: DataFrame) -> DataFrame:
    return _active(months).groupBy("cohort_month", "cohort_index").agg(F.sum("revenue").alias("revenue"))


def cohort_arpu(months: DataFrame) -> DataFrame:
    """Revenue per active member, per cohort and index."""
    grouped = _active(months).groupBy("cohort_month", "cohort_index").agg(
        F.sum("revenue").alias("revenue"), F.count("*").alias("active"))
    return grouped.withColumn("arpu", per(F.col("revenue"), F.col("active"), 2))


def cohort_churn(df: DataFrame, key: str, date: str, base: int = 0) -> DataFrame:
    """100 minus retention, against the members of the first month."""
    kept = cohort_retention(df, key, date, size="first", base=base)
    return kept.withColumn("churn_pct", F.round(F.lit(100.0) - F.col("retention_pct"), 2))


def cohort_table(
    long: DataFrame, value: str, indices: Sequence[int], prefix: str = "m", fill: int | None = None
) -> DataFrame:
    """Long form to one row per cohort with a column per index; the indices are given, so no extra pass."""
    wide = long.groupBy("cohort_month").pivot("cohort_index", list(indices)).agg(F.first(value))
    wide = wide.select("cohort_month", *[F.col(str(i)).alias(f"{prefix}{i}") for i in indices])
    return wide if fill is None else wide.fillna(fill, subset=[f"{prefix}{i}" for i in indices])


def cohort_matrix(df: DataFrame, key: str, month: str, n: int = 12) -> DataFrame:
    """Rows per key in each of the first ``n`` months since its first (segment cohort table)."""
    months = cohort_months(df, key, month).where(F.col("cohort_index").between(0, n - 1))
    wide = months.groupBy(key, "cohort_month").pivot("cohort_index", list(range(n))).agg(F.sum("rows"))
    names = [F.coalesce(F.col(str(i)), F.lit(0)).alias(f"m{i}_transactions") for i in range(n)]
    return wide.select(key, "cohort_month", *names)


def cohort_activity(df: DataFrame, key: str, date: str, amount: str) -> DataFrame:
    """Active members and revenue by cohort month and activity month."""
    months = _active(cohort_months(df, key, date, amount))
    return months.groupBy("cohort_month", "activity_month").agg(
        F.count("*").alias("active"), F.sum("revenue").alias("revenue"))


def _monthly_days(df: DataFrame, key: str, date: str, aggregates: dict[str, Column] | None = None) -> DataFrame:
    """Per key and month the days with a row, one bit each, and other aggregates; partial sums of fixed size."""
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth(date) - 1)
    return df.where(F.col(date).isNotNull()).groupBy(key, month_start(date).alias("activity_month")).agg(
        F.bit_or(bit).alias("_days"), *[value.alias(name) for name, value in (aggregates or {}).items()])


def _nth_day(months: DataFrame, key: str, n: int, into: str) -> DataFrame:
    """The n-th distinct date of every key that has one.

    Every month has a date at least, so the first ``n`` months hold the n-th; a key, however many dates it has, is one short array.
    """
    listed = F.slice(F.array_sort(F.collect_list(F.struct("activity_month", "_days"))), 1, n)
    dates = F.flatten(F.transform("_months", lambda m: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(30)), lambda d: F.call_function("shiftright", m["_days"], d).bitwiseAND(1) == 1),
        lambda d: F.date_add(m["activity_month"], d))))
    found = months.groupBy(key).agg(listed.alias("_months")).select(key, F.get(dates, F.lit(n - 1)).alias(into))
    return found.where(F.col(into).isNotNull())


def nth_event(df: DataFrame, key: str, date: str, n: int) -> DataFrame:
    """The n-th distinct date of every key that has one."""
    return _nth_day(_monthly_days(df, key, date), key, n, date)


def nth_purchase_cohort(df: DataFrame, key: str, date: str, amount: str, n: int = 3) -> DataFrame:
    """Cohorts by the month of the n-th distinct purchase date; activity in all months, as reported."""
    monthly = settled(_monthly_days(df, key, date, {"revenue": F.sum(amount)}))
    start = _nth_day(monthly, key, n, "_nth").select(key, month_start("_nth").alias("cohort_month"))
    return monthly.drop("_days").join(start, key).groupBy("cohort_month", "activity_month").agg(
        F.count("*").alias("active"), F.sum("revenue").alias("revenue"))
