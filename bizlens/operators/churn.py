"""Churn, inactivity and period reports on customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bizlens.functions import as_date, mean, month_start, pct, rate
from bizlens.operators.joins import attach
from bizlens.operators.scale import exact_quantiles, running, settled
from bizlens.sources.sinks import append_report

#: Members named in one part of a list.
LIST_PART = 1_000
#: Groups whose quantiles are selected side by side in one aggregate.
SIDE_BY_SIDE = 32


def _today(df: DataFrame, date: str, as_of):
    return df.agg(F.max(date)).scalar() if isinstance(as_of, str) and as_of == "max" else as_date(as_of)


def last_activity(df: DataFrame, key: str, date: str, as_of="max") -> DataFrame:
    """Last date per key and the days since."""
    return (
        df.groupBy(key).agg(F.max(date).alias("last_date"))
        .withColumn("days_since", F.date_diff(_today(df, date, as_of), "last_date"))
    )


def inactive_members(df: DataFrame, key: str, date: str, days: int = 90, as_of="max") -> DataFrame:
    return last_activity(df, key, date, as_of).where(F.col("days_since") > days)


def inactive_list(df: DataFrame, key: str, date: str, days: int = 90, as_of="max", members: int = LIST_PART) -> DataFrame:
    """The inactive keys as text: ``part`` (from 1), ``members`` and ``inactive_list``, in the order of the names.

    A part names ``members`` keys, the last one the rest, so no cell grows with the data; no inactive key, no row.
    """
    gone = settled(inactive_members(df, key, date, days, as_of).where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_name")))
    placed = running(gone, [], ["_name"], {"_place": F.lit(1)})
    part = F.floor((F.col("_place") - 1) / members).cast("long") + 1
    return placed.groupBy(part.alias("part")).agg(
        F.count("*").alias("members"), F.concat_ws(", ", F.sort_array(F.collect_list("_name"))).alias("inactive_list"))


def inactive_summary(df: DataFrame, key: str, date: str, days: int = 90, as_of="max") -> DataFrame:
    """Keys tracked, keys inactive for more than ``days`` days and their per cent; :func:`inactive_list` names them."""
    seen = last_activity(df, key, date, as_of)
    gone = F.col("days_since") > days
    measures = [
        F.count(key).alias("tracked"), F.count_if(gone & F.col(key).isNotNull()).alias("inactive"),
        pct(F.count_if(gone & F.col(key).isNotNull()), F.count(key)).alias("inactive_pct"),
    ]
    return seen.agg(*measures)


def monthly_churn(df: DataFrame, key: str, date: str) -> DataFrame:
    """Active keys per month, the month before, and net churn and retention per cent.

    Net change of size: churn is negative when the base grows.  :func:`retention_churn_report` compares
    the sets of members instead.
    """
    active = (
        df.groupBy(month_start(date).alias("activity_month")).agg(F.count_distinct(key).alias("active"))
    )
    before = F.lag("active").over(Window.orderBy("activity_month"))
    return active.withColumn("previous", before).withColumns({
        "churn_pct": pct(F.col("previous") - F.col("active"), F.col("previous")),
        "retention_pct": pct(F.col("active"), F.col("previous")),
    })


def at_risk(df: DataFrame, key: str, date: str, as_of, days: int = 60, order_id: str | None = None) -> DataFrame:
    """Keys whose last order is more than ``days`` days back."""
    orders = F.count_distinct(order_id) if order_id else F.count("*")
    return (
        df.groupBy(key).agg(F.max(date).alias("last_date"), orders.alias("orders"))
        .withColumn("days_since", F.date_diff(_today(df, date, as_of), "last_date"))
        .where(F.col("days_since") > days)
    )


def latest_periods(df: DataFrame, period: str, n: int = 2) -> DataFrame:
    """The ``n`` latest distinct periods, newest first."""
    return df.select(period).where(F.col(period).isNotNull()).distinct().orderBy(F.desc(period)).limit(n)


def _two_periods(df: DataFrame, key: str, period: str) -> DataFrame:
    """Per key of the two latest periods: was it there now, was it there before.

    Both periods come from one list of distinct periods, which the two subqueries share.  Rows without a key are left
    out: they are no member, and so neither new nor retained nor lost.
    """
    known = df.select(period).distinct()
    current = known.agg(F.max(period)).scalar()
    previous = known.agg(F.max(F.when(F.col(period) < current, F.col(period)))).scalar()
    return (
        df.where(F.col(key).isNotNull() & ((F.col(period) == current) | (F.col(period) == previous))).groupBy(key)
        .agg(F.bool_or(F.col(period) == current).alias("now"), F.bool_or(F.col(period) != current).alias("before"))
    )


def new_members(df: DataFrame, key: str, period: str) -> DataFrame:
    return _two_periods(df, key, period).where("now AND NOT before").select(key)


def lost_members(df: DataFrame, key: str, period: str) -> DataFrame:
    return _two_periods(df, key, period).where("before AND NOT now").select(key)


def retained_members(df: DataFrame, key: str, period: str) -> DataFrame:
    return _two_periods(df, key, period).where("now AND before").select(key)


def retention_churn_report(df: DataFrame, key: str, period: str, generated_at=None) -> DataFrame:
    """One row for the latest period: total, new, retained and churned keys and their rates.

    Both periods are read in one pass and reduced to two flags per key, so no joins are needed.
    """
    rate_type = "decimal(6,2)"
    report = _two_periods(df, key, period).agg(
        F.count_if("now").alias("total_customers"),
        F.count_if(F.col("now") & ~F.col("before")).alias("new_customers"),
        F.count_if(F.col("now") & F.col("before")).alias("retained_customers"),
        F.count_if(F.col("before") & ~F.col("now")).alias("churned_customers"),
        pct(F.count_if(F.col("before") & ~F.col("now")), F.count_if("before")).cast(rate_type).alias("churn_rate"),
        pct(F.count_if(F.col("now") & F.col("before")), F.count_if("before")).cast(rate_type).alias("retention_rate"),
    )
    report = report.withColumn("report_month", df.select(period).distinct().agg(F.max(period)).scalar())
    if generated_at is not None:
        report = report.withColumn("generated_at", F.lit(generated_at).cast("timestamp"))
    return report


def run_retention_churn_report(df: DataFrame, key: str, period: str, path: str, generated_at) -> DataFrame:
    """Compute the report and store it under its month; a rerun replaces that month."""
    return append_report(retention_churn_report(df, key, period, generated_at), path, "report_month")


def churn_label(df: DataFrame, key: str, date: str, as_of, days: int = 90, **scale) -> DataFrame:
    """Every row with its key's days since the last purchase and the churn flag."""
    last = (
        df.groupBy(key).agg(F.max(date).alias("_last"), F.count("*").alias("_rows"))
        .withColumn("days_since", F.date_diff(_today(df, date, as_of), "_last"))
        .withColumn("churn", F.when(F.col("days_since") > days, 1).otherwise(0)).drop("_last")
    )
    return attach(df, last, key, "_rows", **scale)


def churn_rate(labelled: DataFrame) -> DataFrame:
    """Per cent churned of the rows: customers with :func:`customer_features`, orders with :func:`churn_label`."""
    return labelled.agg(rate(F.col("churn") == 1).alias("churn_rate_pct"))


def customer_features(df: DataFrame, key: str, date: str, order_id: str, amount: str, as_of, days: int = 90) -> DataFrame:
    """Frequency, spend, average order, recency and churn flag per customer, in one aggregate of the orders."""
    last = df.groupBy(key).agg(
        F.count(order_id).alias("frequency"), F.sum(amount).alias("total_spend"), mean(amount).alias("avg_order_value"),
        F.date_diff(_today(df, date, as_of), F.max(date)).alias("recency_days"))
    return last.withColumn("churn", F.when(F.col("recency_days") > days, 1).otherwise(0))


def high_risk(features: DataFrame, days: int = 90, orders: int = 3) -> DataFrame:
    return features.where((F.col("recency_days") > days) & (F.col("frequency") < orders))


def repeat_purchase_rate(df: DataFrame, key: str, order_id: str | None = None) -> DataFrame:
    """Per cent of the keys with more than one order."""
    orders = F.count_distinct(order_id) if order_id else F.count("*")
    counts = df.groupBy(key).agg(orders.alias("_orders"))
    return counts.agg(rate(F.col("_orders") > 1, None).alias("repeat_purchase_rate_pct"))


def box_stats(df: DataFrame, by: str, value: str, whisker: float = 1.5, **scale) -> DataFrame:
    """Quartiles, whisker ends and outlier count of ``value`` per group: the numbers of a box plot.

    Quartiles are exact.  For few groups they are selected together; for many groups every row gets its
    rank within the group.  Neither holds a whole group in one task.
    """
    rows = settled(df.select(by, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull()))
    groups = rows.groupBy(by).agg(F.count("*").alias("n"))
    few = groups.limit(SIDE_BY_SIDE + 1).collect()
    if len(few) <= SIDE_BY_SIDE:
        columns = {
            f"g{i}": F.when(F.col(by).eqNullSafe(F.lit(row[by])), F.col("_v")) for i, row in enumerate(few)}
        found = exact_quantiles(rows, columns, (0.25, 0.5, 0.75)) if few else {}
        schema = f"q1 double, median double, q3 double, `{by}` {rows.schema[by].dataType.simpleString()}, n long"
        quartiles = df.sparkSession.createDataFrame(
            [(*found[f"g{i}"], row[by], row["n"]) for i, row in enumerate(few)], schema)
    else:
        ranked = running(rows, [by], ["_v"], {"_place": F.lit(1)})
        ranked = attach(ranked, groups.withColumn("_rows", F.col("n")), by, "_rows", **scale)
        exprs = [F.max("n").alias("n")]
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            spot = F.lit(p) * (F.col("n") - 1)
            low = F.max(F.when(F.col("_place") - 1 == F.floor(spot), F.col("_v")))
            high = F.max(F.when(F.col("_place") - 1 == F.least(F.floor(spot) + 1, F.col("n") - 1), F.col("_v")))
            part = F.max(spot - F.floor(spot))
            exprs.append((low + (high - low) * part).alias(name))
        quartiles = ranked.groupBy(by).agg(*exprs)
    spread = F.col("q3") - F.col("q1")
    low_fence, high_fence = F.col("q1") - whisker * spread, F.col("q3") + whisker * spread
    inside = F.col("_v").between(low_fence, high_fence)
    return (
        attach(rows, quartiles.withColumn("_rows", F.col("n")), by, "_rows", **scale)
        .groupBy(by, "q1", "median", "q3", "n").agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"), F.count_if(~inside).alias("outliers"))
    )
