"""Grouped summaries, KPIs, top-k, shares, pivots, correlations and trends."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from bizlens.functions import mean, pct, per, rate, total, up_down, whole_months
from bizlens.operators.scale import is_small, quantiles_and, running


def kpis(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row of whole-frame measures."""
    return df.agg(*[c.alias(name) for name, c in measures.items()])


def summarize(
    df: DataFrame, by: Sequence[str | Column], measures: dict[str, Column],
    having: Column | str | None = None, order_by: Sequence[Column | str] | None = None, limit: int | None = None,
) -> DataFrame:
    """Measures per group; optional filter on them, order and top-k."""
    out = df.groupBy(*by).agg(*[c.alias(name) for name, c in measures.items()])
    if having is not None:
        out = out.where(having)
    if order_by:
        out = out.orderBy(*order_by)
    return out if limit is None else out.limit(limit)


def top_n(df: DataFrame, by: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the highest ``by``; ``ties`` makes the choice definite."""
    return df.orderBy(F.desc(by), *ties).limit(n)


def top_groups(
    df: DataFrame, by: Sequence[str], measures: dict[str, Column], rank_by: str, n: int = 10
) -> DataFrame:
    """The ``n`` groups with the highest measure, ties in key order."""
    return summarize(df, by, measures, order_by=[F.desc(rank_by), *by], limit=n)


def summarize_via(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, by: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Sums of fact measures by attributes of a dimension.

    The facts are summed per key before the join, so the join moves one row per key and a frequent key
    costs nothing.  Only measures that add up can be given.
    """
    partial = facts.groupBy(F.col(fact_key).alias("_key")).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    joined = partial.join(dim.select(F.col(dim_key).alias("_dim"), *by), F.col("_key") == F.col("_dim"))
    return joined.groupBy(*by).agg(*[F.sum(n).alias(n) for n in sums])


def rate_by(df: DataFrame, by: Sequence[str], condition: Column, digits: int | None = 2) -> DataFrame:
    """Rows, rows that meet the condition and their per cent per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("records"), F.count_if(condition).alias("matching"), rate(condition, digits).alias("pct"))


def billing_by_customer(df: DataFrame, key: str, billed: str, paid: str, n: int | None = 100) -> DataFrame:
    """Records, billed, paid and mean charge per customer, highest billed first."""
    measures = {
        "records": F.count("*"), "total_billed": total(billed), "total_paid": total(paid),
        "avg_charge": mean(billed, 2)}
    return summarize(df, [key], measures, order_by=[F.desc("total_billed"), key], limit=n)


def billing_monthly(
    df: DataFrame, month: str, customer: str, billed: str, paid: str, churned: Column
) -> DataFrame:
    """Records, customers, billed, received, mean charge, churn count and per cent per month."""
    return df.groupBy(month).agg(
        F.count("*").alias("records"), F.count_distinct(customer).alias("unique_customers"),
        total(billed).alias("total_billed"), total(paid).alias("total_received"),
        mean(billed, 2).alias("avg_charge"), F.count_if(churned).alias("churn_count"), rate(churned).alias("churn_pct"))


def filtered_by_customer(
    df: DataFrame, key: str, condition: Column, month: str, sums: dict[str, str]
) -> DataFrame:
    """First and last month, records and sums of the rows that meet a condition, per customer
    (churned customers, pending payments)."""
    return df.where(condition).groupBy(key).agg(
        F.min(month).alias("first_month"), F.max(month).alias("last_month"), F.count("*").alias("records"),
        *[total(c).alias(name) for name, c in sums.items()])


def inventory_velocity(df: DataFrame, product: str, quantity: str, stock: str) -> DataFrame:
    """Units sold and mean stock per product, fast movers first."""
    return summarize(df, [product], {"total_sold": total(quantity), "avg_stock": mean(stock)},
                     order_by=[F.desc("total_sold"), product])


def customer_ltv(df: DataFrame, key: str, date: str, amount: str) -> DataFrame:
    """Lifetime value, orders, mean order, first and last date, and active months per customer."""
    return df.groupBy(key).agg(
        total(amount).alias("lifetime_value"), F.count("*").alias("total_orders"),
        mean(amount).alias("avg_order_value"), F.min(date).alias("first_purchase"), F.max(date).alias("last_purchase"),
    ).withColumn("active_months", whole_months("first_purchase", "last_purchase") + 1)


def describe_measure(df: DataFrame, column: str) -> DataFrame:
    """Count, sum, mean, minimum, maximum and exact median of one column."""
    others = [F.count(column).alias("n"), total(column).alias("total"), mean(column).alias("mean"),
              F.min(column).alias("min"), F.max(column).alias("max")]
    if is_small(df):
        return df.agg(*others, F.percentile(F.col(column).cast("double"), F.lit(0.5)).alias("median"))
    middle, first = quantiles_and(df, {column: column}, (0.5,), others)
    return _one_row(df, others, first).withColumn("median", F.lit(middle[column][0]).cast("double"))


def _one_row(df: DataFrame, aggregates: Sequence[Column], row: Row) -> DataFrame:
    """The fetched values of ``aggregates`` over ``df`` as a frame with the aggregates' types."""
    schema = df.agg(*aggregates).schema
    return df.sparkSession.createDataFrame([tuple(row[f.name] for f in schema.fields)], schema)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per column."""
    value = {c: F.col(c).cast("double") for c in columns}
    moments = [F.struct(
        F.lit(c).alias("column_name"), F.count(value[c]).alias("count"), mean(c).alias("mean"),
        F.stddev_samp(value[c]).alias("std"), F.min(value[c]).alias("min"), F.max(value[c]).alias("max")).alias(f"_{i}")
        for i, c in enumerate(columns)]
    if is_small(df):
        quartiles = [F.percentile(value[c], F.lit([0.25, 0.5, 0.75])).alias(f"_q{i}") for i, c in enumerate(columns)]
        rows = df.agg(*moments, *quartiles)
    else:
        found, first = quantiles_and(df, {c: c for c in columns}, (0.25, 0.5, 0.75), moments)
        rows = _one_row(df, moments, first).withColumns({
            f"_q{i}": F.array(*[F.lit(q).cast("double") for q in found[c]]) for i, c in enumerate(columns)})
    cells = [F.struct(*[F.col(f"_{i}")[n].alias(n) for n in ("column_name", "count", "mean", "std", "min")],
                      *[F.get(f"_q{i}", F.lit(j)).alias(n) for j, n in enumerate(("q25", "q50", "q75"))],
                      F.col(f"_{i}")["max"].alias("max")) for i in range(len(columns))]
    return rows.select(F.inline(F.array(*cells)))


def pivot_matrix(
    df: DataFrame, rows: Sequence[str], column: str, value: Column, domain: Sequence, prefix: str = ""
) -> DataFrame:
    """One row per ``rows``, one column per member of ``domain``."""
    wide = df.groupBy(*rows).pivot(column, list(domain)).agg(value)
    return wide.select(*rows, *[F.col(f"`{d}`").alias(f"{prefix}{d}") for d in domain])


def crosstab(df: DataFrame, row: str, column: str, domain: Sequence, prefix: str = "") -> DataFrame:
    """Counts by row and column, zero where there are none."""
    wide = df.groupBy(row).pivot(column, list(domain)).agg(F.count(F.lit(1)))
    return wide.select(row, *[F.coalesce(F.col(f"`{d}`"), F.lit(0)).alias(f"{prefix}{d}") for d in domain])


def crosstab_pct(
    df: DataFrame, row: str, column: str, domain: Sequence, prefix: str = "", digits: int | None = 2
) -> DataFrame:
    """Cross table in per cent of each row's total over the domain."""
    wide = crosstab(df, row, column, domain, prefix)
    names = [f"{prefix}{d}" for d in domain]
    sums = sum((F.col(n) for n in names), F.lit(0))
    return wide.select(row, *[pct(F.col(n), sums, digits).alias(n) for n in names])


def crosstab_distinct(df: DataFrame, row: str, column: str, counted: str) -> DataFrame:
    """Distinct ``counted`` per pair, long form."""
    return df.groupBy(row, column).agg(F.count_distinct(counted).alias("distinct_count"))


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Rows per value, nulls left out, most frequent first; ``normalize`` adds the per cent."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    if normalize:
        counts = counts.withColumn("pct", pct(F.col("n"), counts.agg(F.sum("n")).scalar()))
    return counts.orderBy(F.desc("n"), column)


def share_of_total(df: DataFrame, by: Sequence[str], measure: Column, digits: int | None = 2) -> DataFrame:
    """A measure per group, the measure of the whole frame, and the share (shares of distinct counts can
    add up to more than 100)."""
    whole = df.agg(measure).scalar()
    return df.groupBy(*by).agg(measure.alias("value")).withColumns({
        "total": whole, "share_pct": pct(F.col("value"), whole, digits)})


def contribution(df: DataFrame, by: Sequence[str], amount: str) -> DataFrame:
    """Revenue per group and its per cent of all revenue."""
    groups = df.groupBy(*by).agg(F.sum(amount).alias("revenue"))
    return groups.withColumn("revenue_pct", pct(F.col("revenue"), groups.agg(F.sum("revenue")).scalar()))


def pareto(df: DataFrame, by: Sequence[str], amount: str, **scale) -> DataFrame:
    """Revenue per group, cumulated from the largest, with the cumulative share."""
    groups = df.groupBy(*by).agg(F.sum(amount).alias("revenue"))
    summed = running(groups, [], [F.desc("revenue"), *by], {"cumulative": F.col("revenue")}, **scale)
    return summed.withColumn("cumulative_pct", pct(F.col("cumulative"), groups.agg(F.sum("revenue")).scalar()))


def rollup_summary(df: DataFrame, levels: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Totals at every level of a hierarchy, ``level`` 0 being the grand total.

    The finest level is summed first; only its rows are expanded to the upper levels.
    """
    finest = df.groupBy(*levels).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    rolled = finest.rollup(*levels).agg(*[F.sum(n).alias(n) for n in sums], F.grouping_id().alias("_gid"))
    depth = F.lit(len(levels)) - F.bit_count("_gid")
    return rolled.withColumn("level", depth.cast("int")).drop("_gid")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, from one aggregate."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[
        F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in dict.fromkeys([(a, b), (b, a)]):
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"c{i}").alias("correlation")))
    return row.select(F.inline(F.array(*cells)))


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` and its R²."""
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_slope(ys, xs).alias("slope"), F.regr_intercept(ys, xs).alias("intercept"), F.regr_r2(ys, xs).alias("r2"))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(f"distinct_{c}") for c in columns])


def avg_order_value(df: DataFrame, by: Sequence[str], amount: str, order_id: str) -> DataFrame:
    """Revenue per distinct order."""
    grouped = df.groupBy(*by) if by else df
    return grouped.agg(per(F.sum(amount), F.count_distinct(order_id), 2).alias("avg_order_value"))


def waterfall(df: DataFrame, by: str, value: str) -> DataFrame:
    """Value per group in group order, the running end point and the direction."""
    groups = df.groupBy(by).agg(F.sum(value).alias("value"))
    summed = running(groups, [], [by], {"running_total": F.col("value")})
    return summed.withColumn("direction", up_down("value"))


def cumulative(df: DataFrame, order: str, value: str) -> DataFrame:
    """Running total in the given order over an already grouped frame."""
    return running(df, [], [order], {"cumulative": F.col(value)})


