"""Sales operations: revenue, cost, profit, channels, lead times, discounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions import mean, pct
from bizlens.operators.clean import late_flag
from bizlens.operators.joins import with_group_value
from bizlens.operators.summary import share_of_total


def profit_columns(qty: str, price: str, cost: str) -> dict[str, Column]:
    """Revenue, cost, gross profit and margin as aggregates."""
    revenue, spent = F.sum(F.col(price) * F.col(qty)), F.sum(F.col(cost) * F.col(qty))
    profit = F.sum((F.col(price) - F.col(cost)) * F.col(qty))
    return {"revenue": revenue, "cost": spent, "gross_profit": profit, "margin_pct": pct(profit, revenue)}


def profit_measures(df: DataFrame, qty: str, price: str, cost: str, by: Sequence[str] = ()) -> DataFrame:
    measures = [c.alias(n) for n, c in profit_columns(qty, price, cost).items()]
    return df.groupBy(*by).agg(*measures) if by else df.agg(*measures)


def profit_via(
    lines: DataFrame, products: DataFrame, line_key: str, product_key: str, qty: str, price: str, cost: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """The profit measures when the cost is a product column, by attributes of the product.

    Revenue and units are summed per product before the join, so it moves one row per product and a
    product with very many lines costs nothing.
    """
    sold = lines.groupBy(F.col(line_key).alias("_sold")).agg(
        F.sum(F.col(price) * F.col(qty)).alias("_revenue"), F.sum(qty).alias("_units"))
    costs = products.select(F.col(product_key).alias("_made"), F.col(cost).alias("_unit_cost"), *by)
    joined = sold.join(costs, F.col("_sold") == F.col("_made"))
    revenue, spent = F.sum("_revenue"), F.sum(F.col("_units") * F.col("_unit_cost"))
    grouped = joined.groupBy(*by) if by else joined
    return grouped.agg(
        revenue.alias("revenue"), spent.alias("cost"), (revenue - spent).alias("gross_profit"),
        pct(revenue - spent, revenue).alias("margin_pct"))


def lead_time_summary(df: DataFrame, by: Sequence[str | Column], start: str, end: str) -> DataFrame:
    """Mean and total days from start to end per group."""
    days = F.date_diff(end, start)
    return df.groupBy(*by).agg(mean(days).alias("avg_days"), F.sum(days).alias("total_days"))


def lead_time_via(lines: DataFrame, orders: DataFrame, order_id: str, by: Column, start: str, end: str) -> DataFrame:
    """Mean and total days when the start is a column of the order, by an expression on the order.

    The ends of an order's lines are summed as day numbers before the join.
    """
    day = F.unix_date(end)
    sums = lines.groupBy(order_id).agg(F.sum(day).alias("_ends"), F.count(end).alias("_lines"))
    joined = sums.join(orders, order_id).where(F.col(start).isNotNull())
    days = F.sum(F.col("_ends") - F.col("_lines") * F.unix_date(start))
    return joined.groupBy(by).agg((days / F.sum("_lines")).alias("avg_days"), days.alias("total_days"))


def late_summary_via(lines: DataFrame, orders: DataFrame, order_id: str, start: str, end: str, days: int = 5) -> DataFrame:
    """:func:`late_summary` when the start is a column of the order: an order's first and last end tell whether it has
    late lines and lines on time, so one row per order is joined."""
    ends = lines.groupBy(order_id).agg(F.min(end).alias("_first"), F.max(end).alias("_last"), F.bool_or(F.isnull(end)).alias("_open"))
    known = F.array("_first", "_last")
    either = F.when(F.col("_open"), F.concat(known, F.array(F.lit(None).cast("date")))).otherwise(known)
    rows = ends.join(orders.select(order_id, start), order_id)
    return late_summary(rows.select(order_id, start, F.explode(F.array_distinct(either)).alias(end)), start, end, order_id, days)


def late_summary(df: DataFrame, start: str, end: str, order_id: str, days: int = 5) -> DataFrame:
    """Distinct orders delivered late and on time."""
    flagged = late_flag(df, start, end, days)
    return flagged.groupBy("delivery").agg(F.count_distinct(order_id).alias("orders"))


def orders_by_channel(df: DataFrame, channel: str, order_id: str) -> DataFrame:
    """Distinct orders per channel, all orders, and the share."""
    return share_of_total(df, [channel], F.count_distinct(order_id))


def top_by_profit(profits: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` most profitable groups of a profit table."""
    return profits.orderBy(F.desc("gross_profit"), *keys).limit(n)


def order_scatter(df: DataFrame, order_id: str, channel: str, amount: Column, discount: str) -> DataFrame:
    """Revenue and summed discount per order and channel."""
    return df.groupBy(order_id, channel).agg(F.sum(amount).alias("revenue"), F.sum(discount).alias("discount"))


def product_price_points(
    df: DataFrame, product: str, price: str, amount: Column, order_id: str, low: int, high: int
) -> DataFrame:
    """Mean price, distinct orders and revenue of the products whose number of orders lies in a range."""
    return df.groupBy(product).agg(
        mean(price, 2).alias("avg_price"), F.count_distinct(order_id).alias("orders"), F.sum(amount).alias("revenue"),
    ).where(F.col("orders").between(low, high))


def discount_profit(df: DataFrame, discount: str, qty: str, price: str, cost: str, **scale) -> DataFrame:
    """Profit of every row with the mean profit of its discount level."""
    rows = df.withColumn("profit", (F.col(price) - F.col(cost)) * F.col(qty))
    return with_group_value(rows, discount, mean("profit", 2), "level_avg_profit", **scale)
