"""Sales operations reports: channels, profit, deliveries, discounts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bizlens.operators import sales, summary
from bizlens.plans.registry import report

PROFIT = """sum(unit_price * qty) AS revenue, sum(unit_cost * qty) AS cost, sum((unit_price - unit_cost) * qty) AS gross_profit,
    1e2 * CAST(sum((unit_price - unit_cost) * qty) AS DOUBLE) / CAST(sum(unit_price * qty) AS DOUBLE) AS margin_pct"""
COSTED = "line JOIN prod ON product_id = part_id"


def costed(t):
    """Lines with the cost of their product."""
    return t.line.join(t.prod, F.col("product_id") == F.col("part_id"))


def per_order(t, **sums):
    """Sums per order with the order's columns: an order with very many lines is one row in the join."""
    lines = t.line.groupBy("order_id").agg(*[c.alias(n) for n, c in sums.items()])
    return lines.join(t.ord.select("order_id", "customer_id", "order_date", "priority"), "order_id")


@report("profit_overall", "D1 A1", "revenue:f cost:f gross_profit:f margin_pct:f2", f"SELECT {PROFIT} FROM {COSTED}")
def _(t):
    return sales.profit_via(t.line, t.prod, "product_id", "part_id", "qty", "unit_price", "unit_cost")


@report("profit_by_category", "D1 D2", "category:s revenue:f cost:f gross_profit:f margin_pct:f2",
        f"SELECT category, {PROFIT} FROM {COSTED} GROUP BY 1")
def _(t):
    return sales.profit_via(t.line, t.prod, "product_id", "part_id", "qty", "unit_price", "unit_cost", ["category"])


@report("top_products_by_profit", "D9 K2", "product_id:i revenue:f gross_profit:f", f"""
    SELECT * FROM (SELECT product_id, {PROFIT} FROM {COSTED} GROUP BY 1) x ORDER BY gross_profit DESC, product_id LIMIT 20""")
def _(t):
    products = t.prod.withColumn("product_id", F.col("part_id"))
    profits = sales.profit_via(t.line, products, "product_id", "part_id", "qty", "unit_price", "unit_cost", ["product_id"])
    return sales.top_by_profit(profits, ["product_id"])


@report("revenue_by_channel", "D2", "priority:s revenue:f lines:i",
        "SELECT priority, sum(total) AS revenue, count(*) AS lines FROM sale GROUP BY 1")
def _(t):
    return summary.summarize_via(
        t.line, t.ord, "order_id", "order_id", ["priority"], {"revenue": F.col("total"), "lines": F.lit(1)})


@report("avg_order_value_by_channel", "D3", "priority:s avg_order_value:f2", """
    SELECT priority, CAST(sum(total) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value FROM sale GROUP BY 1""")
def _(t):
    return summary.avg_order_value(per_order(t, total=F.sum("total")), ["priority"], "total", "order_id")


@report("avg_order_value", "D3 A1", "avg_order_value:f2",
        "SELECT CAST(sum(total) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value FROM line")
def _(t):
    return summary.avg_order_value(t.line, [], "total", "order_id")


@report("orders_by_supplier_and_channel", "D4", "supplier_id:i priority:s distinct_count:i", """
    SELECT supplier_id, priority, count(DISTINCT order_id) AS distinct_count FROM sale GROUP BY ALL""")
def _(t):
    pairs = summary.distinct_keys(t.line, "supplier_id", "order_id").join(t.ord.select("order_id", "priority"), "order_id")
    return summary.crosstab_distinct(pairs, "supplier_id", "priority", "order_id")


@report("lead_time_by_supplier", "D5 P24", "supplier_id:i avg_days:f6 total_days:i", """
    SELECT supplier_id, CAST(sum(date_diff('day', order_date, ship_date)) AS DOUBLE) / count(*) AS avg_days,
      sum(date_diff('day', order_date, ship_date)) AS total_days FROM sale GROUP BY 1""")
def _(t):
    return sales.lead_time_summary(t.sale, ["supplier_id"], "order_date", "ship_date")


@report("lead_time_by_month", "D5", "month:i total_days:i", """
    SELECT month(order_date) AS month, sum(date_diff('day', order_date, ship_date)) AS total_days FROM sale GROUP BY 1""")
def _(t):
    return sales.lead_time_via(t.line, t.ord, "order_id", F.month("order_date").alias("month"), "order_date", "ship_date")


@report("late_orders", "D6 P23", "delivery:s orders:i", """
    SELECT CASE WHEN date_diff('day', order_date, ship_date) > 90 THEN 'Late' ELSE 'On Time' END AS delivery,
      count(DISTINCT order_id) AS orders FROM sale GROUP BY 1""")
def _(t):
    return sales.late_summary_via(t.line, t.ord, "order_id", "order_date", "ship_date", 90)


@report("orders_by_channel", "D7 W7", "status:s value:i total:i share_pct:f2", """
    SELECT status, count(DISTINCT order_id) AS value, (SELECT count(DISTINCT order_id) FROM line) AS total,
      1e2 * count(DISTINCT order_id) / (SELECT count(DISTINCT order_id) FROM line) AS share_pct FROM line GROUP BY 1""")
def _(t):
    return sales.orders_by_channel(t.line, "status", "order_id")


@report("monthly_sales_orders", "D8 A4", "month:i revenue:f orders:i", """
    SELECT month(order_date) AS month, sum(total) AS revenue, count(DISTINCT order_id) AS orders FROM sale GROUP BY 1""")
def _(t):
    return summary.summarize(per_order(t, total=F.sum("total")), [F.month("order_date").alias("month")], {
        "revenue": F.sum("total"), "orders": F.count("*")})


@report("order_scatter", "D10", "order_id:i priority:s revenue:f discount:f",
        "SELECT order_id, priority, sum(qty * unit_price) AS revenue, sum(discount) AS discount FROM sale GROUP BY ALL")
def _(t):
    sums = per_order(t, revenue=F.sum(F.col("qty") * F.col("unit_price")), discount=F.sum("discount"))
    return sales.order_scatter(sums, "order_id", "priority", F.col("revenue"), "discount")


@report("product_price_points", "D11 A11", "product_id:i avg_price:f2 orders:i revenue:f", """
    SELECT product_id, CAST(sum(unit_price) AS DOUBLE) / count(*) AS avg_price, count(DISTINCT order_id) AS orders,
      sum(qty * unit_price) AS revenue FROM line GROUP BY 1 HAVING count(DISTINCT order_id) BETWEEN 20 AND 35""")
def _(t):
    return sales.product_price_points(
        t.line, "product_id", "unit_price", F.col("qty") * F.col("unit_price"), "order_id", 20, 35)


@report("discount_profit", "D12", "order_id:i line_no:i product_id:i discount:f profit:f level_avg_profit:f2", f"""
    SELECT order_id, line_no, product_id, c.discount, (unit_price - unit_cost) * qty AS profit, level_avg_profit
    FROM (SELECT * FROM {COSTED}) c JOIN (SELECT discount, CAST(sum((unit_price - unit_cost) * qty) AS DOUBLE) / count(*) AS level_avg_profit
      FROM {COSTED} GROUP BY 1) d ON c.discount = d.discount""")
def _(t):
    return sales.discount_profit(costed(t), "discount", "qty", "unit_price", "unit_cost")


@report("revenue_by_country", "D13 A2", "nation:s region:s revenue:f", """
    SELECT n_name AS nation, r_name AS region, sum(amount) AS revenue FROM ord JOIN cust ON customer_id = cust_id
    JOIN nation ON nation_id = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def _(t):
    places = t.cust.join(t.raw("nation"), F.col("nation_id") == F.col("n_nationkey")).join(
        t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    places = places.withColumnsRenamed({"n_name": "nation", "r_name": "region"})
    return summary.summarize_via(t.ord, places, "customer_id", "cust_id", ["nation", "region"], {"revenue": F.col("amount")})
