"""Grouped summaries, KPIs, top-k, shares, pivots, binning."""

from __future__ import annotations

from pyspark.sql import functions as F

from bizlens.functions import mean, pct, per, rate
from bizlens.operators import clean, joins, segment, summary
from bizlens.operators.quality import with_scalars
from bizlens.plans.registry import report


@report("order_kpis", "A1 A10 J9", "customers:i orders:i revenue:f avg_order_value:f2", """
    SELECT count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders, sum(amount) AS revenue,
      CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order_value FROM ord""")
def _(t):
    return summary.kpis(t.ord, {
        "customers": F.count_distinct("customer_id"), "orders": F.count_distinct("order_id"),
        "revenue": F.sum("amount"), "avg_order_value": mean("amount", 2)})


@report("retail_kpis", "A1", "transactions:i revenue:f avg_ticket:f2 units:f", """
    SELECT count(*) AS transactions, sum(total) AS revenue, CAST(sum(total) AS DOUBLE) / count(*) AS avg_ticket,
      sum(qty) AS units FROM line""")
def _(t):
    return summary.kpis(t.line, {
        "transactions": F.count("*"), "revenue": F.sum("total"), "avg_ticket": mean("total", 2), "units": F.sum("qty")})


@report("summary_by_priority", "A2", "priority:s customers:i avg_revenue:f2 revenue:f", """
    SELECT priority, count(*) AS customers, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_revenue,
      sum(amount) AS revenue FROM ord GROUP BY 1""")
def _(t):
    return summary.summarize(t.ord, ["priority"], {
        "customers": F.count("*"), "avg_revenue": mean("amount", 2), "revenue": F.sum("amount")},
        order_by=[F.desc("revenue")])


@report("category_summary", "A2 J1", "category:s revenue:f units:f", """
    SELECT category, sum(total) AS revenue, sum(qty) AS units FROM line JOIN prod ON product_id = part_id GROUP BY 1""")
def _(t):
    return summary.summarize_via(t.line, t.prod, "product_id", "part_id", ["category"], {
        "revenue": F.col("total"), "units": F.col("qty")})


@report("product_status_summary", "A2", "product_id:i status:s revenue:f qty_sold:f tx_count:i", """
    SELECT product_id, status, sum(total) AS revenue, sum(qty) AS qty_sold, count(*) AS tx_count FROM line GROUP BY ALL""")
def _(t):
    return summary.summarize(t.line, ["product_id", "status"], {
        "revenue": F.sum("total"), "qty_sold": F.sum("qty"), "tx_count": F.count("*")})


@report("revenue_by_segment_and_nation", "A2 D13", "segment:s nation:s revenue:f", """
    SELECT segment, n_name AS nation, sum(amount) AS revenue FROM ord JOIN cust ON customer_id = cust_id
    JOIN nation ON nation_id = n_nationkey GROUP BY ALL""")
def _(t):
    places = t.cust.join(t.raw("nation"), F.col("nation_id") == F.col("n_nationkey")).withColumnRenamed("n_name", "nation")
    return summary.summarize_via(t.ord, places, "customer_id", "cust_id", ["segment", "nation"], {"revenue": F.col("amount")})


@report("billing_by_customer", "A3", "customer_id:i records:i total_billed:f total_paid:f avg_charge:f2", """
    SELECT customer_id, count(*) AS records, sum(charge) AS total_billed, sum(paid) AS total_paid,
      CAST(sum(charge) AS DOUBLE) / count(*) AS avg_charge FROM bill GROUP BY 1
    ORDER BY total_billed DESC, customer_id LIMIT 100""")
def _(t):
    return summary.billing_by_customer(t.bill, "customer_id", "charge", "paid")


@report("usage_by_user", "A3 K2", "user_id:i records:i total_usage:f avg_usage:f2", """
    SELECT user_id, count(*) AS records, sum(amount) AS total_usage, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_usage
    FROM ev GROUP BY 1 ORDER BY total_usage DESC, user_id LIMIT 100""")
def _(t):
    return summary.top_groups(t.ev, ["user_id"], {
        "records": F.count("*"), "total_usage": F.sum("amount"), "avg_usage": mean("amount", 2)}, "total_usage", 100)


@report("signup_year_summary", "A6", "signup_year:i customers:i avg_ltv:f2 revenue:f", """
    SELECT year(first_date) AS signup_year, count(*) AS customers, CAST(sum(ltv) AS DOUBLE) / count(*) AS avg_ltv,
      sum(ltv) AS revenue FROM (SELECT customer_id, min(order_date) AS first_date, sum(amount) AS ltv FROM ord GROUP BY 1) c
    GROUP BY 1""")
def _(t):
    customers = summary.summarize(t.ord, ["customer_id"], {"signup": F.min("order_date"), "ltv": F.sum("amount")})
    return summary.summarize(customers, [F.year("signup").alias("signup_year")], {
        "customers": F.count("*"), "avg_ltv": mean("ltv", 2), "revenue": F.sum("ltv")}, order_by=["signup_year"])


@report("billing_monthly", "A7",
        "billing_month:s records:i unique_customers:i total_billed:f total_received:f avg_charge:f2 churn_count:i churn_pct:f2", """
    SELECT billing_month, count(*) AS records, count(DISTINCT customer_id) AS unique_customers, sum(charge) AS total_billed,
      sum(paid) AS total_received, CAST(sum(charge) AS DOUBLE) / count(*) AS avg_charge,
      count(*) FILTER (WHERE churn_flag = 'Yes') AS churn_count,
      1e2 * count(*) FILTER (WHERE churn_flag = 'Yes') / count(*) AS churn_pct FROM bill GROUP BY 1""")
def _(t):
    return summary.billing_monthly(t.bill, "billing_month", "customer_id", "charge", "paid", F.col("churn_flag") == "Yes")


@report("return_rate_by_brand", "A8", "brand:s records:i matching:i pct:f2", """
    SELECT brand, count(*) AS records, count(*) FILTER (WHERE status = 'R') AS matching,
      1e2 * count(*) FILTER (WHERE status = 'R') / count(*) AS pct FROM line JOIN prod ON product_id = part_id GROUP BY 1""")
def _(t):
    counted = summary.summarize_via(t.line, t.prod, "product_id", "part_id", ["brand"], {
        "records": F.lit(1), "matching": F.when(F.col("status") == "R", 1).otherwise(0)})
    return counted.withColumn("pct", pct(F.col("matching"), F.col("records")))


@report("supplier_problem_orders", "A8 P11", "supplier_id:i records:i matching:i", """
    SELECT supplier_id, count(*) AS records, count(*) FILTER (WHERE status IN ('R', 'A')) AS matching FROM line GROUP BY 1""")
def _(t):
    return summary.rate_by(t.line, ["supplier_id"], F.col("status").isin("R", "A"))


@report("churn_by_plan_and_payment", "A8", "plan_type:s payment_status:s records:i matching:i pct:f2", """
    SELECT plan_type, payment_status, count(*) AS records, count(*) FILTER (WHERE paid = 0) AS matching,
      1e2 * count(*) FILTER (WHERE paid = 0) / count(*) AS pct FROM bill GROUP BY ALL""")
def _(t):
    return summary.rate_by(t.bill, ["plan_type", "payment_status"], F.col("paid") == 0)


@report("churned_customers", "A9 P2", "customer_id:i first_month:s last_month:s records:i total_billed:f total_paid:f", """
    SELECT customer_id, min(billing_month) AS first_month, max(billing_month) AS last_month, count(*) AS records,
      sum(charge) AS total_billed, sum(paid) AS total_paid FROM bill WHERE churn_flag = 'Yes' GROUP BY 1""")
def _(t):
    return summary.filtered_by_customer(t.bill, "customer_id", F.col("churn_flag") == "Yes", "billing_month", {
        "total_billed": "charge", "total_paid": "paid"})


@report("pending_payments", "A9", "customer_id:i last_month:s records:i total_pending:f", """
    SELECT customer_id, max(billing_month) AS last_month, count(*) AS records, sum(charge) AS total_pending
    FROM bill WHERE payment_status = 'Pending' GROUP BY 1""")
def _(t):
    return summary.filtered_by_customer(t.bill, "customer_id", F.col("payment_status") == "Pending", "billing_month", {
        "total_pending": "charge"})


@report("distinct_counts", "A10", "distinct_product_id:i distinct_supplier_id:i distinct_status:i", """
    SELECT count(DISTINCT product_id) AS distinct_product_id, count(DISTINCT supplier_id) AS distinct_supplier_id,
      count(DISTINCT status) AS distinct_status FROM line""")
def _(t):
    return summary.distinct_counts(t.line, ["product_id", "supplier_id", "status"])


@report("frequent_products", "A11", "product_id:i orders:i revenue:f", """
    SELECT product_id, count(DISTINCT order_id) AS orders, sum(total) AS revenue FROM line GROUP BY 1
    HAVING count(DISTINCT order_id) >= 30""")
def _(t):
    return summary.summarize(t.line, ["product_id"], {
        "orders": F.count_distinct("order_id"), "revenue": F.sum("total")}, having="orders >= 30")


@report("inventory_velocity", "A14", "product_id:i total_sold:f avg_stock:f6", """
    SELECT product_id, sum(qty) AS total_sold, CAST(sum(size) AS DOUBLE) / count(*) AS avg_stock
    FROM line JOIN prod ON product_id = part_id GROUP BY 1""")
def _(t):
    sold = t.line.groupBy("product_id").agg(F.sum("qty").alias("qty"))
    return summary.inventory_velocity(
        sold.join(t.prod, F.col("product_id") == F.col("part_id")), "product_id", "qty", "size")


@report("describe_order_value", "A17 W6", "n:i total:f mean:f6 min:f max:f median:f4", """
    SELECT count(amount) AS n, sum(amount) AS total, CAST(sum(amount) AS DOUBLE) / count(*) AS mean, min(amount) AS min,
      max(amount) AS max, quantile_cont(CAST(amount AS DOUBLE), 0.5) AS median FROM ord""")
def _(t):
    return summary.describe_measure(t.ord, "amount")


@report("describe_columns", "A17", "column_name:s count:i mean:f6 std:f6 min:f q25:f4 q50:f4 q75:f4 max:f", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, CAST(sum({c}) AS DOUBLE) / count({c}) AS mean,
    stddev_samp(CAST({c} AS DOUBLE)) AS std, min({c}) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25,
    quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, max({c}) AS max
    FROM line""" for c in ("qty", "total", "discount")))
def _(t):
    return summary.describe(t.line, ["qty", "total", "discount"])


@report("revenue_pivot", "A19", "priority:s st_F:f st_O:f st_P:f", """
    SELECT priority, sum(CASE WHEN status = 'F' THEN amount END) AS st_F, sum(CASE WHEN status = 'O' THEN amount END) AS st_O,
      sum(CASE WHEN status = 'P' THEN amount END) AS st_P FROM ord GROUP BY 1""")
def _(t):
    return summary.pivot_matrix(t.ord, ["priority"], "status", F.sum("amount"), ["F", "O", "P"], "st_")


@report("status_crosstab_pct", "A20", "priority:s st_F:f2 st_O:f2 st_P:f2", """
    SELECT priority, 1e2 * count(*) FILTER (WHERE status = 'F') / count(*) AS st_F,
      1e2 * count(*) FILTER (WHERE status = 'O') / count(*) AS st_O,
      1e2 * count(*) FILTER (WHERE status = 'P') / count(*) AS st_P FROM ord GROUP BY 1""")
def _(t):
    return summary.crosstab_pct(t.ord, "priority", "status", ["F", "O", "P"], "st_")


@report("event_type_shares", "A21", "event_type:s n:i pct:f2", """
    SELECT event_type, count(*) AS n, 1e2 * count(*) / (SELECT count(event_type) FROM ev) AS pct FROM ev GROUP BY 1""")
def _(t):
    return summary.value_counts(t.ev, "event_type", normalize=True)


@report("geography_rollup", "A23", "level:i region:s nation:s customer:i revenue:f", """
    SELECT 3 - (grouping(r_name) + grouping(n_name) + grouping(customer_id)) AS level, r_name AS region, n_name AS nation,
      customer_id AS customer, sum(amount) AS revenue
    FROM ord JOIN cust ON customer_id = cust_id JOIN nation ON nation_id = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, n_name, customer_id)""")
def _(t):
    places = t.cust.join(t.raw("nation"), F.col("nation_id") == F.col("n_nationkey")).join(
        t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    spent = summary.summarize_via(t.ord, places.withColumn("customer", F.col("cust_id")), "customer_id", "cust_id", [
        "r_name", "n_name", "customer"], {"amount": F.col("amount")})
    named = clean.rename(spent, {"r_name": "region", "n_name": "nation"})
    return summary.rollup_summary(named, ["region", "nation", "customer"], {"revenue": F.col("amount")})


@report("line_correlation", "A24", "x:s y:s correlation:f6", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS correlation FROM line"
    for a in ("qty", "total", "discount") for b in ("qty", "total", "discount")))
def _(t):
    return summary.corr_matrix(t.line, ["qty", "total", "discount"])


@report("distinct_customers", "A26", "customer_id:i", "SELECT DISTINCT customer_id FROM ord")
def _(t):
    return summary.distinct_keys(t.ord, "customer_id")


@report("top_orders", "K1", "order_id:i customer_id:i amount:f order_date:s",
        "SELECT order_id, customer_id, amount, order_date FROM ord ORDER BY amount DESC, order_id LIMIT 50")
def _(t):
    return summary.top_n(t.ord.select("order_id", "customer_id", "amount", "order_date"), "amount", 50, ["order_id"])


@report("top_suppliers", "K2", "supplier_id:i revenue:f tx_count:i avg_order:f2", """
    SELECT supplier_id, sum(total) AS revenue, count(*) AS tx_count, CAST(sum(total) AS DOUBLE) / count(*) AS avg_order
    FROM line GROUP BY 1 ORDER BY revenue DESC, supplier_id LIMIT 10""")
def _(t):
    return summary.top_groups(t.line, ["supplier_id"], {
        "revenue": F.sum("total"), "tx_count": F.count("*"), "avg_order": mean("total", 2)}, "revenue", 10)


@report("share_of_orders", "W7 D7", "priority:s value:i total:i share_pct:f2", """
    SELECT priority, count(DISTINCT order_id) AS value, (SELECT count(DISTINCT order_id) FROM ord) AS total,
      1e2 * count(DISTINCT order_id) / (SELECT count(DISTINCT order_id) FROM ord) AS share_pct FROM ord GROUP BY 1""")
def _(t):
    return summary.share_of_total(t.ord, ["priority"], F.count_distinct("order_id"))


@report("brand_contribution", "G2 J8", "status:s revenue:f revenue_pct:f2", """
    SELECT status, sum(total) AS revenue, 1e2 * CAST(sum(total) AS DOUBLE) / (SELECT CAST(sum(total) AS DOUBLE) FROM line)
      AS revenue_pct FROM line GROUP BY 1""")
def _(t):
    return summary.contribution(t.line, ["status"], "total")


@report("customer_pareto", "G3 W3", "customer_id:i revenue:f cumulative:f cumulative_pct:f2", """
    SELECT customer_id, revenue, cumulative, 1e2 * CAST(cumulative AS DOUBLE) / (SELECT CAST(sum(amount) AS DOUBLE) FROM ord)
      AS cumulative_pct FROM (SELECT *, sum(revenue) OVER (ORDER BY revenue DESC, customer_id ROWS UNBOUNDED PRECEDING)
      AS cumulative FROM (SELECT customer_id, sum(amount) AS revenue FROM ord GROUP BY 1) g) w""")
def _(t):
    return summary.pareto(t.ord, ["customer_id"], "amount")


@report("segment_waterfall", "W11 W3 N7", "segment:s value:f running_total:f direction:s", """
    SELECT segment, value, sum(value) OVER (ORDER BY segment ROWS UNBOUNDED PRECEDING) AS running_total,
      CASE WHEN value >= 0 THEN 'Increase' ELSE 'Decrease' END AS direction
    FROM (SELECT segment, sum(balance - 5000) AS value FROM cust GROUP BY 1) x""")
def _(t):
    return summary.waterfall(t.cust.withColumn("gap", F.col("balance") - 5000), "segment", "gap")


@report("order_value_vs_average", "J8 J9", "order_id:i amount:f above_average:b", """
    SELECT order_id, amount, amount > (SELECT CAST(sum(amount) AS DOUBLE) / count(*) FROM ord) AS above_average FROM ord""")
def _(t):
    known = with_scalars(t.ord, {"average": mean("amount")})
    return known.withColumn("above_average", F.col("amount").cast("double") > F.col("average"))


@report("denormalized_customers", "J10", "cust_id:i customer_name:s n_name:s r_name:s", """
    SELECT cust_id, customer_name, n_name, r_name FROM cust JOIN nation ON nation_id = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")
def _(t):
    nations = t.raw("nation").withColumnRenamed("n_nationkey", "nation_id").withColumnRenamed("n_regionkey", "region_id")
    regions = t.raw("region").withColumnRenamed("r_regionkey", "region_id")
    return joins.denormalize(t.cust, nations, regions, "nation_id", "region_id")


@report("order_with_customer_total", "J1 W8", "order_id:i customer_total:f first_order:s", """
    SELECT order_id, sum(amount) OVER (PARTITION BY customer_id) AS customer_total,
      min(order_date) OVER (PARTITION BY customer_id) AS first_order FROM ord""")
def _(t):
    return joins.with_group_values(t.ord, "customer_id", {"customer_total": F.sum("amount"), "first_order": F.min("order_date")})


@report("customers_and_suppliers_by_nation", "J3 J4", "nation_id:i customers:i suppliers:i", """
    SELECT c.nation_id, customers, coalesce(suppliers, 0) AS suppliers
    FROM (SELECT nation_id, count(*) AS customers FROM cust GROUP BY 1) c LEFT JOIN
      (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) s ON c.nation_id = s_nationkey""")
def _(t):
    buyers = summary.summarize(t.cust, ["nation_id"], {"customers": F.count("*")})
    sellers = summary.summarize(
        t.raw("supplier").withColumnRenamed("s_nationkey", "nation_id"), ["nation_id"], {"suppliers": F.count("*")})
    return joins.join_aggregates(buyers, sellers, ["nation_id"], "left").fillna(0, subset=["suppliers"])


@report("spend_terciles", "N2 A22", "bin:s n:i total:f mean:f4", """
    WITH q AS (SELECT quantile_cont(CAST(amount AS DOUBLE), 1/3e0) AS a, quantile_cont(CAST(amount AS DOUBLE), 2/3e0) AS b FROM ord)
    SELECT CASE WHEN amount <= (SELECT a FROM q) THEN 'Low' WHEN amount <= (SELECT b FROM q) THEN 'Medium' ELSE 'High' END AS bin,
      count(*) AS n, sum(amount) AS total, CAST(sum(amount) AS DOUBLE) / count(*) AS mean FROM ord GROUP BY 1""")
def _(t):
    binned = segment.qcut(t.ord, "amount", 3, ["Low", "Medium", "High"])
    return summary.summarize(binned, ["bin"], {"n": F.count("*"), "total": F.sum("amount"), "mean": mean("amount")})


@report("order_value_histogram", "N3", "bin_start:f n:i",
        "SELECT floor(CAST(amount AS DOUBLE) / 255e0) * 255e0 AS bin_start, count(*) AS n FROM ord GROUP BY 1")
def _(t):
    return segment.histogram(t.ord, "amount", 255)


@report("event_value_histogram", "N3", "bin:i bin_start:f6 n:i", """
    WITH m AS (SELECT min(value) AS low, max(value) AS high FROM ev),
    c AS (SELECT CASE WHEN value = (SELECT high FROM m) THEN 19 ELSE least(floor((value - (SELECT low FROM m)) /
      (((SELECT high FROM m) - (SELECT low FROM m)) / 20e0)), 19) END AS bin, count(*) AS n FROM ev GROUP BY 1)
    SELECT r AS bin, (SELECT low FROM m) + r * (((SELECT high FROM m) - (SELECT low FROM m)) / 20e0) AS bin_start,
      coalesce(n, 0) AS n FROM range(20) t(r) LEFT JOIN c ON c.bin = r""")
def _(t):
    return segment.equal_width_histogram(t.ev, "value", 20)


@report("revenue_value_buckets", "N5", "bucket:s n:i total:f", """
    SELECT CASE WHEN revenue IS NULL THEN 'Unknown' WHEN revenue < 50000 THEN 'A' WHEN revenue < 150000 THEN 'B'
      WHEN revenue < 300000 THEN 'C' ELSE 'D' END AS bucket, count(*) AS n, sum(revenue) AS total FROM provision GROUP BY 1""")
def _(t):
    return segment.bucket_summary(t.provision, "revenue", [50000, 150000, 300000], ["A", "B", "C", "D"])


@report("arpu", "D14 A1", "customers:i revenue:f arpu:f2 large_share:f2", """
    SELECT count(DISTINCT customer_id) AS customers, sum(amount) AS revenue,
      CAST(sum(amount) AS DOUBLE) / count(DISTINCT customer_id) AS arpu,
      1e2 * count(*) FILTER (WHERE amount > 200000) / count(*) AS large_share FROM ord""")
def _(t):
    return summary.kpis(t.ord, {
        "customers": F.count_distinct("customer_id"), "revenue": F.sum("amount"),
        "arpu": per(F.sum("amount"), F.count_distinct("customer_id"), 2), "large_share": rate(F.col("amount") > 200000)})
