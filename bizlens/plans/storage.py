"""Sources and sinks: scans, counts, schemas, views, saved tables, period reports, CSV."""

from __future__ import annotations

from pyspark.sql import functions as F

from bizlens.functions import mean
from bizlens.operators import churn, rfm, summary
from bizlens.plans.customers import segments
from bizlens.plans.registry import report
from bizlens.session import scratch_path
from bizlens.sources import readers, sinks

ORDER_SCHEMA = "order_id bigint, customer_id bigint, order_date date, amount decimal(18,2), priority string"


@report("csv_round_trip", "S1 S10", "order_id:i customer_id:i order_date:s amount:f priority:s",
        "SELECT order_id, customer_id, order_date, amount, priority FROM ord")
def _(t):
    listed = t.ord.select("order_id", "customer_id", "order_date", "amount", "priority")
    path = sinks.write_csv(listed, scratch_path(t.spark, "orders-csv"))
    return readers.read_csv(t.spark, path, ORDER_SCHEMA)


@report("csv_summary_export", "S10 A3", "billing_month:s records:i total_billed:f", """
    SELECT billing_month, count(*) AS records, sum(charge) AS total_billed FROM bill GROUP BY 1""")
def _(t):
    monthly = summary.summarize(t.bill, ["billing_month"], {"records": F.count("*"), "total_billed": F.sum("charge")})
    path = sinks.write_csv(monthly, scratch_path(t.spark, "monthly-csv"), header=False, single_file=True)
    return readers.read_csv(t.spark, path, "billing_month string, records bigint, total_billed double", header=False)


@report("table_scan", "S2 P1", "cust_id:i customer_name:s balance:f segment:s",
        "SELECT cust_id, customer_name, balance, segment FROM cust")
def _(t):
    return t.cust.select("cust_id", "customer_name", "balance", "segment")


@report("preview_orders", "S3", "order_id:i amount:f",
        "SELECT order_id, amount FROM ord ORDER BY order_id LIMIT 500")
def _(t):
    return readers.preview(t.ord.orderBy("order_id"), 500)


@report("row_count", "S4", "total_rows:i", "SELECT count(*) AS total_rows FROM lineitem")
def _(t):
    return readers.row_count(t.raw("lineitem"))


@report("row_and_column_count", "S5 S4", "total_rows:i total_columns:i",
        "SELECT (SELECT count(*) FROM orders) AS total_rows, (SELECT count(*) FROM (DESCRIBE orders)) AS total_columns")
def _(t):
    return readers.shape(t.raw("orders"))


@report("schema_listing", "S5", "position:i column_name:s",
        "SELECT row_number() OVER () AS position, column_name FROM (DESCRIBE lineitem)")
def _(t):
    return readers.describe_schema(t.raw("lineitem"))


@report("daily_revenue_view", "S6", "order_date:s revenue:f transactions:i",
        "SELECT order_date, sum(amount) AS revenue, count(*) AS transactions FROM ord GROUP BY 1")
def _(t):
    daily = summary.summarize(t.ord, ["order_date"], {"revenue": F.sum("amount"), "transactions": F.count("*")})
    return sinks.register_view(daily, "vw_daily_revenue")


@report("saved_segment_table", "S7", "segment:s n:i", """
    SELECT status AS segment, count(*) AS n FROM line GROUP BY 1""")
def _(t):
    counted = summary.summarize(t.line, [F.col("status").alias("segment")], {"n": F.count("*")})
    return sinks.save_table(counted, "bizlens_line_segments", path=scratch_path(t.spark, "segments"))


@report("saved_rfm_table", "S7 R3 R4", "segment:s customers:i avg_monetary:f2", f"""
    SELECT segment, count(*) AS customers, CAST(sum(monetary) AS DOUBLE) / count(*) AS avg_monetary
    FROM ({segments('billing')}) x GROUP BY 1""")
def _(t):
    base = rfm.rfm_base(t.ord, "customer_id", "order_date", "amount")
    scored = rfm.rfm_segment(rfm.rfm_score(base, "customer_id"), "billing")
    saved = sinks.save_table(scored, "bizlens_rfm_segment", path=scratch_path(t.spark, "rfm"), bucket_by="customer_id")
    return summary.summarize(saved, ["segment"], {"customers": F.count("*"), "avg_monetary": mean("monetary", 2)})


@report("saved_customer_totals", "S7 A3", "customer_id:i orders:i total:f last_order:s", """
    SELECT customer_id, count(*) AS orders, sum(amount) AS total, max(order_date) AS last_order FROM ord GROUP BY 1""")
def _(t):
    """Orders saved in buckets of customers, read by name and grouped where they lie."""
    saved = sinks.save_table(t.ord, "bizlens_orders_by_customer", path=scratch_path(t.spark, "orders"), bucket_by="customer_id")
    return summary.summarize(saved, ["customer_id"], {"orders": F.count("*"), "total": F.sum("amount"), "last_order": F.max("order_date")})


@report("stored_churn_report", "S8 C9", "report_month:s total_customers:i new_customers:i retained_customers:i churned_customers:i", """
    WITH q AS (SELECT DISTINCT customer_id, year(order_date) AS y FROM ord WHERE order_date IS NOT NULL)
    SELECT CAST(p.y AS VARCHAR) AS report_month, (SELECT count(*) FROM q WHERE q.y = p.y) AS total_customers,
      (SELECT count(*) FROM q WHERE q.y = p.y AND customer_id NOT IN (SELECT customer_id FROM q r WHERE r.y = p.y - 1)) AS new_customers,
      (SELECT count(*) FROM q WHERE q.y = p.y AND customer_id IN (SELECT customer_id FROM q r WHERE r.y = p.y - 1)) AS retained_customers,
      (SELECT count(*) FROM q WHERE q.y = p.y - 1 AND customer_id NOT IN (SELECT customer_id FROM q r WHERE r.y = p.y)) AS churned_customers
    FROM (SELECT DISTINCT y FROM q) p""")
def _(t):
    yearly = t.ord.withColumn("year", F.year("order_date").cast("string"))
    path = scratch_path(t.spark, "churn-report")
    stored = None
    years = [r.year for r in yearly.select("year").where("year IS NOT NULL").distinct().orderBy("year").collect()]
    for last in [*years, *years[-1:]]:
        until = yearly.where(F.col("year") <= last)
        stored = churn.run_retention_churn_report(until, "customer_id", "year", path, "2025-01-01 00:00:00")
    return stored


@report("staged_key_sets", "S9 A26", "billing_month:s customers:i",
        """SELECT billing_month, count(DISTINCT customer_id) AS customers FROM bill
    WHERE billing_month IN (SELECT DISTINCT billing_month FROM bill ORDER BY 1 DESC LIMIT 2) GROUP BY 1""")
def _(t):
    latest = churn.latest_periods(t.bill, "billing_month")
    keys = summary.distinct_keys(t.bill.join(latest, "billing_month", "left_semi"), "billing_month", "customer_id")
    staged = sinks.stage(keys, "bizlens_month_customers")
    return summary.summarize(staged, ["billing_month"], {"customers": F.count("*")})
