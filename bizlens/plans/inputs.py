"""The given tables as the reports see them, and the same views as SQL.

Money is ``decimal(18,2)``, dates are dates.  Every view covers its whole table.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizlens.functions import money
from bizlens.sources.readers import table

SQL_VIEWS = {
    "ord": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus AS status, o_orderpriority AS priority
        FROM orders""",
    "line": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
        l_linenumber AS line_no, CAST(l_quantity AS DECIMAL(18,2)) AS qty,
        CAST(l_extendedprice AS DECIMAL(18,2)) AS total, CAST(l_discount AS DECIMAL(18,2)) AS discount,
        CAST(round(CAST(CAST(l_extendedprice / l_quantity AS VARCHAR) AS DECIMAL(38,15)), 2) AS DECIMAL(18,2))
        AS unit_price,
        l_returnflag AS status, l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem""",
    "prod": """SELECT p_partkey AS part_id, p_name AS product_name, p_brand AS brand, p_type AS category,
        p_size AS size, CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost FROM part""",
    "cust": """SELECT c_custkey AS cust_id, c_name AS customer_name, c_nationkey AS nation_id,
        CAST(c_acctbal AS DECIMAL(18,2)) AS balance, c_mktsegment AS segment FROM customer""",
    "sale": """SELECT line.*, ord.customer_id, ord.order_date, ord.priority
        FROM line JOIN ord ON line.order_id = ord.order_id""",
    "ev": """SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type, value,
        CAST(value AS DECIMAL(18,2)) AS amount FROM events""",
    "bill": """SELECT customer_id, strftime(order_date, '%Y-%m') AS billing_month, amount AS charge,
        CASE WHEN status = 'F' THEN amount ELSE CAST(0 AS DECIMAL(18,2)) END AS paid, priority AS plan_type,
        CASE status WHEN 'P' THEN 'Pending' WHEN 'F' THEN 'Paid' ELSE 'Open' END AS payment_status,
        CASE WHEN priority = '1-URGENT' THEN 'Yes' ELSE 'No' END AS churn_flag FROM ord""",
    "bar": """SELECT priority AS ticker, order_date AS day, arg_min(amount, order_id) AS open,
        arg_max(amount, order_id) AS close, max(amount) AS high, min(amount) AS low, count(*) AS volume
        FROM ord GROUP BY priority, order_date""",
    "staff": """SELECT customer_id AS employee_id, CASE WHEN customer_id % 7 = 0 THEN NULL
          ELSE concat('USD ', CAST(min(balance) AS VARCHAR), ' p.a.') END AS salary,
        concat(' ', min(segment), ' ') AS department,
        CASE WHEN customer_id % 5 = 0 THEN 'unknown' WHEN customer_id % 2 = 0
          THEN strftime(min(order_date), '%d/%m/%Y') ELSE strftime(min(order_date), '%Y-%m-%d') END AS joined,
        CASE WHEN customer_id % 3 = 0 THEN strftime(max(order_date), '%d-%m-%Y') END AS left_on
        FROM ord JOIN cust ON cust_id = customer_id GROUP BY customer_id""",
    "visit": """SELECT event_id, user_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS income,
        CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id % 60 + 18 END AS age,
        CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_type END AS gender,
        CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS day FROM events""",
    "scored": """SELECT doc_id, toxic AS label, quality,
        least(n_chars, 4000) % 1000 / 1000e0 AS score,
        CASE WHEN least(n_chars, 4000) % 1000 / 1000e0 >= 0.5 THEN 1 ELSE 0 END AS prediction
        FROM labels JOIN documents USING (doc_id)""",
    "demand": """SELECT status AS store, line_status AS item, ship_date AS day, sum(qty) AS units
        FROM line GROUP BY status, line_status, ship_date""",
    "provision": """SELECT order_id, strftime(order_date, '%Y-%m') AS report_month,
        CASE WHEN order_id % 10 = 0 THEN ' ' WHEN order_id % 10 = 1 THEN NULL ELSE priority END AS segment,
        CASE WHEN order_id % 9 = 0 THEN concat('-', CAST(amount AS VARCHAR)) WHEN order_id % 9 = 1 THEN 'n/a'
          WHEN order_id % 9 = 2 THEN NULL ELSE CAST(amount AS VARCHAR) END AS revenue_text,
        CASE WHEN order_id % 12 = 0 THEN NULL ELSE amount END AS revenue FROM ord""",
}


class Tables:
    """The given tables under ``sf_dir`` and the views on them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def ord(self) -> DataFrame:
        return self.raw("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"), money("o_totalprice").alias("amount"),
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))

    @cached_property
    def line(self) -> DataFrame:
        return self.raw("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"), F.col("l_linenumber").alias("line_no"),
            money("l_quantity").alias("qty"), money("l_extendedprice").alias("total"),
            money("l_discount").alias("discount"),
            money(F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2)).alias("unit_price"),
            F.col("l_returnflag").alias("status"), F.col("l_linestatus").alias("line_status"),
            F.to_date("l_shipdate").alias("ship_date"))

    @cached_property
    def prod(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("part_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"),
            F.col("p_type").alias("category"), F.col("p_size").alias("size"), money("p_retailprice").alias("unit_cost"))

    @cached_property
    def cust(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("customer_name"),
            F.col("c_nationkey").alias("nation_id"), money("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("segment"))

    @cached_property
    def sale(self) -> DataFrame:
        return self.line.join(self.ord.select("order_id", "customer_id", "order_date", "priority"), "order_id")

    @cached_property
    def ev(self) -> DataFrame:
        return self.raw("events").select(
            "event_id", "user_id", F.to_date("ts").alias("day"), "event_type", "value", money("value").alias("amount"))

    @cached_property
    def bill(self) -> DataFrame:
        status = F.col("status")
        return self.ord.select(
            "customer_id", F.date_format("order_date", "yyyy-MM").alias("billing_month"),
            F.col("amount").alias("charge"), F.when(status == "F", F.col("amount")).otherwise(money(F.lit(0))).alias("paid"),
            F.col("priority").alias("plan_type"),
            F.when(status == "P", "Pending").when(status == "F", "Paid").otherwise("Open").alias("payment_status"),
            F.when(F.col("priority") == "1-URGENT", "Yes").otherwise("No").alias("churn_flag"))

    @cached_property
    def bar(self) -> DataFrame:
        return self.ord.groupBy(F.col("priority").alias("ticker"), F.col("order_date").alias("day")).agg(
            F.min_by("amount", "order_id").alias("open"), F.max_by("amount", "order_id").alias("close"),
            F.max("amount").alias("high"), F.min("amount").alias("low"), F.count("*").alias("volume"))

    @cached_property
    def staff(self) -> DataFrame:
        dates = self.ord.groupBy("customer_id").agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
        key = F.col("customer_id")
        return dates.join(self.cust, F.col("cust_id") == key).select(
            key.alias("employee_id"),
            F.when(key % 7 != 0, F.concat(F.lit("USD "), F.col("balance").cast("string"), F.lit(" p.a."))).alias("salary"),
            F.concat(F.lit(" "), "segment", F.lit(" ")).alias("department"),
            F.when(key % 5 == 0, "unknown").when(key % 2 == 0, F.date_format("first", "dd/MM/yyyy")).otherwise(
                F.date_format("first", "yyyy-MM-dd")).alias("joined"),
            F.when(key % 3 == 0, F.date_format("last", "dd-MM-yyyy")).alias("left_on"))

    @cached_property
    def visit(self) -> DataFrame:
        key = F.col("event_id")
        return self.raw("events").select(
            "event_id", "user_id", F.when(key % 11 != 0, F.col("value")).alias("income"),
            F.when(key % 13 != 0, F.col("user_id") % 60 + 18).alias("age"),
            F.when(key % 17 != 0, F.col("event_type")).alias("gender"),
            F.when(key % 19 != 0, F.to_date("ts")).alias("day"))

    @cached_property
    def scored(self) -> DataFrame:
        score = F.least("n_chars", F.lit(4000)) % 1000 / F.lit(1000.0)
        joined = self.raw("labels").join(self.raw("documents").select("doc_id", "n_chars"), "doc_id")
        return joined.select(
            "doc_id", F.col("toxic").alias("label"), "quality", score.alias("score"),
            F.when(score >= 0.5, 1).otherwise(0).alias("prediction"))

    @cached_property
    def demand(self) -> DataFrame:
        return self.line.groupBy(
            F.col("status").alias("store"), F.col("line_status").alias("item"), F.col("ship_date").alias("day")
        ).agg(F.sum("qty").alias("units"))

    @cached_property
    def provision(self) -> DataFrame:
        key, text = F.col("order_id"), F.col("amount").cast("string")
        return self.ord.select(
            "order_id", F.date_format("order_date", "yyyy-MM").alias("report_month"),
            F.when(key % 10 == 0, " ").when(key % 10 == 1, F.lit(None)).otherwise(F.col("priority")).alias("segment"),
            F.when(key % 9 == 0, F.concat(F.lit("-"), text)).when(key % 9 == 1, "n/a").when(key % 9 == 2, F.lit(None))
            .otherwise(text).alias("revenue_text"),
            F.when(key % 12 != 0, F.col("amount")).alias("revenue"))
