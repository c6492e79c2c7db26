"""Data quality and cleaning reports."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from bizlens.operators import clean, quality, summary
from bizlens.plans.registry import report

#: Labels of the customer segments and their standard names (fixed values).
SEGMENT_NAMES = {
    "AUTOMOBILE": "Automotive", "BUILDING": "Construction", "FURNITURE": "Furniture", "HOUSEHOLD": "Home"}


@report("missing_values", "Q1 P7", "null_income:i null_age:i null_gender:i null_day:i", """
    SELECT count(*) FILTER (WHERE income IS NULL) AS null_income, count(*) FILTER (WHERE age IS NULL) AS null_age,
      count(*) FILTER (WHERE gender IS NULL) AS null_gender, count(*) FILTER (WHERE day IS NULL) AS null_day FROM visit""")
def _(t):
    return quality.null_counts(t.visit, ["income", "age", "gender", "day"])


@report("missing_or_blank", "Q1 P7", "null_segment:i null_revenue_text:i null_revenue:i", """
    SELECT count(*) FILTER (WHERE segment IS NULL OR trim(segment) = '') AS null_segment,
      count(*) FILTER (WHERE revenue_text IS NULL OR trim(revenue_text) = '') AS null_revenue_text,
      count(*) FILTER (WHERE revenue IS NULL) AS null_revenue FROM provision""")
def _(t):
    return quality.null_counts(t.provision, ["segment", "revenue_text", "revenue"], blank_as_null=True)


@report("duplicate_lines", "Q2 A11", "order_id:i line_no:i duplicate_count:i total:f", """
    SELECT order_id, line_no, count(*) AS duplicate_count, sum(total) AS total FROM line GROUP BY ALL HAVING count(*) > 1""")
def _(t):
    return quality.duplicates(t.line, ["order_id", "line_no"], {"total": F.sum("total")})


@report("duplicate_row_count", "Q2", "duplicate_rows:i", """
    SELECT (SELECT count(*) FROM line) - (SELECT count(*) FROM (SELECT DISTINCT order_id, line_no, status FROM line) d)
      AS duplicate_rows""")
def _(t):
    return quality.duplicate_row_count(t.line.select("order_id", "line_no", "status"))


@report("large_orders", "Q3 J9 A16", "order_id:i amount:f", """
    SELECT order_id, amount FROM ord WHERE amount > (SELECT avg(CAST(amount AS DOUBLE)) + 1.5e0 * stddev_pop(CAST(amount AS DOUBLE)) FROM ord)""")
def _(t):
    return quality.outliers_above(t.ord, "amount", 1.5)


@report("revenue_anomalies", "Q3 J8 A16", "event_id:i value:f mean:f6 stddev:f6", """
    SELECT event_id, value, (SELECT avg(value) FROM ev) AS mean, (SELECT stddev_pop(value) FROM ev) AS stddev FROM ev
    WHERE value > (SELECT avg(value) + 3 * stddev_pop(value) FROM ev)""")
def _(t):
    return quality.outliers_above(t.ev, "value", 3, keep_stats=True)


@report("zscore_outliers", "Q4 A16", "event_id:i value:f z_score:f6", """
    SELECT * FROM (SELECT event_id, value, (value - (SELECT avg(value) FROM ev)) / (SELECT stddev_pop(value) FROM ev) AS z_score
      FROM ev) z WHERE abs(z_score) > 3""")
def _(t):
    return quality.zscore_outliers(t.ev, "value")


@report("invalid_amounts", "P3 Q5", "cust_id:i balance:f nation_id:i",
        "SELECT cust_id, balance, nation_id FROM cust WHERE balance <= 0 OR nation_id <= 0")
def _(t):
    return quality.invalid_amounts(t.cust, ["balance", "nation_id"])


@report("high_quantity_lines", "P3", "order_id:i line_no:i qty:f total:f",
        "SELECT order_id, line_no, qty, total FROM line WHERE qty >= 45")
def _(t):
    return t.line.where(F.col("qty") >= 45)


@report("shipped_before_ordered", "P4 Q5", "order_id:i line_no:i order_date:s ship_date:s",
        "SELECT order_id, line_no, order_date, ship_date FROM sale WHERE ship_date < order_date")
def _(t):
    return quality.date_order_violations(t.sale, "order_date", "ship_date")


@report("amount_mismatches", "P5 Q5", "order_id:i line_no:i qty:f total:f expected:f", """
    SELECT order_id, line_no, qty, total, round(qty * unit_price, 2) AS expected FROM line
    WHERE round(qty * unit_price, 2) <> round(total, 2)""")
def _(t):
    return quality.amount_mismatch(t.line, "qty", "unit_price", "total")


@report("amount_mismatch_count", "P5 Q5", "mismatch_count:i", """
    SELECT count(*) AS mismatch_count FROM line WHERE round(qty * unit_price, 2) <> round(total, 2)""")
def _(t):
    return quality.amount_mismatch_count(t.line, "qty", "unit_price", "total")


@report("non_numeric_revenue", "P6 Q5", "order_id:i revenue_text:s", """
    SELECT order_id, revenue_text FROM provision WHERE revenue_text IS NULL
      OR NOT regexp_full_match(revenue_text, '[0-9]+([.][0-9]+)?')""")
def _(t):
    return quality.non_numeric(t.provision, "revenue_text")


@report("orphan_parts", "J11", "product_id:i supplier_id:i", """
    SELECT DISTINCT product_id, supplier_id FROM line WHERE product_id NOT IN (SELECT part_id FROM prod)""")
def _(t):
    return summary.distinct_keys(quality.orphans(t.line, t.prod, "product_id", "part_id"), "product_id", "supplier_id")


@report("customers_without_orders", "J11", "cust_id:i nation_id:i", """
    SELECT cust_id, nation_id FROM cust WHERE cust_id NOT IN (SELECT customer_id FROM ord WHERE customer_id IS NOT NULL)""")
def _(t):
    return quality.orphans(t.cust, t.ord, "cust_id", "customer_id")


@report("filtered_range", "P9", "order_id:i order_date:s amount:f priority:s", """
    SELECT order_id, order_date, amount, priority FROM ord WHERE order_date BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'
      AND amount BETWEEN 100000 AND 250000 AND priority BETWEEN '2-HIGH' AND '4-NOT SPECIFIED'""")
def _(t):
    dated = clean.between_filter(t.ord, "order_date", datetime.date(1997, 1, 1), datetime.date(1998, 6, 30))
    return clean.between_filter(clean.between_filter(dated, "amount", 100000, 250000), "priority", "2-HIGH", "4-NOT SPECIFIED")


@report("label_filters", "P2 P8 P11 P1", "event_id:i gender:s age:i", """
    SELECT event_id, gender, age FROM visit WHERE gender IN ('click', 'purchase') AND age IS NOT NULL AND user_id = 8""")
def _(t):
    rows = clean.not_null(clean.is_in(t.visit, "gender", ["click", "purchase"]), "age")
    return clean.where_eq(rows, "user_id", 8)


@report("complete_rows", "P21 P13 P12", "visit_id:i visitor:i earned:f years:i kind:s", """
    SELECT event_id AS visit_id, user_id AS visitor, income AS earned, age AS years, gender AS kind FROM visit
    WHERE income IS NOT NULL AND age IS NOT NULL AND gender IS NOT NULL""")
def _(t):
    return clean.rename(clean.not_null(t.visit.drop("day")), ["visit_id", "visitor", "earned", "years", "kind"])


@report("parsed_dates", "P14", "employee_id:i joined:s left_on:s", """
    SELECT employee_id, coalesce(try_strptime(joined, '%d/%m/%Y'), try_strptime(joined, '%Y-%m-%d'))::DATE AS joined,
      try_strptime(left_on, '%d-%m-%Y')::DATE AS left_on FROM staff""")
def _(t):
    return clean.parse_dates(clean.parse_dates(t.staff, "joined"), "left_on")


@report("month_text_to_date", "P14", "order_id:i month_date:s", """
    SELECT order_id, CAST(concat(report_month, '-01') AS DATE) AS month_date FROM provision""")
def _(t):
    dated = t.provision.withColumn("month_text", F.concat("report_month", F.lit("-01")))
    return clean.parse_dates(dated, "month_text", ["yyyy-MM-dd"], into="month_date")


@report("invalid_date_count", "P14", "invalid_dates:i", """
    SELECT count(*) FILTER (WHERE coalesce(try_strptime(joined, '%d/%m/%Y'), try_strptime(joined, '%Y-%m-%d')) IS NULL)
      AS invalid_dates FROM staff""")
def _(t):
    return clean.count_invalid_dates(t.staff, "joined")


@report("cleaned_salaries", "P15", "employee_id:i salary:f", r"""
    SELECT employee_id, TRY_CAST(nullif(regexp_replace(salary, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS salary FROM staff""")
def _(t):
    return clean.clean_numeric(t.staff, "salary")


@report("cleaned_signed_amounts", "P15", "order_id:i amount:f", """
    SELECT order_id, TRY_CAST(revenue_text AS DOUBLE) AS amount FROM provision""")
def _(t):
    return clean.clean_numeric(t.provision, "revenue_text", "amount", keep_sign=True)


@report("standard_departments", "P16", "department:s n:i", """
    SELECT CASE trim(department) WHEN 'AUTOMOBILE' THEN 'Automotive' WHEN 'BUILDING' THEN 'Construction'
      WHEN 'FURNITURE' THEN 'Furniture' WHEN 'HOUSEHOLD' THEN 'Home' ELSE trim(department) END AS department, count(*) AS n
    FROM staff GROUP BY 1""")
def _(t):
    return summary.value_counts(clean.map_values(t.staff, "department", SEGMENT_NAMES), "department")


@report("filled_missing", "P17", "event_id:i age:f income:f6 gender:s", """
    SELECT event_id, coalesce(age, (SELECT quantile_cont(CAST(age AS DOUBLE), 0.5) FROM visit)) AS age,
      coalesce(income, (SELECT avg(income) FROM visit)) AS income, coalesce(gender, 'Unknown') AS gender FROM visit""")
def _(t):
    return clean.fill_missing(t.visit, {"age": "median", "income": "mean", "gender": "Unknown"})


@report("filled_dates", "P18", "event_id:i day:s", """
    SELECT event_id, coalesce(day, DATE '1970-01-01' + CAST(floor((SELECT quantile_cont(CAST(date_diff('day', DATE '1970-01-01', day)
      AS DOUBLE), 0.5) FROM visit)) AS INTEGER)) AS day FROM visit""")
def _(t):
    return clean.fill_median_date(t.visit, "day")


@report("distinct_rows", "P19", "order_id:i status:s line_status:s",
        "SELECT DISTINCT order_id, status, line_status FROM line")
def _(t):
    return clean.drop_duplicates(t.line.select("order_id", "status", "line_status"))


@report("first_order_per_customer", "P20", "customer_id:i order_id:i order_date:s amount:f", """
    SELECT customer_id, order_id, order_date, amount FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
      ORDER BY order_date, order_id) AS rn FROM ord) r WHERE rn = 1""")
def _(t):
    return clean.dedupe_by(t.ord, ["customer_id"], ["order_date", "order_id"])


@report("latest_order_per_customer", "P20", "customer_id:i order_id:i order_date:s", """
    SELECT customer_id, order_id, order_date FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
      ORDER BY order_date DESC, order_id DESC) AS rn FROM ord) r WHERE rn = 1""")
def _(t):
    return clean.dedupe_by(t.ord, ["customer_id"], ["order_date", "order_id"], keep="last")


@report("late_flags", "P23", "order_id:i line_no:i delivery:s days:i", """
    SELECT order_id, line_no, CASE WHEN date_diff('day', order_date, ship_date) > 90 THEN 'Late' ELSE 'On Time' END AS delivery,
      date_diff('day', order_date, ship_date) AS days FROM sale""")
def _(t):
    return clean.day_lag(clean.late_flag(t.sale, "order_date", "ship_date", 90), "order_date", "ship_date")


@report("payment_delay", "P24", "order_id:i customer_id:i days:i", """
    SELECT order_id, customer_id, date_diff('day', order_date, ship_date) AS days FROM sale WHERE ship_date IS NOT NULL""")
def _(t):
    return clean.day_lag(clean.not_null(t.sale, "ship_date"), "order_date", "ship_date")


@report("staff_tenure", "P25", "employee_id:i tenure:s", """
    WITH s AS (SELECT employee_id, coalesce(try_strptime(joined, '%d/%m/%Y'), try_strptime(joined, '%Y-%m-%d'))::DATE AS j,
      left_on FROM staff),
    m AS (SELECT *, (2025 - year(j)) * 12 + 1 - month(j) - CASE WHEN day(j) > 15 THEN 1 ELSE 0 END AS months FROM s)
    SELECT employee_id, CASE WHEN left_on IS NULL AND j IS NOT NULL THEN concat(months // 12, ' years ', months % 12, ' months ',
      date_diff('day', (j + to_months(CAST(months AS INTEGER)))::DATE, DATE '2025-01-15'), ' days') END AS tenure FROM m""")
def _(t):
    dated = clean.parse_dates(clean.parse_dates(t.staff, "joined"), "left_on")
    return clean.tenure_text(dated, "joined", "left_on", "2025-01-15")
