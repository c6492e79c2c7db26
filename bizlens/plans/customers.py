"""Customer reports: RFM, cohorts, churn, lifetime value, baskets."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from bizlens.functions import recency_bucket
from bizlens.operators import basket, churn, cohort, rfm, segment, summary
from bizlens.plans.registry import report

RFM_BASE = """SELECT customer_id, max(order_date) AS last_date, count(*) AS frequency, sum(amount) AS monetary,
    date_diff('day', max(order_date), (SELECT max(order_date) FROM ord)) AS recency_days
    FROM ord GROUP BY customer_id"""


def scores(n: int, high: bool) -> str:
    r, v = ("DESC", "ASC") if high else ("ASC", "DESC")
    return f"""SELECT *, ntile({n}) OVER (ORDER BY recency_days {r}, customer_id) AS r_score,
        ntile({n}) OVER (ORDER BY frequency {v}, customer_id) AS f_score,
        ntile({n}) OVER (ORDER BY monetary {v}, customer_id) AS m_score FROM ({RFM_BASE}) b"""


def segments(rules: str, high: bool = True) -> str:
    listed, default = rfm.RULE_SETS[rules]
    whens = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in listed)
    return f"""SELECT *, concat(r_score, f_score, m_score) AS rfm_code, CASE {whens} ELSE '{default}' END AS segment
        FROM ({scores(5, high)}) s"""


def base(t):
    return rfm.rfm_base(t.ord, "customer_id", "order_date", "amount")


def segmented(t, rules="detailed", high=True):
    return rfm.rfm_segment(rfm.rfm_score(base(t), "customer_id", best_is_high=high), rules)


@report("rfm_base", "R1 J8 J9", "customer_id:i last_date:s frequency:i monetary:f recency_days:i", RFM_BASE)
def _(t):
    return base(t)


@report("rfm_base_as_of", "R1", "customer_id:i frequency:i monetary:f recency_days:i", """
    SELECT customer_id, count(DISTINCT order_id) AS frequency, sum(amount) AS monetary,
      date_diff('day', max(order_date), DATE '2025-01-01') AS recency_days FROM ord GROUP BY customer_id""")
def _(t):
    return rfm.rfm_base(t.ord, "customer_id", "order_date", "amount", "2025-01-01", "order_id")


@report("rfm_supplier", "R1", "supplier_id:i frequency:i monetary:f recency_days:i", """
    SELECT supplier_id, count(DISTINCT order_id) AS frequency, sum(total) AS monetary,
      date_diff('day', max(ship_date), (SELECT max(ship_date) FROM line)) AS recency_days
    FROM line GROUP BY supplier_id""")
def _(t):
    return rfm.rfm_base(t.line, "supplier_id", "ship_date", "total", order_id="order_id")


@report("rfm_scores", "R2 W1", "customer_id:i r_score:i f_score:i m_score:i", scores(5, True))
def _(t):
    return rfm.rfm_score(base(t), "customer_id")


@report("rfm_scores_one_is_best", "R2 W1", "customer_id:i r_score:i f_score:i m_score:i rfm_score:i",
        f"SELECT *, r_score + f_score + m_score AS rfm_score FROM ({scores(5, False)}) x")
def _(t):
    return rfm.rfm_score(base(t), "customer_id", best_is_high=False, total=True)


@report("rfm_quartiles", "R2 W1", "customer_id:i recency_days:i f_score:i m_score:i", scores(4, False))
def _(t):
    return rfm.rfm_score(base(t), "customer_id", 4, best_is_high=False, recency=False)


@report("rfm_segment_counts", "R3 N6", "segment:s customers:i",
        f"SELECT segment, count(*) AS customers FROM ({segments('detailed')}) x GROUP BY segment")
def _(t):
    return rfm.segment_counts(segmented(t))


@report("rfm_segment_counts_standard", "R3 N6", "segment:s customers:i",
        f"SELECT segment, count(*) AS customers FROM ({segments('standard')}) x GROUP BY segment")
def _(t):
    return rfm.segment_counts(segmented(t, "standard"))


@report("rfm_segments_billing", "R3 N6", "customer_id:i rfm_code:s segment:s", segments("billing", False))
def _(t):
    return segmented(t, "billing", False)


@report("rfm_segment_members", "R4 K1", "customer_id:i monetary:f segment:s", f"""
    SELECT * FROM ({segments('billing')}) x WHERE segment = 'At Risk' ORDER BY monetary DESC, customer_id LIMIT 500""")
def _(t):
    return rfm.segment_members(segmented(t, "billing"), "At Risk", "customer_id", 500)


@report("high_value_at_risk", "R5 J9", "customer_id:i lifetime_value:f recency_days:i", f"""
    SELECT * FROM (SELECT customer_id, monetary AS lifetime_value, recency_days FROM ({RFM_BASE}) b) c
    WHERE lifetime_value > (SELECT avg(monetary) FROM ({RFM_BASE}) d) AND recency_days > 180
    ORDER BY lifetime_value DESC, customer_id LIMIT 200""")
def _(t):
    return rfm.high_value_at_risk(base(t).withColumnRenamed("monetary", "lifetime_value"), "customer_id")


COHORT = """SELECT a.customer_id, a.activity_month, a.revenue, a.n, c.cohort_month,
    (year(a.activity_month) - year(c.cohort_month)) * 12 + month(a.activity_month) - month(c.cohort_month) AS idx
    FROM (SELECT customer_id, date_trunc('month', order_date)::DATE AS activity_month, sum(amount) AS revenue,
      count(*) AS n FROM ord GROUP BY ALL) a
    JOIN (SELECT customer_id, date_trunc('month', min(order_date))::DATE AS cohort_month FROM ord GROUP BY 1) c
    ON a.customer_id = c.customer_id"""


@report("cohort_rows", "C1 J1 W8", "order_id:i cohort_month:s activity_month:s cohort_index:i", """
    SELECT order_id, first_month AS cohort_month, date_trunc('month', order_date)::DATE AS activity_month,
      (year(order_date) - year(first_month)) * 12 + month(order_date) - month(first_month) + 1 AS cohort_index
    FROM (SELECT *, date_trunc('month', min(order_date) OVER (PARTITION BY customer_id))::DATE AS first_month FROM ord) x""")
def _(t):
    return cohort.cohort_index(t.ord, "customer_id", "order_date", base=1)


@report("cohort_counts", "C2 J2", "cohort_month:s cohort_index:i active:i",
        f"SELECT cohort_month, idx AS cohort_index, count(DISTINCT customer_id) AS active FROM ({COHORT}) x GROUP BY ALL")
def _(t):
    return cohort.cohort_counts(cohort.cohort_months(t.ord, "customer_id", "order_date"))


RETENTION = f"""SELECT d.cohort_month, d.idx AS cohort_index, d.active, s.cohort_size,
    1e2 * d.active / s.cohort_size AS retention_pct
    FROM (SELECT cohort_month, idx, count(DISTINCT customer_id) AS active FROM ({COHORT}) x GROUP BY ALL) d
    JOIN (SELECT cohort_month, count(DISTINCT customer_id) AS cohort_size FROM ({COHORT}) y WHERE idx = 0 GROUP BY 1) s
    ON d.cohort_month = s.cohort_month"""


@report("cohort_retention", "C3 J3", "cohort_month:s cohort_index:i active:i cohort_size:i retention_pct:f2", RETENTION)
def _(t):
    return cohort.cohort_retention(t.ord, "customer_id", "order_date", size="first")


@report("cohort_retention_signup", "C3 C1 J2",
        "cohort_month:s cohort_index:i active:i cohort_size:i retention_pct:f2", """
    WITH a AS (SELECT order_id, supplier_id, date_trunc('month', ship_date)::DATE AS m FROM line),
    c AS (SELECT supplier_id, date_trunc('month', min(order_date))::DATE AS cohort_month FROM sale GROUP BY 1),
    n AS (SELECT cohort_month, date_diff('month', cohort_month, m) AS i, count(DISTINCT a.supplier_id) AS active
      FROM a JOIN c ON a.supplier_id = c.supplier_id GROUP BY ALL),
    z AS (SELECT cohort_month, count(*) AS cohort_size FROM c GROUP BY 1)
    SELECT n.cohort_month, i AS cohort_index, active, cohort_size, 1e2 * active / cohort_size AS retention_pct
    FROM n JOIN z USING (cohort_month)""")
def _(t):
    return cohort.cohort_retention(
        t.sale, "supplier_id", "ship_date", cohort_date="order_date", size="all", mode="elapsed")


@report("retention_matrix", "C4 A19", "cohort_month:s m0:i m1:i m2:i m3:i m4:i m5:i", f"""
    SELECT cohort_month, {', '.join(f'nullif(count(DISTINCT CASE WHEN idx = {i} THEN customer_id END), 0) AS m{i}'
                                    for i in range(6))} FROM ({COHORT}) x GROUP BY cohort_month""")
def _(t):
    counts = cohort.cohort_counts(cohort.cohort_months(t.ord, "customer_id", "order_date"))
    return cohort.cohort_table(counts, "active", range(6))


@report("retention_pct_matrix", "C4 A19", "cohort_month:s r1:f2 r2:f2 r3:f2 r6:f2 r12:f2", f"""
    SELECT cohort_month, {', '.join(f'max(CASE WHEN cohort_index + 1 = {i} THEN retention_pct END) AS r{i}'
                                    for i in (1, 2, 3, 6, 12))} FROM ({RETENTION}) x GROUP BY 1""")
def _(t):
    kept = cohort.cohort_retention(t.ord, "customer_id", "order_date", size="first", base=1)
    return cohort.cohort_table(kept, "retention_pct", (1, 2, 3, 6, 12), "r")


@report("cohort_revenue", "C5", "cohort_month:s cohort_index:i revenue:f",
        f"SELECT cohort_month, idx AS cohort_index, sum(revenue) AS revenue FROM ({COHORT}) x GROUP BY ALL")
def _(t):
    return cohort.cohort_revenue(cohort.cohort_months(t.ord, "customer_id", "order_date", "amount"))


@report("cohort_arpu", "C5", "cohort_month:s cohort_index:i active:i arpu:f2", f"""
    SELECT cohort_month, idx AS cohort_index, count(*) AS active,
      CAST(sum(revenue) AS DOUBLE) / count(*) AS arpu FROM ({COHORT}) x GROUP BY ALL""")
def _(t):
    return cohort.cohort_arpu(cohort.cohort_months(t.ord, "customer_id", "order_date", "amount"))


@report("cohort_churn", "C5", "cohort_month:s cohort_index:i churn_pct:f2",
        f"SELECT cohort_month, cohort_index, 100 - round(CAST(retention_pct AS DECIMAL(20,10)), 2) AS churn_pct FROM ({RETENTION}) x")
def _(t):
    return cohort.cohort_churn(t.ord, "customer_id", "order_date")


@report("segment_cohort_matrix", "C10 A19 J4", "priority:s cohort_month:s " + " ".join(f"m{i}_transactions:i" for i in range(12)), f"""
    WITH a AS (SELECT priority, date_trunc('month', order_date)::DATE AS m, count(*) AS n FROM ord GROUP BY ALL),
    c AS (SELECT priority, min(m) AS cohort_month FROM a GROUP BY 1)
    SELECT a.priority, cohort_month, {', '.join(
        f"sum(CASE WHEN date_diff('month', cohort_month, m) = {i} THEN n ELSE 0 END) AS m{i}_transactions" for i in range(12))}
    FROM a JOIN c ON a.priority = c.priority GROUP BY ALL""")
def _(t):
    return cohort.cohort_matrix(t.ord, "priority", "order_date", 12)


@report("cohort_activity", "C11 J3", "cohort_month:s activity_month:s active:i revenue:f", f"""
    SELECT cohort_month, activity_month, count(DISTINCT customer_id) AS active, sum(revenue) AS revenue
    FROM ({COHORT}) x GROUP BY ALL""")
def _(t):
    return cohort.cohort_activity(t.ord, "customer_id", "order_date", "amount")


def without_some_keys(df):
    """Every seventh order without its customer."""
    return df.withColumn("customer_id", F.when(F.col("order_id") % 7 != 0, F.col("customer_id")))


def unkeyed(sql):
    """The same in SQL: orders come from a view in which every seventh has no customer."""
    view = "(SELECT * REPLACE (CASE WHEN order_id % 7 <> 0 THEN customer_id END AS customer_id) FROM ord)"
    return f"WITH unkeyed AS {view} " + re.sub(r"\bord\b", "unkeyed", sql)


@report("cohort_counts_null_keys", "C2", "cohort_month:s cohort_index:i active:i", unkeyed(
    f"SELECT cohort_month, idx AS cohort_index, count(DISTINCT customer_id) AS active FROM ({COHORT}) x GROUP BY ALL"))
def _(t):
    return cohort.cohort_counts(cohort.cohort_months(without_some_keys(t.ord), "customer_id", "order_date"))


@report("cohort_retention_null_keys", "C3", "cohort_month:s cohort_index:i active:i cohort_size:i retention_pct:f2", unkeyed(RETENTION))
def _(t):
    return cohort.cohort_retention(without_some_keys(t.ord), "customer_id", "order_date", size="first")


@report("cohort_revenue_null_keys", "C5", "cohort_month:s cohort_index:i revenue:f", unkeyed(
    f"SELECT cohort_month, idx AS cohort_index, sum(revenue) AS revenue FROM ({COHORT}) x GROUP BY ALL"))
def _(t):
    return cohort.cohort_revenue(cohort.cohort_months(without_some_keys(t.ord), "customer_id", "order_date", "amount"))


@report("cohort_activity_null_keys", "C11", "cohort_month:s activity_month:s active:i revenue:f", unkeyed(
    f"SELECT cohort_month, activity_month, count(DISTINCT customer_id) AS active, sum(revenue) AS revenue FROM ({COHORT}) x GROUP BY ALL"))
def _(t):
    return cohort.cohort_activity(without_some_keys(t.ord), "customer_id", "order_date", "amount")


QUARTERS = """q AS (SELECT customer_id, concat(year(order_date), '-', quarter(order_date)) AS quarter FROM ord WHERE customer_id IS NOT NULL),
    cur AS (SELECT DISTINCT customer_id FROM q WHERE quarter = '2001-3'), prev AS (SELECT DISTINCT customer_id FROM q WHERE quarter = '2001-2')"""


@report("member_moves_null_keys", "J5 J6 C9", "move:s customer_id:i", unkeyed(f"""SELECT * FROM (WITH {QUARTERS}
    SELECT 'new' AS move, customer_id FROM cur WHERE customer_id NOT IN (FROM prev)
    UNION ALL SELECT 'lost', customer_id FROM prev WHERE customer_id NOT IN (FROM cur)
    UNION ALL SELECT 'retained', customer_id FROM prev WHERE customer_id IN (FROM cur)) x"""))
def _(t):
    orders = without_some_keys(t.ord).withColumn("quarter", F.concat_ws("-", F.year("order_date"), F.quarter("order_date")))
    moves = {"new": churn.new_members, "lost": churn.lost_members, "retained": churn.retained_members}
    found = [f(orders, "customer_id", "quarter").withColumn("move", F.lit(name)) for name, f in moves.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@report("nth_purchase_date", "W5 C12", "customer_id:i order_date:s", """
    SELECT customer_id, order_date FROM (SELECT customer_id, order_date,
      row_number() OVER (PARTITION BY customer_id ORDER BY order_date) AS rn
      FROM (SELECT DISTINCT customer_id, order_date FROM ord) d) r WHERE rn = 3""")
def _(t):
    return cohort.nth_event(t.ord, "customer_id", "order_date", 3)


@report("third_purchase_cohort", "C12 W5 J3", "cohort_month:s activity_month:s active:i revenue:f", """
    WITH f AS (SELECT customer_id, date_trunc('month', order_date)::DATE AS cohort_month FROM (
      SELECT customer_id, order_date, row_number() OVER (PARTITION BY customer_id ORDER BY order_date) AS rn
      FROM (SELECT DISTINCT customer_id, order_date FROM ord) d) r WHERE rn = 3)
    SELECT cohort_month, date_trunc('month', order_date)::DATE AS activity_month,
      count(DISTINCT ord.customer_id) AS active, sum(amount) AS revenue
    FROM ord JOIN f ON ord.customer_id = f.customer_id GROUP BY ALL""")
def _(t):
    return cohort.nth_purchase_cohort(t.ord, "customer_id", "order_date", "amount")


@report("inactive_summary", "C6 A8", "tracked:i inactive:i inactive_pct:f2", """
    SELECT count(*) AS tracked, count(*) FILTER (WHERE gone) AS inactive,
      1e2 * count(*) FILTER (WHERE gone) / count(*) AS inactive_pct
    FROM (SELECT customer_id, date_diff('day', max(order_date), (SELECT max(order_date) FROM ord)) > 90 AS gone
      FROM ord GROUP BY 1) x""")
def _(t):
    return churn.inactive_summary(t.ord, "customer_id", "order_date")


@report("inactive_customer_list", "C6 A18", "part:i members:i inactive_list:s", """
    SELECT part, count(*) AS members, string_agg(name, ', ' ORDER BY name) AS inactive_list
    FROM (SELECT name, (row_number() OVER (ORDER BY name) - 1) // 100 + 1 AS part FROM (
      SELECT CAST(customer_id AS VARCHAR) AS name FROM ord GROUP BY customer_id
      HAVING date_diff('day', max(order_date), (SELECT max(order_date) FROM ord)) > 90) x) y GROUP BY 1""")
def _(t):
    return churn.inactive_list(t.ord, "customer_id", "order_date", members=100)


@report("inactive_suppliers", "C6 A18", "part:i members:i inactive_list:s", """
    SELECT part, count(*) AS members, string_agg(name, ', ' ORDER BY name) AS inactive_list
    FROM (SELECT name, (row_number() OVER (ORDER BY name) - 1) // 1000 + 1 AS part FROM (
      SELECT CAST(supplier_id AS VARCHAR) AS name FROM line GROUP BY supplier_id
      HAVING date_diff('day', max(ship_date), DATE '2001-12-01') > 20) x) y GROUP BY 1""")
def _(t):
    return churn.inactive_list(t.line, "supplier_id", "ship_date", 20, "2001-12-01")


@report("inactive_members", "C6", "customer_id:i last_date:s days_since:i", """
    SELECT * FROM (SELECT customer_id, max(order_date) AS last_date,
      date_diff('day', max(order_date), (SELECT max(order_date) FROM ord)) AS days_since FROM ord GROUP BY 1) x
    WHERE days_since > 90""")
def _(t):
    return churn.inactive_members(t.ord, "customer_id", "order_date")


@report("monthly_churn", "C7 W2", "activity_month:s active:i previous:i churn_pct:f2 retention_pct:f2", """
    SELECT activity_month, active, previous, 1e2 * (previous - active) / previous AS churn_pct,
      1e2 * active / previous AS retention_pct FROM (SELECT *, lag(active) OVER (ORDER BY activity_month) AS previous
      FROM (SELECT date_trunc('month', order_date)::DATE AS activity_month, count(DISTINCT customer_id) AS active
        FROM ord GROUP BY 1) a) b""")
def _(t):
    return churn.monthly_churn(t.ord, "customer_id", "order_date")


@report("at_risk", "C8 A11", "customer_id:i last_date:s days_since:i orders:i", """
    SELECT customer_id, max(order_date) AS last_date, date_diff('day', max(order_date), DATE '2001-09-01') AS days_since,
      count(DISTINCT order_id) AS orders FROM ord GROUP BY 1
    HAVING date_diff('day', max(order_date), DATE '2001-09-01') > 60""")
def _(t):
    return churn.at_risk(t.ord, "customer_id", "order_date", "2001-09-01", 60, "order_id")


TWO_MONTHS = """cur AS (SELECT DISTINCT customer_id FROM bill WHERE billing_month = (SELECT max(billing_month) FROM bill)),
    prev AS (SELECT DISTINCT customer_id FROM bill WHERE billing_month = (SELECT max(billing_month) FROM bill
      WHERE billing_month < (SELECT max(billing_month) FROM bill)))"""


@report("retention_churn_report", "C9 J5 J6 K5 A26",
        "report_month:s total_customers:i new_customers:i retained_customers:i churned_customers:i churn_rate:f2 retention_rate:f2",
        f"""WITH {TWO_MONTHS},
    n AS (SELECT (SELECT count(*) FROM cur) AS total_customers, (SELECT count(*) FROM prev) AS before,
      (SELECT count(*) FROM cur WHERE customer_id NOT IN (SELECT customer_id FROM prev)) AS new_customers,
      (SELECT count(*) FROM cur WHERE customer_id IN (SELECT customer_id FROM prev)) AS retained_customers,
      (SELECT count(*) FROM prev WHERE customer_id NOT IN (SELECT customer_id FROM cur)) AS churned_customers)
    SELECT (SELECT max(billing_month) FROM bill) AS report_month, *, 1e2 * churned_customers / before AS churn_rate,
      1e2 * retained_customers / before AS retention_rate FROM n""")
def _(t):
    return churn.retention_churn_report(t.bill, "customer_id", "billing_month")


@report("new_members", "J5", "customer_id:i",
        f"WITH {TWO_MONTHS} SELECT customer_id FROM cur WHERE customer_id NOT IN (SELECT customer_id FROM prev)")
def _(t):
    return churn.new_members(t.bill, "customer_id", "billing_month")


@report("lost_members", "J5", "customer_id:i",
        f"WITH {TWO_MONTHS} SELECT customer_id FROM prev WHERE customer_id NOT IN (SELECT customer_id FROM cur)")
def _(t):
    return churn.lost_members(t.bill, "customer_id", "billing_month")


@report("retained_members", "J6", "customer_id:i", """
    WITH q AS (SELECT customer_id, concat(year(order_date), '-', quarter(order_date)) AS quarter FROM ord),
    cur AS (SELECT customer_id FROM q WHERE quarter = '2001-3'), prev AS (SELECT customer_id FROM q WHERE quarter = '2001-2')
    SELECT DISTINCT customer_id FROM prev WHERE customer_id IN (SELECT customer_id FROM cur)""")
def _(t):
    quarter = F.concat_ws("-", F.year("order_date"), F.quarter("order_date"))
    return churn.retained_members(t.ord.withColumn("quarter", quarter), "customer_id", "quarter")


@report("latest_periods", "K5", "billing_month:s",
        "SELECT DISTINCT billing_month FROM bill ORDER BY billing_month DESC LIMIT 2")
def _(t):
    return churn.latest_periods(t.bill, "billing_month")


LAST = """SELECT customer_id, date_diff('day', max(order_date), DATE '2001-08-01') AS days_since FROM ord GROUP BY 1"""


def labelled(t):
    return churn.churn_label(t.ord, "customer_id", "order_date", "2001-08-01", 90)


@report("churn_label", "C13 J4", "order_id:i days_since:i churn:i", f"""
    SELECT order_id, days_since, CASE WHEN days_since > 90 THEN 1 ELSE 0 END AS churn
    FROM ord JOIN ({LAST}) l ON ord.customer_id = l.customer_id""")
def _(t):
    return labelled(t)


@report("churn_rate_customers", "C13", "churn_rate_pct:f2",
        f"SELECT 1e2 * count(*) FILTER (WHERE days_since > 90) / count(*) AS churn_rate_pct FROM ({LAST}) l")
def _(t):
    return churn.churn_rate(features(t))


@report("churn_rate_orders", "C13", "churn_rate_pct:f2", f"""
    SELECT 1e2 * count(*) FILTER (WHERE days_since > 90) / count(*) AS churn_rate_pct
    FROM ord JOIN ({LAST}) l ON ord.customer_id = l.customer_id""")
def _(t):
    return churn.churn_rate(labelled(t))


FEATURES = f"""SELECT ord.customer_id, count(*) AS frequency, sum(amount) AS total_spend,
    CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order_value, max(days_since) AS recency_days,
    max(CASE WHEN days_since > 90 THEN 1 ELSE 0 END) AS churn
    FROM ord JOIN ({LAST}) l ON ord.customer_id = l.customer_id GROUP BY 1"""


def features(t):
    return churn.customer_features(t.ord, "customer_id", "order_date", "order_id", "amount", "2001-08-01", 90)


@report("customer_features", "C14 A22",
        "customer_id:i frequency:i total_spend:f avg_order_value:f recency_days:i churn:i", FEATURES)
def _(t):
    return features(t)


@report("high_risk_customers", "C14", "customer_id:i frequency:i recency_days:i",
        f"SELECT * FROM ({FEATURES}) x WHERE recency_days > 90 AND frequency < 3")
def _(t):
    return churn.high_risk(features(t))


@report("risk_segments", "N1 A21", "risk_segment:s n:i", f"""
    SELECT CASE WHEN recency_days > 0 AND recency_days <= 30 THEN 'Active' WHEN recency_days > 30 AND recency_days <= 90
      THEN 'At Risk' WHEN recency_days > 90 AND recency_days <= 180 THEN 'High Risk'
      WHEN recency_days > 180 AND recency_days <= 500 THEN 'Churned' END AS risk_segment, count(*) AS n
    FROM ({FEATURES}) x GROUP BY 1 HAVING risk_segment IS NOT NULL""")
def _(t):
    cut = segment.cut_column(features(t), "recency_days", [0, 30, 90, 180, 500],
                             ["Active", "At Risk", "High Risk", "Churned"], "risk_segment")
    return summary.value_counts(cut, "risk_segment")


@report("churn_feature_correlation", "A24", "x:s y:s correlation:f6", " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS correlation FROM ({FEATURES}) f"
    for a in ("frequency", "total_spend", "recency_days", "churn") for b in ("frequency", "total_spend", "recency_days", "churn")))
def _(t):
    return summary.corr_matrix(features(t), ["frequency", "total_spend", "recency_days", "churn"])


@report("spend_by_churn_box", "C15", "churn:i q1:f4 median:f4 q3:f4 n:i whisker_low:f4 whisker_high:f4 outliers:i", f"""
    WITH f AS (SELECT churn, CAST(total_spend AS DOUBLE) AS v FROM ({FEATURES}) x),
    q AS (SELECT churn, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM f GROUP BY 1)
    SELECT q.churn, q1, median, q3, count(*) AS n,
      min(CASE WHEN v BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) THEN v END) AS whisker_low,
      max(CASE WHEN v BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1) THEN v END) AS whisker_high,
      count(*) FILTER (WHERE NOT v BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS outliers
    FROM f JOIN q ON f.churn = q.churn GROUP BY ALL""")
def _(t):
    return churn.box_stats(features(t), "churn", "total_spend")


@report("event_box_by_user", "C15", "user_id:i q1:f4 median:f4 q3:f4 n:i outliers:i", """
    WITH q AS (SELECT user_id, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
      quantile_cont(value, 0.75) AS q3 FROM ev GROUP BY 1)
    SELECT q.user_id, q1, median, q3, count(*) AS n,
      count(*) FILTER (WHERE NOT value BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS outliers
    FROM ev JOIN q ON ev.user_id = q.user_id GROUP BY ALL""")
def _(t):
    return churn.box_stats(t.ev, "user_id", "value")


@report("repeat_purchase_rate", "C16 A8", "repeat_purchase_rate_pct:f6", """
    SELECT 1e2 * count(*) FILTER (WHERE n > 1) / count(*) AS repeat_purchase_rate_pct
    FROM (SELECT customer_id, count(DISTINCT order_id) AS n FROM ord GROUP BY 1) x""")
def _(t):
    return churn.repeat_purchase_rate(t.ord, "customer_id", "order_id")


@report("repeat_summary", "N8", "buyer:s customers:i revenue:f", """
    SELECT CASE WHEN n > 1 THEN 'Repeat' ELSE 'One-time' END AS buyer, count(*) AS customers, sum(a) AS revenue
    FROM (SELECT customer_id, count(*) AS n, sum(amount) AS a FROM ord GROUP BY 1) x GROUP BY 1""")
def _(t):
    return segment.repeat_summary(t.ord, "customer_id", "amount")


@report("customer_ltv", "A15",
        "customer_id:i lifetime_value:f total_orders:i avg_order_value:f first_purchase:s last_purchase:s active_months:i", """
    SELECT customer_id, sum(amount) AS lifetime_value, count(*) AS total_orders,
      CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order_value, min(order_date) AS first_purchase,
      max(order_date) AS last_purchase,
      (year(max(order_date)) - year(min(order_date))) * 12 + month(max(order_date)) - month(min(order_date))
        - CASE WHEN day(max(order_date)) < day(min(order_date)) THEN 1 ELSE 0 END + 1 AS active_months
    FROM ord GROUP BY 1""")
def _(t):
    return summary.customer_ltv(t.ord, "customer_id", "order_date", "amount")


PAIR_SQL = """SELECT a.product_id AS product_a, b.product_id AS product_b, count(*) AS pair_count
    FROM line a JOIN line b ON a.order_id = b.order_id AND a.product_id < b.product_id GROUP BY ALL"""


@report("bought_together", "B1 J7", "product_a:i product_b:i pair_count:i", PAIR_SQL)
def _(t):
    return basket.pair_counts(t.line, "order_id", "product_id")


@report("bought_together_top", "B1 J7", "product_a:i product_b:i pair_count:i",
        f"{PAIR_SQL} ORDER BY pair_count DESC, product_a, product_b LIMIT 999")
def _(t):
    return basket.pair_counts(t.line, "order_id", "product_id", n=999)


@report("suppliers_by_product_baskets", "B1", "product_a:i product_b:i pair_count:i", """
    WITH d AS (SELECT DISTINCT product_id AS txn, supplier_id AS item FROM line)
    SELECT a.item AS product_a, b.item AS product_b, count(*) AS pair_count
    FROM d a JOIN d b ON a.txn = b.txn AND a.item < b.item GROUP BY ALL HAVING count(*) >= 5""")
def _(t):
    return basket.pair_counts(t.line, "product_id", "supplier_id", min_count=5, by_rows=False, block=8)


@report("customer_recency_buckets", "N4 A21", "recency_bucket:s n:i", """
    WITH b AS (SELECT cust_id, date_diff('day', max(order_date), (SELECT max(order_date) FROM ord)) AS days
      FROM cust LEFT JOIN ord ON cust_id = customer_id GROUP BY 1)
    SELECT CASE WHEN days IS NULL THEN 'No purchases' WHEN days <= 30 THEN '0-30' WHEN days <= 90 THEN '31-90'
      WHEN days <= 180 THEN '91-180' WHEN days <= 365 THEN '181-365' ELSE '365+' END AS recency_bucket, count(*) AS n
    FROM b GROUP BY 1""")
def _(t):
    days = base(t).select("customer_id", "recency_days")
    every = t.cust.join(days, F.col("cust_id") == F.col("customer_id"), "left")
    return summary.value_counts(every.withColumn("recency_bucket", recency_bucket("recency_days")), "recency_bucket")
