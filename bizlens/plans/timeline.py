"""Reports by period, growth, moving averages, price ranges, trends."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bizlens.functions import (
    direction, fiscal_year_label, mean, month_label, up_down, whole_months,
)
from bizlens.operators import clean, periods, prices, summary
from bizlens.plans.registry import report


@report("revenue_by_month", "A4 D8 P8", "period:s revenue:f orders:i customers:i avg_order:f2", """
    SELECT date_trunc('month', order_date)::DATE AS period, sum(amount) AS revenue, count(DISTINCT order_id) AS orders,
      count(DISTINCT customer_id) AS customers, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order
    FROM ord WHERE order_date IS NOT NULL GROUP BY 1""")
def _(t):
    return periods.period_summary(t.ord, "order_date", "month", {
        "revenue": F.sum("amount"), "orders": F.count_distinct("order_id"),
        "customers": F.count_distinct("customer_id"), "avg_order": mean("amount", 2)})


@report("revenue_by_day", "A4", "period:s revenue:f tx_count:i",
        "SELECT order_date AS period, sum(amount) AS revenue, count(*) AS tx_count FROM ord GROUP BY 1")
def _(t):
    return periods.period_summary(t.ord, "order_date", "day", {"revenue": F.sum("amount"), "tx_count": F.count("*")})


@report("revenue_by_month_of_year", "A4 P10", "period:i revenue:f",
        "SELECT month(order_date) AS period, sum(amount) AS revenue FROM ord WHERE order_date IS NOT NULL GROUP BY 1")
def _(t):
    return periods.period_summary(t.ord, "order_date", "month_of_year", {"revenue": F.sum("amount")})


@report("category_monthly", "A4 S6", "period:s status:s revenue:f qty_sold:f", """
    SELECT date_trunc('month', ship_date)::DATE AS period, status, sum(total) AS revenue, sum(qty) AS qty_sold
    FROM line GROUP BY ALL""")
def _(t):
    return periods.period_summary(t.line, "ship_date", "month", {
        "revenue": F.sum("total"), "qty_sold": F.sum("qty")}, ["status"])


@report("weekday_summary", "A5", "weekday_no:i weekday:s tx_count:i revenue:f avg_order:f6", """
    SELECT isodow(order_date) - 1 AS weekday_no, dayname(order_date) AS weekday, count(*) AS tx_count, sum(amount) AS revenue,
      CAST(sum(amount) AS DOUBLE) / count(*) AS avg_order FROM ord GROUP BY ALL""")
def _(t):
    return periods.weekday_summary(t.ord, "order_date", "amount")


@report("moving_average_7", "W4", "order_date:s daily_revenue:f moving_avg:f2", """
    SELECT order_date, daily_revenue, CAST(sum(daily_revenue) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg
    FROM (SELECT order_date, sum(amount) AS daily_revenue FROM ord GROUP BY 1) d
    WINDOW w AS (ORDER BY order_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def _(t):
    return periods.moving_average(t.ord, "order_date", "amount")


GROWTH = """SELECT period, revenue, previous, 1e2 * CAST(revenue - previous AS DOUBLE) / nullif(CAST(previous AS DOUBLE), 0) AS growth_pct
    FROM (SELECT *, lag(revenue) OVER (ORDER BY period) AS previous FROM (
      SELECT date_trunc('month', order_date)::DATE AS period, sum(amount) AS revenue FROM ord GROUP BY 1) g) w"""


@report("monthly_growth", "G1 W2 N7", "period:s revenue:f previous:f growth_pct:f2 growth:s", f"""
    SELECT *, CASE WHEN growth_pct > 0 THEN 'Growth' WHEN growth_pct < 0 THEN 'Decline' ELSE 'No Change' END AS growth
    FROM (SELECT period, revenue, previous, round(CAST(growth_pct AS DECIMAL(30,10)), 2) AS growth_pct FROM ({GROWTH}) x) y""")
def _(t):
    return periods.period_growth(t.ord, "order_date", "amount")


@report("month_of_year_growth", "G1 N7", "period:i revenue:f growth:s", """
    SELECT period, revenue, CASE WHEN revenue > previous THEN 'Growth' WHEN revenue < previous THEN 'Decline'
      ELSE 'No Change' END AS growth FROM (SELECT *, lag(revenue) OVER (ORDER BY period) AS previous FROM (
      SELECT month(order_date) AS period, sum(amount) AS revenue FROM ord GROUP BY 1) g) w""")
def _(t):
    return periods.period_growth(t.ord, "order_date", "amount", "month_of_year")


@report("cumulative_revenue", "W3", "period:s revenue:f cumulative:f", """
    SELECT period, revenue, sum(revenue) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING) AS cumulative FROM (
      SELECT date_trunc('month', order_date)::DATE AS period, sum(amount) AS revenue FROM ord GROUP BY 1) g""")
def _(t):
    return summary.cumulative(periods.period_summary(t.ord, "order_date", "month", {"revenue": F.sum("amount")}), "period", "revenue")


@report("year_month_matrix", "G4 A19", "year:i " + " ".join(f"m{m}:f" for m in range(1, 13)), f"""
    SELECT year(order_date) AS year, {', '.join(f'sum(CASE WHEN month(order_date) = {m} THEN amount END) AS m{m}' for m in range(1, 13))}
    FROM ord GROUP BY 1""")
def _(t):
    return periods.year_month_matrix(t.ord, "order_date", "amount")


@report("year_month_long", "G4", "year:i month:i revenue:f",
        "SELECT year(order_date) AS year, month(order_date) AS month, sum(amount) AS revenue FROM ord GROUP BY ALL")
def _(t):
    return periods.year_month_matrix(t.ord, "order_date", "amount", wide=False)


@report("product_months", "K4 K3", "period:s product_id:i status:s revenue:f", """
    SELECT date_trunc('month', ship_date)::DATE AS period, product_id, status, sum(total) AS revenue FROM line GROUP BY ALL""")
def _(t):
    return periods.product_months(t.line, "ship_date", ["product_id", "status"], "total")


@report("product_months_listing", "K4 K3", "period:s product_id:i status:s revenue:f", """
    SELECT date_trunc('month', ship_date)::DATE AS period, product_id, status, sum(total) AS revenue FROM line GROUP BY ALL
    ORDER BY period, revenue DESC, product_id, status LIMIT 1000""")
def _(t):
    return periods.product_months(t.line, "ship_date", ["product_id", "status"], "total", 1000)


@report("revenue_trend", "A25", "slope:f4 intercept:f4 r2:f6", """
    SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2 FROM (
      SELECT CAST(row_number() OVER (ORDER BY m) - 1 AS DOUBLE) AS x, y FROM (
        SELECT date_trunc('month', order_date) AS m, CAST(sum(amount) AS DOUBLE) AS y FROM ord GROUP BY 1) a) b""")
def _(t):
    monthly = periods.period_summary(t.ord, "order_date", "month", {"revenue": F.sum("amount")})
    numbered = monthly.withColumn("n", F.row_number().over(Window.orderBy("period")) - 1)
    return summary.linear_trend(numbered, "n", "revenue")


RANGES = ", ".join(f"{f}({c}) AS {f}_{c}" for c in prices.PRICE_COLUMNS for f in ("min", "max"))
RANGE_COLUMNS = " ".join(f"{f}_{c}:f" for c in prices.PRICE_COLUMNS for f in ("min", "max"))
FISCAL = "concat(year(day - INTERVAL 3 MONTH), '-', year(day - INTERVAL 3 MONTH) + 1)"


@report("price_ranges_by_fiscal_year", "A12 K3", f"ticker:s fiscal_year:s {RANGE_COLUMNS}",
        f"SELECT ticker, {FISCAL} AS fiscal_year, {RANGES} FROM bar GROUP BY 1, 2")
def _(t):
    return prices.ohlcv_ranges(prices.with_fiscal_period(t.bar, "day"), ["ticker", "fiscal_year"])


@report("price_ranges_by_month", "A12 P22", f"month:s {RANGE_COLUMNS}",
        f"SELECT date_trunc('month', day)::DATE AS month, {RANGES} FROM bar GROUP BY 1")
def _(t):
    return prices.ohlcv_ranges(prices.with_fiscal_period(t.bar, "day"), ["month"])


@report("price_ranges_rolled_up", "A12", f"fiscal_year:s {RANGE_COLUMNS}",
        f"SELECT {FISCAL} AS fiscal_year, {RANGES} FROM bar GROUP BY 1")
def _(t):
    monthly = prices.ohlcv_ranges(prices.with_fiscal_period(t.bar, "day"), ["month"])
    return prices.roll_up_ranges(monthly, [fiscal_year_label("month").alias("fiscal_year")])


@report("open_close_ranges_one_year", "A12 P2b", "fiscal_year:s min_open:f max_open:f min_close:f max_close:f", f"""
    SELECT {FISCAL} AS fiscal_year, min(open) AS min_open, max(open) AS max_open, min(close) AS min_close, max(close) AS max_close
    FROM bar WHERE {FISCAL} = '1997-1998' GROUP BY 1""")
def _(t):
    one = clean.in_fiscal_year(t.bar, "day", 1997)
    return prices.ohlcv_ranges(prices.with_fiscal_period(one, "day"), ["fiscal_year"], ["open", "close"])


@report("volume_by_fiscal_year", "A13", "fiscal_year:s total_volume:i days:i",
        f"SELECT {FISCAL} AS fiscal_year, sum(volume) AS total_volume, count(volume) AS days FROM bar GROUP BY 1")
def _(t):
    return prices.volume_by_year(t.bar, [fiscal_year_label("day").alias("fiscal_year")])


@report("prices_on_day", "P1 P2", "ticker:s open:f close:f high:f low:f volume:i",
        "SELECT ticker, open, close, high, low, volume FROM bar WHERE day = DATE '1998-03-18'")
def _(t):
    return clean.on_day(t.bar, "day", "1998-03-18", ["ticker", "open", "close", "high", "low", "volume"])


@report("rows_of_fiscal_year", "P2b", "order_id:i order_date:s",
        "SELECT order_id, order_date FROM ord WHERE year(order_date - INTERVAL 3 MONTH) = 1998")
def _(t):
    return clean.in_fiscal_year(t.ord, "order_date", 1998)


@report("stacked_tickers", "A12", "ticker:s days:i low:f high:f", """
    SELECT ticker, count(*) AS days, min(low) AS low, max(high) AS high FROM bar GROUP BY 1""")
def _(t):
    names = [r.ticker for r in summary.distinct_keys(t.bar, "ticker").collect()]
    parts = {name: t.bar.where(F.col("ticker") == name).drop("ticker") for name in names}
    return summary.summarize(prices.stack_tickers(parts), ["ticker"], {
        "days": F.count("*"), "low": F.min("low"), "high": F.max("high")})


@report("calendar_columns", "P22", "order_id:i month_start:s tx_month:s tx_weekday:s weekday_no:i fiscal_year:i", """
    SELECT order_id, date_trunc('month', order_date)::DATE AS month_start, strftime(order_date, '%Y-%m') AS tx_month,
      dayname(order_date) AS tx_weekday, isodow(order_date) - 1 AS weekday_no, year(order_date - INTERVAL 3 MONTH) AS fiscal_year
    FROM ord""")
def _(t):
    return clean.with_calendar(t.ord, "order_date")


@report("months_since_start", "P24", "order_id:i months:i direction:s label:s", """
    SELECT order_id, date_diff('month', DATE '1995-01-15', order_date)
      - CASE WHEN day(order_date) < 15 AND order_date >= DATE '1995-01-15' THEN 1 ELSE 0 END
      + CASE WHEN order_date < DATE '1995-01-15' AND day(order_date) > 15 THEN 1 ELSE 0 END AS months,
      CASE WHEN amount >= 200000 THEN 'Increase' ELSE 'Decrease' END AS direction,
      strftime(order_date, '%Y-%m') AS label FROM ord""")
def _(t):
    start = F.lit("1995-01-15").cast("date")
    return t.ord.withColumns({
        "months": whole_months(start, "order_date"), "direction": up_down(F.col("amount") - 200000),
        "label": month_label("order_date")})


@report("day_change_labels", "N7 W2", "day:s change:f growth:s", """
    SELECT day, change, CASE WHEN change > 0 THEN 'Growth' WHEN change < 0 THEN 'Decline' ELSE 'No Change' END AS growth
    FROM (SELECT day, total - lag(total) OVER (ORDER BY day) AS change FROM (SELECT day, sum(amount) AS total FROM ev GROUP BY 1) a) b""")
def _(t):
    grown = periods.period_growth(t.ev, "day", "amount", "day")
    return grown.select(F.col("period").alias("day"), (F.col("revenue") - F.col("previous")).alias("change")).withColumn(
        "growth", direction("change"))
