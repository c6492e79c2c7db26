"""Recency, frequency and monetary value per key; scores, segments and reports on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions import apply_rules, as_date, money
from bizlens.operators.scale import global_ntile, sort_key

#: Ordered segment rules (fixed values): the first rule that holds names the segment.
RULES_STANDARD = (
    ("r_score >= 4 AND f_score >= 4 AND m_score >= 4", "Champions"),
    ("r_score >= 4 AND f_score >= 3", "Loyal Customers"),
    ("r_score >= 3 AND f_score >= 3", "Potential Loyalist"),
    ("r_score >= 3 AND m_score <= 2", "Recent Customers"),
    ("r_score <= 2 AND f_score >= 4", "At Risk"),
    ("r_score = 1 AND m_score <= 2", "Lost"),
)
RULES_DETAILED = (
    ("r_score >= 4 AND f_score >= 4 AND m_score >= 4", "Champions"),
    ("r_score >= 4 AND f_score >= 3", "Loyal Customers"),
    ("r_score >= 3 AND f_score >= 3 AND m_score >= 3", "Potential Loyalists"),
    ("r_score = 5 AND f_score <= 2", "Recent Customers"),
    ("r_score = 3 AND f_score <= 2", "Promising"),
    ("r_score <= 2 AND f_score >= 4", "At Risk"),
    ("r_score = 1 AND f_score = 1", "Lost"),
)
#: The rule for 'Churned' never fires: the two rules before it take every r_score up to 2.
RULES_BILLING = (
    ("r_score >= 4 AND f_score >= 4 AND m_score >= 4", "Top Customers (Gold)"),
    ("r_score >= 3 AND f_score >= 3 AND m_score >= 3", "Loyal (Silver)"),
    ("r_score <= 2 AND f_score >= 3", "Need Attention"),
    ("r_score <= 2 AND f_score <= 2", "At Risk"),
    ("r_score = 1", "Churned"),
)
RULE_SETS = {
    "standard": (RULES_STANDARD, "Others"),
    "detailed": (RULES_DETAILED, "Needs Attention"),
    "billing": (RULES_BILLING, "Regular"),
}


def rfm_base(
    df: DataFrame, key: str, date: str, amount: str, as_of="max", order_id: str | None = None
) -> DataFrame:
    """Last date, recency in days, frequency and monetary value per key.

    ``as_of`` is a date or ``"max"`` for the latest date of the frame.  Frequency counts rows, or
    distinct ``order_id`` when given.  Money is summed as ``decimal(18,2)``.
    """
    today = df.agg(F.max(date)).scalar() if isinstance(as_of, str) and as_of == "max" else as_date(as_of)
    frequency = F.count_distinct(order_id) if order_id else F.count("*")
    return (
        df.groupBy(key)
        .agg(F.max(date).alias("last_date"), frequency.alias("frequency"), F.sum(money(amount)).alias("monetary"))
        .withColumn("recency_days", F.date_diff(today, "last_date"))
    )


def rfm_score(
    base: DataFrame, key: str, n: int = 5, best_is_high: bool = True, recency: bool = True, total: bool = False
) -> DataFrame:
    """Scores 1..n from ``ntile`` over the whole frame, ties broken by ``key``.

    With ``best_is_high`` n is best (recent, frequent, valuable); otherwise 1 is.  ``recency=False`` leaves
    the recency score out, ``total`` adds the sum of the scores.
    """
    up = best_is_high
    tiles = {"r_score": sort_key(("recency_days", not up), (key, True))} if recency else {}
    tiles["f_score"] = sort_key(("frequency", up), (key, True))
    tiles["m_score"] = sort_key(("monetary", up), (key, True))
    scored = global_ntile(base, tiles, n)
    return scored.withColumn("rfm_score", sum((F.col(c) for c in tiles), F.lit(0))) if total else scored


def rfm_segment(
    scored: DataFrame, rules: str | Sequence[tuple[Column | str, str]] = "detailed", default: str | None = None
) -> DataFrame:
    """Adds the three-digit code and the segment of a named or given rule list."""
    if isinstance(rules, str):
        rules, fallback = RULE_SETS[rules]
        default = default or fallback
    return scored.withColumns({
        "rfm_code": F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]),
        "segment": apply_rules(rules, default or "Other"),
    })


def rfm_report(
    df: DataFrame, key: str, date: str, amount: str, as_of="max", n: int = 5, best_is_high: bool = True,
    rules: str | Sequence[tuple[Column | str, str]] = "detailed",
) -> DataFrame:
    """Base, scores, code and segment in one call."""
    return rfm_segment(rfm_score(rfm_base(df, key, date, amount, as_of), key, n, best_is_high), rules)


def segment_counts(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("segment").agg(F.count("*").alias("customers")).orderBy(F.desc("customers"), "segment")


def segment_members(segmented: DataFrame, segment: str, key: str, n: int = 500) -> DataFrame:
    """The ``n`` most valuable members of a segment."""
    return segmented.where(F.col("segment") == segment).orderBy(F.desc("monetary"), key).limit(n)


def high_value_at_risk(
    customers: DataFrame, key: str, value: str = "lifetime_value", recency: str = "recency_days",
    days: int = 180, n: int | None = 200,
) -> DataFrame:
    """Customers worth more than the average who have not bought for more than ``days`` days."""
    average = customers.agg(F.avg(value)).scalar()
    found = customers.where((F.col(value) > average) & (F.col(recency) > days))
    return found if n is None else found.orderBy(F.desc(value), key).limit(n)
