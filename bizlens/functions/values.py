"""Value expressions: money, cleaning, labels, bins and rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from bizlens.functions.dates import column


def money(c: Column | str) -> Column:
    """``decimal(18,2)``: sums stay exact."""
    return column(c).cast("decimal(18,2)")


def clean_number(text: Column | str, keep_sign: bool = False) -> Column:
    """Double from text with currency signs, separators or words; null when no number is left.

    The default loses a minus sign, as the payroll cleaning does; ``keep_sign`` keeps a leading one.
    """
    text = column(text)
    number = F.regexp_replace(text, "[^0-9.]", "").try_cast("double")
    return F.when(text.rlike(r"^[^0-9.]*-[^0-9.]*[0-9.]"), -number).otherwise(number) if keep_sign else number


def map_labels(text: Column | str, mapping: dict[str, str]) -> Column:
    """Trim, then replace labels found in ``mapping``; others stay."""
    label = F.trim(column(text))
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), label) if mapping else label


def cut(
    c: Column | str,
    edges: Sequence[float | None],
    labels: Sequence[str],
    right: bool = True,
    include_lowest: bool = False,
    missing: str | None = None,
) -> Column:
    """Label by fixed edges, closed on the right (or left); a ``None`` edge is open-ended.

    Values outside the edges and nulls give ``missing``.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per interval is needed")
    value = column(c)
    chain = None
    for i, label in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        inside = value.isNotNull()
        if low is not None:
            closed = not right or (include_lowest and i == 0)
            inside &= value >= F.lit(low) if closed else value > F.lit(low)
        if high is not None:
            inside &= value <= F.lit(high) if right else value < F.lit(high)
        chain = F.when(inside, F.lit(label)) if chain is None else chain.when(inside, F.lit(label))
    return chain.otherwise(F.lit(missing).cast("string"))


def recency_bucket(days: Column | str) -> Column:
    """Recency classes of the customer report; null is a customer without purchases."""
    return cut(days, [None, 30, 90, 180, 365, None], ["0-30", "31-90", "91-180", "181-365", "365+"],
               missing="No purchases")


def value_bucket(c: Column | str, edges: Sequence[float], labels: Sequence[str], missing: str = "Unknown") -> Column:
    """Half-open value classes ``[a, b)`` without gaps; nulls get ``missing``."""
    return cut(c, [None, *edges, None], labels, right=False, missing=missing)


def bin_floor(c: Column | str, size: float, origin: float = 0.0) -> Column:
    """Lower edge of the fixed-width bin that holds the value."""
    value = column(c).cast("double")
    return F.floor((value - F.lit(origin)) / F.lit(float(size))) * F.lit(float(size)) + F.lit(float(origin))


def apply_rules(rules: Sequence[tuple[Column | str, str]], default: str) -> Column:
    """Label of the first rule that holds."""
    label = F.lit(default)
    for condition, name in reversed(list(rules)):
        condition = F.expr(condition) if isinstance(condition, str) else condition
        label = F.when(condition, F.lit(name)).otherwise(label)
    return label


def direction(change: Column | str) -> Column:
    """Growth, Decline or (zero or unknown) No Change."""
    change = column(change)
    return F.when(change > 0, "Growth").when(change < 0, "Decline").otherwise("No Change")


def up_down(value: Column | str) -> Column:
    return F.when(column(value) >= 0, "Increase").otherwise("Decrease")
