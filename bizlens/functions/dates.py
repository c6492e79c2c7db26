"""Date expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Text formats tried in turn, day before month (fixed values).
DAY_FIRST_FORMATS = ("dd/MM/yyyy", "dd-MM-yyyy", "dd-MMM-yyyy", "dd-MMM-yy", "yyyy-MM-dd", "yyyy/MM/dd")
MONTH_FIRST_FORMATS = ("MM/dd/yyyy", "MM-dd-yyyy", "MMM-dd-yyyy", "yyyy-MM-dd", "yyyy/MM/dd")


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(value) -> Column:
    """A date literal from a ``date`` or ``yyyy-MM-dd`` text; columns pass through."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def parse_date(text: Column | str, formats: Sequence[str] | None = None, day_first: bool = True) -> Column:
    """Text to date by the first format that fits, null when none does."""
    formats = formats or (DAY_FIRST_FORMATS if day_first else MONTH_FIRST_FORMATS)
    trimmed = F.trim(column(text))
    return F.coalesce(*[F.try_to_date(trimmed, f) for f in formats])


def month_start(d: Column | str) -> Column:
    return F.trunc(column(d), "MM")


def month_label(d: Column | str) -> Column:
    return F.date_format(column(d), "yyyy-MM")


def weekday_name(d: Column | str) -> Column:
    return F.date_format(column(d), "EEEE")


def months_apart(start: Column | str, end: Column | str) -> Column:
    """Difference of the calendar months, days ignored."""
    s, e = column(start), column(end)
    return (F.year(e) - F.year(s)) * 12 + F.month(e) - F.month(s)


def whole_months(start: Column | str, end: Column | str) -> Column:
    """Full months elapsed from ``start`` to ``end``."""
    return F.timestamp_diff("MONTH", column(start).cast("timestamp_ntz"), column(end).cast("timestamp_ntz")).cast("int")


def fiscal_year(d: Column | str, first_month: int = 4) -> Column:
    """Calendar year in which the fiscal year of ``d`` starts."""
    return F.year(F.add_months(column(d), 1 - first_month))


def fiscal_year_label(d: Column | str, first_month: int = 4) -> Column:
    """``1980-1981`` for the fiscal year April 1980 to March 1981."""
    start = fiscal_year(d, first_month)
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string"))


def tenure(start: Column | str, end: Column | str, as_of) -> Column:
    """``Y years M months D days`` up to ``as_of`` where ``end`` is null, else null."""
    s, today = column(start), as_date(as_of)
    months = months_apart(s, today)
    months = months - F.when(F.add_months(s, months) > today, 1).otherwise(0)
    days = F.date_diff(today, F.add_months(s, months))
    text = F.format_string("%d years %d months %d days", F.floor(months / 12).cast("int"), (months % 12).cast("int"), days)
    return F.when(column(end).isNull() & s.isNotNull(), text)
