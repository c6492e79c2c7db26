"""Column expressions used by the operators."""

from bizlens.functions.dates import (
    as_date, fiscal_year, fiscal_year_label, month_label, month_start, months_apart, parse_date, tenure,
    whole_months, weekday_name,
)
from bizlens.functions.measures import (
    distinct, mean, n_rows, n_where, pct, per, rate, total,
)
from bizlens.functions.values import (
    apply_rules, bin_floor, clean_number, cut, direction, map_labels, money, recency_bucket, up_down, value_bucket,
)

__all__ = [name for name in dir() if not name.startswith("_")]
