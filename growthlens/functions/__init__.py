from growthlens.functions.columns import (
    flag,
    double_or_zero,
    strict_date,
    or_zero,
    pct_change,
    position_bucket,
    ratio,
    week_start,
)
from growthlens.functions.exact import exact_totals

__all__ = [
    "exact_totals",
    "flag",
    "double_or_zero",
    "strict_date",
    "or_zero",
    "pct_change",
    "position_bucket",
    "ratio",
    "week_start",
]
