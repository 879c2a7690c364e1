"""Column expressions and small DataFrame building blocks shared by the operators."""

from barlake.functions.expressions import (
    any_missing,
    date_bound,
    day_between,
    missing,
    moment,
    over_history,
    over_prefix,
    pct_change,
)
from barlake.functions.median import grouped_median

__all__ = [
    "any_missing",
    "date_bound",
    "day_between",
    "grouped_median",
    "missing",
    "moment",
    "over_history",
    "over_prefix",
    "pct_change",
]
