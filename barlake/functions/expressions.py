"""Column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

DateLike = dt.date | str


def pct_change(new: Column, old: Column) -> Column:
    """``(new - old) / old * 100``; NULL when ``old`` is NULL or zero."""
    return F.try_divide(new - old, old) * 100


def missing(df: DataFrame, name: str) -> Column:
    """True when the value is NULL, or NaN for a floating-point column."""
    gap = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        gap = gap | F.isnan(name)
    return gap


def any_missing(df: DataFrame, names: Iterable[str]) -> Column:
    """True when at least one of the columns is missing."""
    return reduce(or_, [missing(df, name) for name in names])


def date_bound(value: DateLike) -> dt.date:
    """Parse a bound on the driver, so a malformed one fails before any job runs."""
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def moment(value: dt.datetime | Column) -> Column:
    """A timestamp; a naive datetime is read in the session's time zone."""
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp")


def day_between(
    start: DateLike | None = None, end: DateLike | None = None, column: str = "date"
) -> Column:
    """Inclusive date range with typed literals; an open side is left out."""
    tests = [F.lit(True)]
    if start is not None:
        tests.append(F.col(column) >= F.lit(date_bound(start)))
    if end is not None:
        tests.append(F.col(column) <= F.lit(date_bound(end)))
    return reduce(and_, tests)


def over_history(call: str, days: int, frame: str = "calendar") -> Column:
    """Evaluate an aggregate call over one symbol's last ``days``, today included.

    ``calendar`` counts calendar days, ``rows`` counts the symbol's own bars.
    Both order by the plain ``date`` column, so all frames of a chain, and
    ``lag`` beside them, share one shuffle and one sort.
    """
    if frame == "calendar":
        bounds = f"RANGE BETWEEN INTERVAL {int(days) - 1} DAYS PRECEDING AND CURRENT ROW"
    elif frame == "rows":
        bounds = f"ROWS BETWEEN {int(days) - 1} PRECEDING AND CURRENT ROW"
    else:
        raise ValueError(f"frame must be 'calendar' or 'rows', not {frame!r}")
    return F.expr(f"{call} OVER (PARTITION BY symbol ORDER BY date {bounds})")


def over_prefix(call: str, days: int, frame: str = "calendar") -> Column:
    """A sum or count over one symbol's last ``days``, as the difference of two running ones.

    The frame of either starts with the history and only grows, so Spark adds each row once
    to each, whatever the length; a sliding frame is filled anew for every row.  Only for exact
    values: differences of doubles would keep the rounding of the whole history.
    """
    if frame not in ("calendar", "rows"):
        raise ValueError(f"frame must be 'calendar' or 'rows', not {frame!r}")
    kind, before = ("RANGE", f"INTERVAL {int(days)} DAYS") if frame == "calendar" else ("ROWS", str(int(days)))
    running = f"{call} OVER (PARTITION BY symbol ORDER BY date {kind} BETWEEN UNBOUNDED PRECEDING AND "
    return F.expr(f"coalesce({running} CURRENT ROW), 0) - coalesce({running} {before} PRECEDING), 0)")
