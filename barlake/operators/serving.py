"""Ready-made questions to the analytics layer; each returns a lazy DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from barlake.functions import date_bound, day_between, pct_change
from barlake.functions.expressions import DateLike

# Columns of the gainers.
GAINER_COLUMNS = ("symbol", "daily_close", "daily_return_pct", "ma_50_day", "ma_200_day")


def _positive(name: str, value: int) -> int:
    if value < 1:
        raise ValueError(f"{name} must be at least 1, not {value}")
    return value


def _today(as_of: DateLike | None) -> dt.date:
    return date_bound(as_of) if as_of is not None else dt.date.today()


def stock_history(
    gold: DataFrame,
    symbol: str,
    start: DateLike | None = None,
    end: DateLike | None = None,
    limit: int = 100,
    as_of: DateLike | None = None,
) -> DataFrame:
    """Newest rows of one symbol; by default the year up to ``as_of`` (today)."""
    _positive("limit", limit)
    today = _today(as_of)
    start = start if start is not None else today - dt.timedelta(days=365)
    end = end if end is not None else today
    return (
        gold.where((F.col("symbol") == symbol) & day_between(start, end))
        .orderBy(F.desc("date"))
        .limit(limit)
    )


def stock_performance(
    gold: DataFrame, period_days: int = 30, top_n: int = 10, as_of: DateLike | None = None
) -> DataFrame:
    """Top symbols by return from the first to the last close of the period up to ``as_of``."""
    _positive("period_days", period_days)
    _positive("top_n", top_n)
    today = _today(as_of)
    since = today - dt.timedelta(days=period_days)
    mean_volume = F.try_divide(F.sum("daily_volume").cast("double"), F.count("daily_volume"))
    return (
        gold.where(day_between(since, today))
        .groupBy("symbol")
        .agg(
            pct_change(
                F.max_by("daily_close", "date"), F.min_by("daily_close", "date")
            ).alias("return_pct"),
            mean_volume.alias("avg_volume"),
            F.avg("volatility_30d").alias("avg_volatility"),
        )
        .orderBy(F.desc("return_pct"), "symbol")
        .limit(top_n)
    )


def top_gainers(gold: DataFrame, limit: int = 10) -> DataFrame:
    """Best returns of the table's last day.

    The last day is a scalar subquery of the same plan; on a table partitioned
    by date it prunes the scan to that day.
    """
    _positive("limit", limit)
    last_day = gold.select(F.max("date")).scalar()
    return (
        gold.where(F.col("date") == last_day)
        .orderBy(F.desc("daily_return_pct"), "symbol")
        .limit(limit)
        .select(*GAINER_COLUMNS)
    )


def top_gainers_per_day(gold: DataFrame, limit: int = 10) -> DataFrame:
    """Best returns of every day; each input partition sends at most ``limit`` rows per day."""
    _positive("limit", limit)
    by_return = Window.partitionBy("date").orderBy(F.desc("daily_return_pct"), "symbol")
    return (
        gold.withColumn("place", F.row_number().over(by_return))
        .where(F.col("place") <= limit)
        .select("date", "place", *GAINER_COLUMNS)
    )


def gold_report(gold: DataFrame, symbol: str, since: DateLike) -> DataFrame:
    """A symbol's closes and indicators since a date, newest first."""
    return (
        gold.where((F.col("symbol") == symbol) & day_between(since))
        .select(
            "symbol",
            "date",
            "daily_close",
            "daily_return_pct",
            "ma_50_day",
            "ma_200_day",
            "volatility_30d",
        )
        .orderBy(F.desc("date"))
    )


def avg_return_by_symbol(
    gold: DataFrame, since: DateLike | None = None, limit: int | None = None
) -> DataFrame:
    """Mean daily return per symbol, optionally since a date and for the first symbols only."""
    means = (
        gold.where(day_between(since))
        .groupBy("symbol")
        .agg(F.avg("daily_return_pct").alias("avg_return"))
    )
    return means if limit is None else means.orderBy("symbol").limit(limit)


def json_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Each row as one JSON object in the column ``record``; NULL fields are written as null."""
    row = F.struct(*(columns or df.columns))
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("record"))


def export(
    df: DataFrame, path: str, fmt: str = "json", options: Mapping[str, object] | None = None
) -> None:
    """Write a result as JSON lines, NULL fields included, or as CSV with a header."""
    if fmt not in ("json", "csv"):
        raise ValueError(f"fmt must be 'json' or 'csv', not {fmt!r}")
    writer = df.write.mode("overwrite").options(**{"ignoreNullFields": False} | dict(options or {}))
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
