"""Retention: which rows stay, and the removal of expired partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.functions import date_bound
from barlake.functions.expressions import DateLike
from barlake.sources.layers import drop_before

# Days kept per layer.
SILVER_DAYS = 90
GOLD_DAYS = 30


def cutoff_date(as_of: DateLike, keep_days: int) -> dt.date:
    """First date that stays."""
    return date_bound(as_of) - dt.timedelta(days=keep_days)


def retain(df: DataFrame, as_of: DateLike, keep_days: int) -> DataFrame:
    """Rows dated on or after the cutoff."""
    return df.where(F.col("date") >= F.lit(cutoff_date(as_of, keep_days)))


def retain_silver(df: DataFrame, as_of: DateLike, keep_days: int = SILVER_DAYS) -> DataFrame:
    return retain(df, as_of, keep_days)


def retain_gold(df: DataFrame, as_of: DateLike, keep_days: int = GOLD_DAYS) -> DataFrame:
    return retain(df, as_of, keep_days)


def cut_layer(
    spark: SparkSession,
    path: str,
    as_of: DateLike,
    keep_days: int,
    partition: str = "date",
    look_back: int = 0,
) -> None:
    """Delete expired rows of a stored layer.

    ``look_back`` is the longest history that later runs read from this layer;
    a cut that would starve them is refused.
    """
    if keep_days < look_back:
        raise ValueError(f"keeping {keep_days} days starves a look-back of {look_back} days")
    drop_before(spark, path, cutoff_date(as_of, keep_days), partition)
