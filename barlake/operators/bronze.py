"""Raw layer: append-only versions of bars with load metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions import moment
from barlake.operators.silver import KEYS, NEWEST, latest_version
from barlake.sources.layers import read_layer, write_layer


def with_ingestion(df: DataFrame, batch_ts: dt.datetime | Column | None = None) -> DataFrame:
    """Stamp rows with load time and load date; pass ``batch_ts`` to replay a run."""
    stamp = F.current_timestamp() if batch_ts is None else moment(batch_ts)
    return df.withColumn("_ingestion_timestamp", stamp.cast("timestamp")).withColumn(
        "_ingestion_date", F.to_date("_ingestion_timestamp")
    )


def append_bronze(
    df: DataFrame,
    path: str,
    batch_ts: dt.datetime | None = None,
    partition: str = "date",
) -> dict[str, object]:
    """Append a batch; columns the table does not have yet are simply stored."""
    return write_layer(with_ingestion(df, batch_ts), path, "append", partition, checks=True)


def read_bronze(
    spark: SparkSession, path: str, equal: Mapping[str, object] | None = None, **kwargs
) -> DataFrame:
    """Scan the raw layer with equality filters; a filter value of None matches nothing."""
    return read_layer(spark, path, equal=equal, **kwargs)


def latest_date(df: DataFrame) -> DataFrame:
    """The newest date as one row; NULL when the table is empty."""
    return df.agg(F.max("date").alias("latest_date"))


def distinct_symbols(df: DataFrame) -> DataFrame:
    """Every symbol once."""
    return df.select("symbol").distinct()


def bronze_as_of(
    df: DataFrame,
    as_of: dt.datetime | Column,
    keys: Sequence[str] = KEYS,
    newest: Sequence[str] = NEWEST,
) -> DataFrame:
    """The table as it stood at ``as_of``: versions loaded by then, newest per key."""
    loaded = F.col("_ingestion_timestamp") <= moment(as_of)
    return latest_version(df.where(loaded), keys, newest)


def purge_superseded(
    df: DataFrame,
    as_of: dt.datetime | Column,
    retention_hours: int = 24,
    keys: Sequence[str] = KEYS,
    newest: Sequence[str] = NEWEST,
) -> DataFrame:
    """Drop versions that are both superseded and older than the retention.

    Young versions, and rows without a load time, pass untouched, without a shuffle.  An old version stays only
    where it is the newest of its key; that search sends one row per key and
    input partition, even when one key holds most versions.
    """
    cutoff = moment(as_of) - F.make_dt_interval(hours=F.lit(retention_hours))
    stamp = F.col("_ingestion_timestamp")
    old_newest = latest_version(df, keys, newest).where(stamp < cutoff)
    return df.where((stamp >= cutoff) | stamp.isNull()).unionByName(old_newest)
