"""Daily bars kept up to date from a stream of ticks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.functions import date_bound
from barlake.functions.expressions import DateLike
from barlake.operators.bronze import with_ingestion
from barlake.operators.silver import KEYS, latest_version, silver_layer
from barlake.sources.layers import replace_keys
from barlake.sources.scratch import child_names, delete_path, path_exists, scratch_path
from barlake.streaming.ingest import AVAILABLE_NOW


def bars_from_stream(
    ticks: DataFrame,
    order: Sequence[str],
    price: str = "price",
    size: str = "size",
    time: str = "ts",
    delay: str = "1 day",
) -> DataFrame:
    """Ticks -> daily bars as a tumbling one-day window per symbol.

    A day stays open for ``delay`` after it ended by event time; then its state
    is dropped and later ticks for it are ignored.  The window starts at midnight
    UTC: keep the session's time zone at UTC for the dates to agree.
    """
    first_to_last = F.struct(*order, F.col(price).alias("_price"))
    return (
        ticks.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day"), "symbol")
        .agg(
            F.min(first_to_last)["_price"].alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max(first_to_last)["_price"].alias("close"),
            F.sum(size).cast("bigint").alias("volume"),
        )
        .withColumn("date", F.to_date("window.start"))
        .withColumn("adjusted_close", F.col("close"))
        .select("date", "symbol", "open", "high", "low", "close", "adjusted_close", "volume")
    )


def start_bar_log(
    bars: DataFrame,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Write the bars each micro-batch changed under that batch's own folder.

    Update mode emits every changed bar at once, with no hold-back behind the
    watermark.  A replayed batch overwrites its own folder, so nothing is
    counted twice, and no stored row is read or rewritten.  The log keeps every
    state of every bar until ``close_days`` moves old days to the clean layer.
    """

    def log(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        bars.writeStream.outputMode("update")
        .foreachBatch(log)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def read_bar_log(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every bar in the log."""
    return latest_version(spark.read.parquet(path), KEYS, ("batch_id",)).drop("batch_id")


def close_days(
    spark: SparkSession,
    log: str,
    silver: str,
    until: DateLike,
    batch_ts: dt.datetime | None = None,
    staging: str | None = None,
    partition: str = "date",
) -> None:
    """Move the bars dated before ``until`` from the log to the clean layer and compact the log.

    The batches of the log but the last one, which the stream may still replay, are replaced
    by the newest state of their open days.  A closed day whose ticks come late appears in
    the log again, whole, and the next call replaces it.  Give ``staging``, a new path for
    each call, to be able to resume an interrupted one.
    """
    staging = staging or scratch_path(spark, "close")
    taken, closed, still_open = (f"{staging}/{name}" for name in ("taken", "closed", "open"))
    if not path_exists(spark, f"{taken}/_SUCCESS"):  # a resumed call takes the same batches
        found = [(int(n.split("=")[1]),) for n in child_names(spark, log) if n.startswith("batch_id=")]
        spark.createDataFrame(found, "batch_id bigint").write.mode("overwrite").parquet(taken)
    numbers = sorted(r.batch_id for r in spark.read.parquet(taken).collect())  # one per micro-batch
    if not numbers:
        return
    *settled, last = numbers
    day = F.lit(date_bound(until))
    if not path_exists(spark, f"{still_open}/_SUCCESS"):
        states = spark.read.parquet(log).where(F.col("batch_id") <= last)
        newest = latest_version(states, KEYS, ("batch_id",))
        bars = newest.where(F.col("date") < day).drop("batch_id")
        silver_layer(with_ingestion(bars, batch_ts)).write.mode("overwrite").parquet(closed)
        newest.where(F.col("date") >= day).write.mode("overwrite").parquet(still_open)
    rows = spark.read.parquet(closed)
    replace_keys(spark, silver, rows.select(*KEYS), rows, f"{staging}/clean", partition)
    if settled:
        rest = spark.read.parquet(still_open).where(F.col("batch_id") < last).drop("batch_id")
        rest.write.mode("overwrite").parquet(f"{log}/batch_id={settled[-1]}")
    for number in settled[:-1]:
        delete_path(spark, f"{log}/batch_id={number}")
    delete_path(spark, staging)
