"""Micro-batch upserts into the clean layer and the analytics refresh they cause."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.silver import (
    CRITICAL,
    KEYS,
    NEWEST,
    drop_missing,
    latest_version,
    newest_rows,
    null_rows,
)
from barlake.plans.jobs import layer_path, refresh_gold
from barlake.sources.files import union_sources
from barlake.sources.layers import date_ranges, holds_rows, read_layer, read_ranges, replace_keys, write_layer
from barlake.sources.scratch import delete_path, path_exists
from barlake.streaming.ingest import AVAILABLE_NOW


def withdrawn_path(path: str) -> str:
    """Where a streamed clean layer keeps the keys whose newest version is invalid."""
    return f"{path.rstrip('/')}-withdrawn"


def _merge_clean(
    batch: DataFrame, path: str, staging: str, newest: Sequence[str], partition: str
) -> DataFrame:
    """Merge a micro-batch into the clean layer; returns its (symbol, date) keys, stored.

    The newest version of a key is chosen among the batch, the clean row and the withdrawn
    one, and checked afterwards: an invalid newest version takes the clean row away, and an
    older valid one that arrives later does not bring it back.
    """
    spark, chosen, withdrawn = batch.sparkSession, f"{staging}/newest", withdrawn_path(path)
    if not path_exists(spark, f"{chosen}/_SUCCESS"):
        arrived = f"{staging}/batch"
        dated = batch.where("symbol IS NOT NULL AND date IS NOT NULL")
        newest_rows(dated, newest=newest).write.mode("overwrite").parquet(arrived)
        rows = spark.read.parquet(arrived)
        days = date_ranges(rows)
        keys = rows.select(*[F.col(k).alias(f"_key_{k}") for k in KEYS])
        same = [F.col(k) == F.col(f"_key_{k}") for k in KEYS]
        for table in (path, withdrawn):
            if holds_rows(spark, table):
                old = read_ranges(spark, table, days)
                rows = union_sources([rows, old.join(keys, same, "left_semi")])
        latest_version(rows, newest=newest).write.mode("overwrite").parquet(chosen)
    rows = spark.read.parquet(chosen)
    keys = rows.select(*KEYS)
    valid, invalid = drop_missing(rows), null_rows(rows, CRITICAL)
    replace_keys(spark, path, keys, valid, f"{staging}/clean", partition)
    if holds_rows(spark, withdrawn) or not invalid.isEmpty():
        replace_keys(spark, withdrawn, keys, invalid, f"{staging}/withdrawn", partition)
    return keys


def seed_withdrawn(
    raw: DataFrame,
    path: str,
    newest: Sequence[str] = NEWEST,
    partition: str = "date",
) -> None:
    """Record the keys that batch runs withdrew from the clean layer, once.

    They are the keys of the raw layer without a clean row whose newest version is invalid.  A
    clean layer that has such a record already is left alone, so a stream that starts again
    does not read the raw layer again.
    """
    spark, withdrawn = raw.sparkSession, withdrawn_path(path)
    if path_exists(spark, f"{withdrawn}/_SUCCESS"):
        return
    dated = raw.where("symbol IS NOT NULL AND date IS NOT NULL")
    if holds_rows(spark, path):
        clean = read_layer(spark, path).select(*[F.col(k).alias(f"_key_{k}") for k in KEYS])
        dated = dated.join(clean, [F.col(k) == F.col(f"_key_{k}") for k in KEYS], "left_anti")
    write_layer(null_rows(newest_rows(dated, newest=newest), CRITICAL), withdrawn, "overwrite", partition)


def _forget_previous(batch: DataFrame, staging: str, batch_id: int) -> None:
    """A batch starts only once the one before is committed: its staged rows can go."""
    if batch_id > 0:
        delete_path(batch.sparkSession, f"{staging}/{batch_id - 1}")


def start_silver_upsert(
    versions: DataFrame,
    path: str,
    checkpoint: str,
    staging: str,
    newest: Sequence[str] = NEWEST,
    partition: str = "date",
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    raw: DataFrame | None = None,
) -> StreamingQuery:
    """Merge each micro-batch of raw versions into the clean layer; the newest version wins.

    Only the partitions a batch touches are rewritten.  Staging is named by
    batch id, so a batch interrupted midway is resumed, not applied twice.  Over a clean layer
    that batch runs wrote, give the ``raw`` layer they read: keys withdrawn there stay so.
    """
    if raw is not None:
        seed_withdrawn(raw, path, newest, partition)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        _forget_previous(batch, staging, batch_id)
        _merge_clean(batch, path, f"{staging}/{batch_id}", newest, partition)

    return (
        versions.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_gold_refresh(
    versions: DataFrame,
    paths: Mapping[str, str],
    checkpoint: str,
    staging: str,
    newest: Sequence[str] = NEWEST,
    average_as: str | None = None,
    partition: str = "date",
    trigger: Mapping[str, object] = AVAILABLE_NOW,
    raw: DataFrame | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch, then recompute the analytics rows it influences.

    Frames and ``lag`` cannot run on a stream, so each batch recomputes, as a
    batch job, the date ranges of the touched symbols in which a change can be seen.
    ``raw`` is the raw layer, for a clean layer that batch runs wrote.
    """
    if raw is not None:
        seed_withdrawn(raw, layer_path(paths, "silver"), newest, partition)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        _forget_previous(batch, staging, batch_id)
        stage = f"{staging}/{batch_id}"
        silver = layer_path(paths, "silver")
        touched = _merge_clean(batch, silver, f"{stage}/silver", newest, partition)
        if not touched.isEmpty():
            refresh_gold(batch.sparkSession, paths, touched, stage, average_as, partition)

    return (
        versions.writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
