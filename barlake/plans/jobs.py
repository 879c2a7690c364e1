"""Layer jobs: each reads a stored layer, writes the next and returns what it wrote."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.functions import date_bound, moment
from barlake.functions.expressions import DateLike
from barlake.operators.bronze import append_bronze, purge_superseded, with_ingestion
from barlake.operators.gold import dates_read, gold_islands, gold_layer, gold_since, idle_islands, influence
from barlake.operators.quality import profile_sketches
from barlake.operators.retention import cut_layer, cutoff_date
from barlake.operators.silver import KEYS, NEWEST, changed_keys, new_rows, silver_layer
from barlake.sources.files import readable, rejected
from barlake.sources.layers import (
    date_ranges,
    drop_absent,
    drop_month,
    holds_rows,
    read_layer,
    read_ranges,
    replace_keys,
    replace_ranges,
    write_layer,
    write_profile,
)
from barlake.sources.scratch import delete_path, path_exists, scratch_path
from barlake.sources.widening import read_widened


def layer_path(paths: Mapping[str, str], layer: str) -> str:
    """Where a layer is stored; the scheme of the path picks the store."""
    if layer not in paths:
        raise KeyError(f"no path for layer {layer!r}; known: {sorted(paths)}")
    return paths[layer]


def run_bronze(
    bars: DataFrame,
    paths: Mapping[str, str],
    batch_ts: dt.datetime | None = None,
    partition: str = "date",
) -> dict[str, object]:
    """Append landed bars to the raw layer.

    With ``batch_ts`` a run can be retried: bars already loaded under that time are skipped,
    and so are rejected records, which have no key and are told by all their columns.
    """
    path, spark = layer_path(paths, "bronze"), bars.sparkSession
    if batch_ts is not None and path_exists(spark, path):
        loaded = read_layer(spark, path).where(F.col("_ingestion_timestamp") == moment(batch_ts))
        bars = new_rows(loaded, readable(bars)).unionByName(_not_among(rejected(bars), rejected(loaded)))
    return append_bronze(bars, path, batch_ts, partition)


def run_silver(
    spark: SparkSession,
    paths: Mapping[str, str],
    newest: Sequence[str] = NEWEST,
    partition: str = "date",
    widen: bool = False,
) -> dict[str, object]:
    """Rebuild the clean layer from the whole raw layer.

    ``widen`` reads a raw layer whose loads disagree on columns or their types.
    """
    path = layer_path(paths, "bronze")
    rows = read_widened(spark, path) if widen else read_layer(spark, path)
    return write_layer(silver_layer(rows, newest=newest), layer_path(paths, "silver"), "overwrite", partition, checks=True)


def run_gold(
    spark: SparkSession,
    paths: Mapping[str, str],
    frame: str = "calendar",
    average_as: str | None = None,
    since: DateLike | None = None,
    partition: str = "date",
) -> dict[str, object]:
    """Rebuild the analytics layer, all of it or the rows from a date on.

    A full run replaces the table; with ``since`` the partitions from that date on are
    replaced, and those that have no rows any more are removed.  A second run changes
    nothing and appends nothing.
    """
    silver = read_layer(spark, layer_path(paths, "silver"))
    if since is None:
        rows = gold_layer(silver, frame, average_as)
    else:
        if partition == "month":  # the first month is replaced as a whole
            since = date_bound(since).replace(day=1)
        rows = gold_since(silver, since, frame, average_as)
    path = layer_path(paths, "gold")
    if since is None:
        return write_layer(rows, path, "overwrite", partition)
    stored = path_exists(spark, path)
    written = write_layer(rows, path, "replace", partition)
    if stored:
        drop_absent(spark, path, silver.select("date"), since, partition)
    return written


def run_full(
    spark: SparkSession,
    bars: DataFrame,
    paths: Mapping[str, str],
    as_of: DateLike | None = None,
    batch_ts: dt.datetime | None = None,
    silver_days: int | None = None,
    gold_days: int | None = None,
    average_as: str | None = None,
    newest: Sequence[str] = NEWEST,
    partition: str = "date",
) -> dict[str, dict[str, object]]:
    """Raw, clean and analytics layer in sequence, then retention.

    The analytics layer is computed before the clean one is cut, and the clean
    one is rebuilt from the raw layer on each run, so no average is starved.
    Retention applies to a layer whose days are given (usual: 90 and 30); the
    analytics rows it would remove are not computed in the first place.
    """
    today = as_of if as_of is not None else dt.date.today()
    since = cutoff_date(today, gold_days) if gold_days is not None else None
    written = {
        "bronze": run_bronze(bars, paths, batch_ts, partition),
        "silver": run_silver(spark, paths, newest, partition),
        "gold": run_gold(spark, paths, average_as=average_as, since=since, partition=partition),
    }
    for layer, days in (("silver", silver_days), ("gold", gold_days)):
        if days is not None:
            cut_layer(spark, layer_path(paths, layer), today, days, partition)
    return written


def run_metrics(spark: SparkSession, written: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """What a run wrote, one row per layer, as counted by the writes themselves."""
    rows = [(layer, m["rows"], m["first_date"], m["last_date"]) for layer, m in written.items()]
    return spark.createDataFrame(
        rows, "layer string, rows bigint, first_date date, last_date date"
    )


def refresh_profile(
    spark: SparkSession,
    layer: str,
    sketches: str,
    touched: DataFrame | None = None,
    columns: Sequence[str] | None = None,
) -> None:
    """Bring the stored profile of a layer up to date: one row of sketches per date, in a file per month.

    With ``touched`` (date) only the months of those dates are read and replaced; a month that
    no longer holds rows is removed.  ``profile_range`` answers from the result.
    """
    if touched is None or not path_exists(spark, sketches):
        rows = read_layer(spark, layer)
        ranges = None
    else:
        # One value per month at most.
        months = [r[0] for r in touched.where("date IS NOT NULL").select(F.trunc("date", "month").alias("m")).distinct().collect()]
        ranges = [(m, (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)) for m in months]
        rows = read_ranges(spark, layer, ranges)
    profiled = profile_sketches(rows, columns)
    if ranges is None:
        write_profile(profiled, sketches, "overwrite")
        return
    held = profiled.select(F.trunc("date", "month").alias("m")).distinct()
    kept = {r[0] for r in held.collect()}
    write_profile(profiled, sketches, "replace")
    for first, _ in ranges:
        if first not in kept:
            drop_month(spark, sketches, first)


def refresh_gold(
    spark: SparkSession,
    paths: Mapping[str, str],
    touched: DataFrame,
    staging: str,
    average_as: str | None = None,
    partition: str = "date",
) -> None:
    """Recompute the analytics rows that changed or removed bars influence, in place.

    ``touched`` holds (symbol, date) and should be a stored table.  What is recomputed, and
    read for it, are the islands of ``influence``: touched dates far apart cost what each of them
    reaches, not what lies between.  The stored rows of a partition that are not recomputed stay;
    a touched key without a clean row has none here.
    """
    clean, analytics = layer_path(paths, "silver"), layer_path(paths, "gold")
    if not holds_rows(spark, clean):
        replace_keys(spark, analytics, touched, touched.limit(0), f"{staging}/gold", partition)
        return
    silver = read_layer(spark, clean)
    islands = influence(silver, touched).persist()  # small, and read several times
    recent = read_ranges(spark, clean, dates_read(islands))
    idle = idle_islands(recent, islands)
    past = recent.limit(0) if idle.isEmpty() else silver
    rows = gold_islands(recent, past, islands, idle, average_as)
    replace_ranges(spark, analytics, islands, rows, f"{staging}/gold", partition)
    islands.unpersist()


def run_incremental(
    spark: SparkSession,
    bars: DataFrame,
    paths: Mapping[str, str],
    batch_ts: dt.datetime | None = None,
    staging: str | None = None,
    average_as: str | None = None,
    newest: Sequence[str] = NEWEST,
    partition: str = "date",
) -> None:
    """Bring the layers up to date with what is new or corrected in ``bars``.

    The bars of a (symbol, date) are loaded if the raw layer does not hold it, or holds
    other values in its newest version; a bar whose newest version is invalid leaves the
    clean and the analytics layer.  Only the partitions of such dates are rewritten in the
    clean layer and, in the analytics layer, those that the longest frame carries a change
    to.  The clean layer must still hold that frame (``cut_layer(..., look_back=200)``).
    Give ``staging``, a new path for each run, to be able to resume an interrupted one;
    its folder is removed once the run is complete.
    """
    staging = staging or scratch_path(spark, "incremental")
    bronze, arrived = layer_path(paths, "bronze"), f"{staging}/arrived"
    if not path_exists(spark, f"{arrived}/_SUCCESS"):
        batch = with_ingestion(bars, batch_ts).persist()
        _changed_rows(spark, bronze, batch, bars.columns, newest).write.mode("overwrite").parquet(arrived)
        batch.unpersist()
    batch = spark.read.parquet(arrived)
    if batch.isEmpty():
        delete_path(spark, staging)
        return
    append_once(spark, bronze, batch, partition)
    dated = readable(batch).select(*KEYS).distinct()
    versions = _of_keys(read_ranges(spark, bronze, date_ranges(dated)), dated)
    clean = silver_layer(versions, newest=newest)
    replace_keys(spark, layer_path(paths, "silver"), dated, clean, f"{staging}/silver", partition)
    refresh_gold(spark, paths, dated, staging, average_as, partition)
    delete_path(spark, staging)


def _changed_rows(
    spark: SparkSession, bronze: str, batch: DataFrame, bar: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """The rows of a batch whose keys the raw layer lacks, or holds with other values."""
    if not path_exists(spark, bronze):
        return batch
    held = read_ranges(spark, bronze, date_ranges(batch), undated=True)
    values = [c for c in bar if c not in KEYS]
    return _of_keys(batch, changed_keys(held, batch, values, newest=newest))


def _of_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    wanted = keys.select(*[F.col(k).alias(f"_key_{k}") for k in KEYS])
    return rows.join(wanted, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in KEYS], "left_semi")


def _not_among(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows that have no equal in ``known``, in all the columns both have; NULL equals NULL."""
    shared = [c for c in rows.columns if c in known.columns]
    known = known.select(*[F.col(c).alias(f"_known_{c}") for c in shared])
    return rows.join(known, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in shared], "left_anti")


def append_once(spark: SparkSession, bronze: str, rows: DataFrame, partition: str) -> None:
    """Append rows to the raw layer, but for those it holds under the same load time (a resumed run)."""
    if path_exists(spark, bronze):
        stamp = rows.select(F.max("_ingestion_timestamp")).scalar()
        held = read_ranges(spark, bronze, date_ranges(rows), undated=True)
        rows = _not_among(rows, held.where(F.col("_ingestion_timestamp") == stamp))
    write_layer(rows, bronze, "append", partition)


def purge_bronze(
    spark: SparkSession,
    paths: Mapping[str, str],
    as_of: dt.datetime,
    retention_hours: int = 24,
    newest: Sequence[str] = NEWEST,
    partition: str = "date",
    staging: str | None = None,
) -> None:
    """Remove superseded versions older than the retention from the stored raw layer.

    Only the partitions that hold an old key with several versions are rewritten, through
    ``staging``, which makes an interrupted run resumable.
    """
    staging = staging or scratch_path(spark, "purge")
    path, kept = layer_path(paths, "bronze"), f"{staging}/kept"
    if not path_exists(spark, f"{kept}/_SUCCESS"):
        raw = read_layer(spark, path)
        day = F.col("date") if partition == "date" else F.trunc("date", "month")
        cutoff = moment(as_of) - F.make_dt_interval(hours=F.lit(retention_hours))
        copies = raw.groupBy(*KEYS).agg(F.count("*").alias("n"), F.min("_ingestion_timestamp").alias("oldest"))
        days = copies.where((F.col("n") > 1) & (F.col("oldest") < cutoff)).select(day.alias("_day")).distinct()
        affected = raw.join(days, day.eqNullSafe(F.col("_day")), "left_semi")
        rows = purge_superseded(affected, as_of, retention_hours, newest=newest)
        if write_layer(rows, kept, "overwrite", partition)["rows"] == 0:
            return
    write_layer(read_layer(spark, kept), path, "replace", partition)
    delete_path(spark, staging)
