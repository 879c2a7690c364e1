"""Layer tables: partitioned by date or month, written once, read with pruning.

Layout.  A table is partitioned by ``date`` or, for thin data, by the month of
``date`` (column ``_month``); never by symbol, which would leave one-row
directories.  Rows are sorted by symbol inside a file, so a symbol filter skips
row groups.  Before a write, rows are rebalanced on the partition column: Spark
merges small partitions and splits a date that holds a large share of the rows.

Plain Parquet has no transaction log: a dynamic overwrite replaces whole
partitions, but a concurrent reader may see some replaced and some not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from barlake.functions import day_between, date_bound
from barlake.functions.expressions import DateLike
from barlake.sources.scratch import child_names, delete_path, path_exists

MONTH = "_month"


def _partition_column(partition: str) -> str:
    if partition not in ("date", "month"):
        raise ValueError(f"partition must be 'date' or 'month', not {partition!r}")
    return "date" if partition == "date" else MONTH


def _month_of(date) -> F.Column:
    return F.trunc(date, "month")


def load_metrics(df: DataFrame) -> list[Column]:
    """What is counted of the rows of a load: all, those without a key, those that pass their checks, first and last date."""
    checked = "_quality_check_passed"
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("date").isNull() | F.col("symbol").isNull()).alias("rejected"),
        (F.count_if(checked) if checked in df.columns else F.max(F.lit(None).cast("bigint"))).alias("passed"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    ]


def write_layer(
    df: DataFrame,
    path: str,
    mode: str,
    partition: str = "date",
    fmt: str = "parquet",
    checks: bool = False,
) -> dict[str, object]:
    """Write a layer and return what was written, counted by the same job; with ``checks`` also rejects and passes.

    ``mode``: ``append`` adds files, ``overwrite`` replaces the table,
    ``replace`` replaces only the partitions present in ``df``.
    """
    column = _partition_column(partition)
    if column == MONTH:
        df = df.withColumn(MONTH, _month_of("date"))
    written = Observation()
    out = (
        df.hint("rebalance", F.col(column))
        .sortWithinPartitions(column, "symbol", *(["date"] if column == MONTH else []))
        .observe(  # behind the shuffle, so a map stage that runs again counts nothing twice
            written,
            *(load_metrics(df) if checks else [m for i, m in enumerate(load_metrics(df)) if i not in (1, 2)]),
        )
    )
    writer = out.write.format(fmt).partitionBy(column)
    if mode == "append":
        writer = writer.mode("append")
    elif mode == "overwrite":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    elif mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        raise ValueError(f"unknown write mode {mode!r}")
    writer.save(path)
    return written.get


def write_profile(sketches: DataFrame, path: str, mode: str) -> None:
    """Store rows of one date each, a file per month; ``replace`` replaces the months present."""
    rows = sketches.withColumn(MONTH, _month_of("date"))
    out = rows.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, "date").write.partitionBy(MONTH)
    how = {"overwrite": "static", "replace": "dynamic"}[mode]
    out.mode("overwrite").option("partitionOverwriteMode", how).parquet(path)


def drop_month(spark: SparkSession, path: str, first: dt.date) -> None:
    """Remove the partition of the month that begins on the given day, if there is one."""
    target = f"{path}/{MONTH}={first.isoformat()}"
    if path_exists(spark, target):
        delete_path(spark, target)


def read_layer(
    spark: SparkSession,
    path: str,
    start: DateLike | None = None,
    end: DateLike | None = None,
    equal: Mapping[str, object] | None = None,
    schema: StructType | None = None,
    merge_schema: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """Scan a layer with optional inclusive date bounds and equality filters.

    Date bounds become partition filters under either layout.  ``schema`` is
    enforced when given; ``merge_schema`` instead unions the schemas of all
    files, at the price of reading every footer.
    """
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if MONTH in df.columns:
        first = date_bound(start).replace(day=1) if start is not None else None
        last = date_bound(end).replace(day=1) if end is not None else None
        df = df.where(day_between(first, last, MONTH)).drop(MONTH)
    if start is not None or end is not None:
        df = df.where(day_between(start, end))
    for name, value in (equal or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    return df if schema is None else df.select(*schema.names)


def read_ranges(
    spark: SparkSession,
    path: str,
    ranges: Sequence[tuple[dt.date, dt.date]],
    undated: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """Rows dated in one of the inclusive ranges, and undated ones if wanted.

    The ranges are literals on the partition column, so no other partition is listed or read.
    """
    df = spark.read.format(fmt).load(path)
    day = F.col("date")
    wanted = [day.between(first, last) for first, last in ranges]
    if undated:
        wanted.append(day.isNull())
    df = df.where(_any(wanted))
    if MONTH in df.columns:
        month = F.col(MONTH)
        months = [month.between(first.replace(day=1), last) for first, last in ranges]
        df = df.where(_any(months + [month.isNull()] * undated)).drop(MONTH)
    return df


def _any(tests: Sequence[Column]) -> Column:
    """Whether one of the tests holds; halved again and again, as a long chain overflows the analyzer's stack."""
    if len(tests) < 2:
        return tests[0] if tests else F.lit(False)
    half = len(tests) // 2
    return _any(tests[:half]) | _any(tests[half:])


def date_ranges(rows: DataFrame) -> list[tuple[dt.date, dt.date]]:
    """The dates of the rows as runs of neighbouring days: at most one per second day of the calendar."""
    days = sorted(r[0] for r in rows.where("date IS NOT NULL").select("date").distinct().collect())
    runs: list[tuple[dt.date, dt.date]] = []
    for day in days:
        if runs and day - runs[-1][1] <= dt.timedelta(days=1):
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs


def replace_keys(
    spark: SparkSession,
    path: str,
    keys: DataFrame,
    rows: DataFrame,
    staging: str,
    partition: str = "date",
    fmt: str = "parquet",
) -> None:
    """Replace the rows of the given (symbol, date) keys by ``rows``; only their partitions are rewritten.

    ``rows`` holds at most these keys; a key without a row there is deleted, and so is a
    partition that keeps none.  ``keys`` is read more than once and should be a stored
    table.  The merged partitions are first written under ``staging``: replaying an
    interrupted call with the same ``staging`` reuses them, so a half-replaced table is
    repaired and the rows of a partition dropped midway are not lost.  One writer at a
    time: a replay puts back the rows it merged at first.
    """
    gone = keys.select(F.col("symbol").alias("_symbol"), F.col("date").alias("_date"))
    same = (F.col("symbol") == F.col("_symbol")) & (F.col("date") == F.col("_date"))
    _replace(spark, path, keys, lambda table: table.join(gone, same, "left_anti"), rows, staging, partition, fmt)


def replace_ranges(
    spark: SparkSession,
    path: str,
    ranges: DataFrame,
    rows: DataFrame,
    staging: str,
    partition: str = "date",
    fmt: str = "parquet",
) -> None:
    """Replace the rows of each symbol in its date ranges (symbol, first, last) by ``rows``.

    Works as ``replace_keys`` does, with ranges instead of single keys; ``rows`` is computed
    once, straight into the staged partitions.
    """
    gone = ranges.select(F.col("symbol").alias("_symbol"), F.col("first").alias("_first"), F.col("last").alias("_last"))
    inside = (F.col("symbol") == F.col("_symbol")) & F.col("date").between(F.col("_first"), F.col("_last"))
    days = ranges.select(F.explode(F.sequence("first", "last")).alias("date"))
    _replace(spark, path, days, lambda table: table.join(gone, inside, "left_anti"), rows, staging, partition, fmt)


def _replace(
    spark: SparkSession,
    path: str,
    dated: DataFrame,
    surviving: Callable[[DataFrame], DataFrame],
    rows: DataFrame,
    staging: str,
    partition: str,
    fmt: str,
) -> None:
    column, merged = _partition_column(partition), f"{staging}/merged"
    # One value per day or month at most, so listing them on the driver is bounded by the
    # calendar; as literals they prune the scan.
    day = F.col("date") if column == "date" else _month_of("date")
    days = [r[0] for r in dated.select(day.alias("d")).distinct().collect()]
    if not path_exists(spark, f"{merged}/_SUCCESS"):
        if holds_rows(spark, path):
            table = spark.read.format(fmt).load(path).where(F.col(column).isin(days)).drop(MONTH)
            rows = rows.unionByName(surviving(table), allowMissingColumns=True)
        write_layer(rows, merged, "overwrite", partition, fmt)
    kept = set()
    if holds_rows(spark, merged):
        rows = spark.read.format(fmt).load(merged)
        kept = {r[0] for r in rows.select(column).distinct().collect()}
        write_layer(rows.drop(MONTH), path, "replace", partition, fmt)
    stored = set(child_names(spark, path)) if path_exists(spark, path) else set()
    for value in set(days) - kept:
        if f"{column}={value.isoformat()}" in stored:
            delete_path(spark, f"{path}/{column}={value.isoformat()}")


def holds_rows(spark: SparkSession, path: str) -> bool:
    """Whether a layer holds any partition; Spark cannot read a table that holds none."""
    return path_exists(spark, path) and any("=" in name for name in child_names(spark, path))


def drop_before(
    spark: SparkSession, path: str, cutoff: DateLike, partition: str = "date", fmt: str = "parquet"
) -> None:
    """Delete the rows dated strictly before ``cutoff``.

    Partitions that lie wholly before it are listed from the store and removed without
    opening a file; under the month layout the one month the cutoff falls in is rewritten.
    """
    column = _partition_column(partition)
    cutoff = date_bound(cutoff)
    table = spark.read.format(fmt).load(path)
    floor = cutoff if column == "date" else cutoff.replace(day=1)
    for name in child_names(spark, path):  # one folder per day or month
        if name.startswith(f"{column}=") and name[len(column) + 1 :] < floor.isoformat():
            delete_path(spark, f"{path}/{name}")
    if column == MONTH and cutoff != floor:
        month = table.where(F.col(MONTH) == F.lit(floor)).drop(MONTH)
        kept = month.where(F.col("date") >= F.lit(cutoff))
        if kept.isEmpty():
            delete_path(spark, f"{path}/{column}={floor.isoformat()}")
        elif not month.where(F.col("date") < F.lit(cutoff)).isEmpty():
            write_layer(kept, path, "replace", partition, fmt)


def drop_absent(
    spark: SparkSession, path: str, dates: DataFrame, since: DateLike, partition: str = "date"
) -> None:
    """Delete the partitions from ``since`` on that hold none of ``dates`` (column date).

    What is collected is one value per day or month: bounded by the calendar.
    """
    column = _partition_column(partition)
    day = F.col("date") if column == "date" else _month_of("date")
    live = dates.where(F.col("date") >= F.lit(date_bound(since))).select(day.alias(column)).distinct()
    table = spark.read.parquet(path).where(F.col(column) >= F.lit(date_bound(since))).select(column).distinct()
    for row in table.join(live, column, "left_anti").collect():
        delete_path(spark, f"{path}/{column}={row[0].isoformat()}")
