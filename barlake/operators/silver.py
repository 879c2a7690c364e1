"""Clean layer: newest version per key, declared types, no gaps in critical columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.functions import any_missing, missing
from barlake.sources.files import union_sources

# Key, version order, critical and numeric columns of a bar.
KEYS = ("symbol", "date")
NEWEST = ("_ingestion_timestamp",)
CRITICAL = ("date", "symbol", "close")
NUMERIC = {
    "open": "double",
    "high": "double",
    "low": "double",
    "close": "double",
    "adjusted_close": "double",
    "volume": "bigint",
}


def latest_version(
    df: DataFrame, keys: Sequence[str] = KEYS, newest: Sequence[str] = NEWEST
) -> DataFrame:
    """One row per key: the newest by ``newest``, all descending.

    Rows of one load share their load time: the bar's own columns, largest first, decide
    between them, so the choice never depends on the order of the rows.  Spark limits each
    key to one row per input partition before the shuffle (WindowGroupLimit), so a key
    with very many versions does not gather in one task.
    """
    ties = [c for c in NUMERIC if c in df.columns and c not in (*newest, *keys)]
    order = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*newest, *ties)])
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def cast_prices(df: DataFrame) -> DataFrame:
    """Cast price columns to double and volume to bigint; text that is no number becomes NULL."""
    return df.withColumns(
        {name: F.col(name).try_cast(kind) for name, kind in NUMERIC.items() if name in df.columns}
    )


def drop_missing(df: DataFrame, columns: Sequence[str] = CRITICAL) -> DataFrame:
    """Keep rows in which none of the columns is NULL or NaN."""
    return df.where(~any_missing(df, columns))


def null_rows(df: DataFrame, columns: Sequence[str] = ("symbol", "close")) -> DataFrame:
    """The rows with a NULL or NaN in at least one of the columns."""
    return df.where(any_missing(df, columns))


def _rules(df: DataFrame) -> dict[str, Column]:
    """Rule name -> True where the row breaks the rule; an unknown value breaks none."""
    low, high = F.col("low"), F.col("high")
    outside = lambda c: F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False))
    rules = {f"{name}_missing": missing(df, name) for name in CRITICAL}
    rules["open_out_of_range"] = outside("open")
    rules["close_out_of_range"] = outside("close")
    rules["volume_negative"] = F.coalesce(F.col("volume") < 0, F.lit(False))
    return rules


def quality_flags(df: DataFrame) -> DataFrame:
    """Add ``_failed_rules`` (names) and ``_quality_check_passed`` (no rule failed)."""
    failed = F.array_compact(
        F.array(*[F.when(broken, F.lit(name)) for name, broken in _rules(df).items()])
    )
    return df.withColumn("_failed_rules", failed).withColumn(
        "_quality_check_passed", F.size("_failed_rules") == 0
    )


def newest_rows(
    versions: DataFrame,
    keys: Sequence[str] = KEYS,
    newest: Sequence[str] = NEWEST,
    run_ts: Column | None = None,
) -> DataFrame:
    """The newest version of each key, typed, flagged and stamped, valid or not."""
    return (
        latest_version(versions, keys, newest)
        .transform(cast_prices)
        .transform(quality_flags)
        .drop("_failed_rules")
        .withColumn(
            "_silver_transformation_timestamp",
            F.current_timestamp() if run_ts is None else run_ts,
        )
    )


def silver_layer(
    bronze: DataFrame,
    keys: Sequence[str] = KEYS,
    newest: Sequence[str] = NEWEST,
    run_ts: Column | None = None,
) -> DataFrame:
    """Raw versions -> clean rows: dedup, cast, gap filter, quality flag, run time.

    The newest version is chosen first and checked afterwards: a bar whose newest version
    is invalid has no clean row.  One shuffle, by key; everything after it is row-local.
    """
    return drop_missing(newest_rows(bronze, keys, newest, run_ts))


def upsert_latest(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str] = KEYS,
    newest: Sequence[str] = NEWEST,
) -> DataFrame:
    """Merge a batch into a table on the key; the newest version of each key stays."""
    return latest_version(union_sources([target, batch]), keys, newest)


def changed_keys(
    existing: DataFrame,
    incoming: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = KEYS,
    newest: Sequence[str] = NEWEST,
) -> DataFrame:
    """Keys of ``incoming`` that the table lacks or whose newest version differs in ``columns``.

    Both sides are reduced to one row per key before they meet; NULL equals NULL here.  A
    column the table does not have counts as NULL there.
    """
    ours = latest_version(incoming, keys, newest).select(*keys, F.struct(*columns).alias("_ours"))
    held = [
        (F.col(c) if c in existing.columns else F.lit(None)).try_cast(incoming.schema[c].dataType).alias(c)
        for c in columns
    ]
    theirs = latest_version(existing, keys, newest).select(
        *[F.col(k).alias(f"_held_{k}") for k in keys], F.struct(*held).alias("_theirs")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys]
    both = ours.join(theirs, same, "left")
    return both.where(~F.col("_ours").eqNullSafe(F.col("_theirs"))).select(*keys)


def new_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Incoming rows whose key the table does not hold yet.

    The table side is cut to the dates of the incoming batch by two scalar
    subqueries, which prune its partitions before the anti-join.
    """
    if "date" in keys:
        bounds = incoming.select(F.min("date").alias("lo"), F.max("date").alias("hi"))
        existing = existing.where(
            (F.col("date") >= bounds.select("lo").scalar())
            & (F.col("date") <= bounds.select("hi").scalar())
        )
    known = existing.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    return incoming.join(known, [F.col(k) == F.col(f"_known_{k}") for k in keys], "left_anti")
