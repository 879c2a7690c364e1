"""One entry per operator: the library operator over the given tables.

A query only prepares its input and picks output columns.  Means and deviations
of doubles, whose last digit depends on the order of addition, are shown as
whole ten-thousandths (suffix ``_e4``); everything else is shown as computed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions import moment
from barlake.operators import bronze, gold, provenance, quality, retention, sector, serving, silver
from barlake.plans import jobs, runlog
from barlake.plans.sql import sql_over_layers
from barlake.schemas import OHLC, conform
from barlake.sources.files import read_bars, rejected, union_sources
from barlake.sources.layers import read_layer, write_layer
from barlake.sources.scratch import scratch_path
from barlake.sources.widening import read_widened
from barlake.streaming import (
    bars_from_stream,
    close_days,
    dedup_stream,
    read_bar_log,
    start_bar_log,
    start_bronze_append,
    start_gold_refresh,
    start_landing,
    start_silver_upsert,
)
from catalog import tables as t

Query = Callable[[SparkSession, str], DataFrame]

BAR = ("date", "symbol", "open", "high", "low", "close", "adjusted_close", "volume")
VERSION_TIME = dt.datetime(1999, 6, 30, 0, 30)
SYMBOL = "NATION_19"


def e4(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.floor(column * 10000)


def _bars_only(df: DataFrame) -> DataFrame:
    return df.select(*BAR)


def _gold_columns(df: DataFrame) -> DataFrame:
    """Analytics rows with the deviation in whole ten-thousandths."""
    return df.drop("_gold_timestamp").withColumn("volatility_e4", e4("volatility_30d")).drop(
        "volatility_30d"
    )


# --- ticks, files, schemas ---------------------------------------------------


def ohlc_bars_ticks(spark: SparkSession, sf: str) -> DataFrame:
    return t.bars(spark, sf)


def ohlc_bars_events(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_bars(t.event_ticks(spark, sf), t.EVENT_ORDER)


def daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    """First and last of each day over versions enriched with stand-in indicators."""
    enriched = t.versions(spark, sf).withColumns(
        {
            "daily_return_pct": F.col("close") - F.col("open"),
            "ma_50": F.col("close"),
            "ma_200": F.col("open"),
            "volatility_30d": F.col("volume").cast("double"),
        }
    )
    return gold.daily_summary(enriched, t.VERSION_ORDER)


# A vendor's column names.
VENDOR = {"Date": "date", "Open": "open", "High": "high", "Low": "low", "Close": "close",
          "Adj Close": "adjusted_close", "Volume": "volume", "Symbol": "symbol"}


def _landed(spark: SparkSession, bars: DataFrame) -> str:
    """Bars as CSV files under the vendor's column names, which may include others."""
    path, ours = scratch_path(spark, "landed"), {name: theirs for theirs, name in VENDOR.items()}
    bars.withColumnsRenamed(ours).write.option("header", True).csv(path)
    return path


def ingest_bars(spark: SparkSession, sf: str) -> DataFrame:
    """All bars, landed as CSV and read back."""
    return _bars_only(read_bars(spark, _landed(spark, t.bars(spark, sf)), "csv", rename=VENDOR))


def ingest_bars_range(spark: SparkSession, sf: str) -> DataFrame:
    """Landed bars of some symbols and a range."""
    wanted = ["NATION_1", "NATION_7", "NATION_12", "NATION_20"]
    landed = _landed(spark, t.bars(spark, sf))
    return _bars_only(read_bars(spark, landed, "csv", wanted, "1996-01-01", "2000-12-31", VENDOR))


def ingest_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Landed records whose date cannot be read, per symbol, in spite of a date range."""
    spoiled = t.bars(spark, sf).withColumn(
        "date", F.when(F.col("volume") % 10 == 0, "n/a").otherwise(F.col("date").cast("string"))
    )
    found = read_bars(spark, _landed(spark, spoiled), "csv", start="1996-01-01", rename=VENDOR)
    return rejected(found).groupBy("symbol").agg(F.count("*").alias("rejects"))


def ingest_added_column(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings, the later with one more column and another order of columns."""
    rows = t.bars(spark, sf)
    early = _landed(spark, rows.where("date < '1998-07-01'"))
    late = rows.where("date >= '1998-07-01'").withColumn("lot", F.col("volume").cast("string"))
    late = _landed(spark, late.select(*sorted(late.columns)))
    found = read_bars(spark, [early, late], "csv", rename=VENDOR)
    return found.select(*_bars_only(found).columns, "lot")


def ingest_landed_once(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings in one folder, the later with other columns; three runs read each file once."""
    rows, folder = t.bars(spark, sf), scratch_path(spark, "landing")
    raw, checkpoint, staging = (scratch_path(spark, name) for name in ("landed-raw", "checkpoint", "landed-staging"))
    ours = {name: theirs for theirs, name in VENDOR.items()}
    early = rows.where("date < '1998-07-01'")
    late = rows.where("date >= '1998-07-01'").withColumn("lot", F.col("volume").cast("string"))
    for landing in (early, late.select(*sorted(late.columns)), None):
        if landing is not None:
            landing.withColumnsRenamed(ours).write.mode("append").option("header", True).csv(folder)
        start_landing(spark, folder, raw, checkpoint, staging, rename=VENDOR, partition="month").awaitTermination()
    return _bars_only(read_layer(spark, raw))


def ingest_retried(spark: SparkSession, sf: str) -> DataFrame:
    """One load, rejects included, run three times under its load time; the raw layer has it once."""
    paths = _layer_paths(spark, "retried")
    spoiled = t.bars(spark, sf).withColumn("date", F.when(F.col("volume") % 10 != 0, F.col("date")))
    spoiled = spoiled.withColumn("symbol", F.when(F.col("volume") % 7 != 0, F.col("symbol")))
    for _ in range(3):
        jobs.run_bronze(spoiled, paths, t.LOADED_AT, "month")
    return _bars_only(read_layer(spark, paths["bronze"]))


def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Raw text in vendor order and spelling onto the declared schema."""
    raw = t.dirty_versions(spark, sf).select(
        F.col("date").cast("string").alias("Date"),
        "close",
        F.col("adjusted_close").alias("Adj Close"),
        "volume",
        "low",
        "high",
        "open",
        F.col("symbol").alias("Symbol"),
    )
    out = conform(raw, OHLC, {"Adj Close": "adjusted_close"})
    return out.withColumn("close", F.when(~F.isnan("close"), F.col("close")))


def union_of_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of two sources, one of them without volume."""
    events = gold.daily_bars(t.event_ticks(spark, sf), t.EVENT_ORDER).drop("volume")
    return union_sources([t.bars(spark, sf), events])


def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A raw table whose later load brought a new column, read with merged schemas."""
    path = scratch_path(spark, "evolving")
    rows = t.bars(spark, sf)
    before = F.col("date") < F.lit(dt.date(1998, 7, 1))
    bronze.append_bronze(rows.where(before), path, t.LOADED_AT, "month")
    later = rows.where(~before).withColumn("pe_ratio", F.col("close") / 100)
    bronze.append_bronze(later, path, t.LOADED_AT, "month")
    return read_layer(spark, path, merge_schema=True).select(*BAR, "pe_ratio")


def calendar_grid(spark: SparkSession, sf: str) -> DataFrame:
    return quality.calendar_grid(t.bars(spark, sf))


# --- raw layer ---------------------------------------------------------------


def _stored_bronze(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "bronze")
    bronze.append_bronze(t.bars(spark, sf), path, t.LOADED_AT, "month")
    return path


def bronze_rows(spark: SparkSession, sf: str) -> DataFrame:
    stored = bronze.read_bronze(spark, _stored_bronze(spark, sf))
    return stored.select(*BAR, "_ingestion_date")


def read_bronze_eq(spark: SparkSession, sf: str) -> DataFrame:
    stored = _stored_bronze(spark, sf)
    equal = {"symbol": SYMBOL, "_ingestion_date": t.LOADED_AT.date()}
    return _bars_only(bronze.read_bronze(spark, stored, equal))


def read_silver_range(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    write_layer(silver.silver_layer(t.loaded_bars(spark, sf)), path, "overwrite", "month")
    return _bars_only(read_layer(spark, path, start="1996-02-10", end="1999-11-20"))


def read_gold_range(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "gold")
    write_layer(t.gold(spark, sf), path, "replace", "month")
    return _gold_columns(read_layer(spark, path, start="1999-03-05"))


def latest_date(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.latest_date(t.bars(spark, sf))


def distinct_symbols(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.distinct_symbols(t.ticks(spark, sf))


def bronze_as_of(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.bronze_as_of(t.versions(spark, sf), VERSION_TIME, newest=t.VERSION_ORDER)
    return _bars_only(rows)


def purge_superseded(spark: SparkSession, sf: str) -> DataFrame:
    rows = bronze.purge_superseded(
        t.versions(spark, sf), VERSION_TIME, 24 * 365, newest=t.VERSION_ORDER
    )
    return rows.select(*BAR, "l_linenumber", "l_partkey", "l_suppkey")


# --- clean layer -------------------------------------------------------------


def silver_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return _bars_only(silver.latest_version(t.versions(spark, sf), newest=t.VERSION_ORDER))


def _no_nan(df: DataFrame) -> DataFrame:
    """Show a NaN close as NULL plus a marker, since engines print NaN differently."""
    return df.withColumn("close_is_nan", F.coalesce(F.isnan("close"), F.lit(False))).withColumn(
        "close", F.when(~F.isnan("close"), F.col("close"))
    )


def silver_cast(spark: SparkSession, sf: str) -> DataFrame:
    return _no_nan(_bars_only(silver.cast_prices(t.dirty_versions(spark, sf))))


def silver_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return _bars_only(silver.drop_missing(silver.cast_prices(t.dirty_versions(spark, sf))))


def silver_layer(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver.silver_layer(t.dirty_versions(spark, sf), newest=t.VERSION_ORDER)
    return rows.select(*BAR, "_quality_check_passed")


def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver.quality_flags(silver.cast_prices(t.dirty_versions(spark, sf)))
    flagged = rows.withColumn("failed_rules", F.array_join("_failed_rules", ","))
    return _no_nan(flagged).select(
        *BAR, "l_partkey", "close_is_nan", "failed_rules", "_quality_check_passed"
    )


def null_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver.null_rows(silver.cast_prices(t.dirty_versions(spark, sf)))
    return _no_nan(rows).select(*BAR, "close_is_nan", "l_partkey", "l_suppkey")


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Versions loaded by a moment merged with those loaded after it."""
    rows = t.versions(spark, sf)
    by_then = F.col("_ingestion_timestamp") <= moment(VERSION_TIME)
    target = silver.latest_version(rows.where(by_then), newest=t.VERSION_ORDER)
    return _bars_only(silver.upsert_latest(target, rows.where(~by_then), newest=t.VERSION_ORDER))


def incremental_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All bars as incoming, against a table that holds the bars of supplied line status F."""
    known = t.traded_lines(spark, sf).where("l_linestatus = 'F'").select("date", "symbol").distinct()
    return silver.new_rows(known, t.bars(spark, sf))


# --- analytics layer ---------------------------------------------------------


def daily_returns(spark: SparkSession, sf: str) -> DataFrame:
    return gold.daily_returns(t.bars(spark, sf)).select(
        "date", "symbol", "close", "daily_return_pct"
    )


def _average(days: int, frame: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        name = f"ma_{days}"
        rows = gold.moving_averages(t.bars(spark, sf), frame, days=(days,))
        return rows.select("date", "symbol", "close", name)

    return query


def _volatility(frame: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = gold.volatility(gold.daily_returns(t.bars(spark, sf)), frame=frame)
        return rows.select("date", "symbol", e4("volatility_30d").alias("volatility_e4"))

    return query


def gold_layer(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_columns(t.gold(spark, sf))


def layers_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Stored raw, clean and analytics layers from one chained run."""
    root = scratch_path(spark, "layers")
    paths = {layer: f"{root}/{layer}" for layer in ("bronze", "silver", "gold")}
    jobs.run_full(
        spark, t.bars(spark, sf), paths, t.AS_OF, t.LOADED_AT, average_as=t.EXACT, partition="month"
    )
    return _gold_columns(read_layer(spark, paths["gold"]))


def incremental_run(spark: SparkSession, sf: str) -> DataFrame:
    """A full run over the first years, then an incremental one with everything."""
    root = scratch_path(spark, "incremental")
    paths = {layer: f"{root}/{layer}" for layer in ("bronze", "silver", "gold")}
    rows = t.bars(spark, sf)
    early = rows.where(F.col("date") < F.lit(dt.date(2001, 5, 1)))
    jobs.run_full(
        spark, early, paths, t.AS_OF, t.LOADED_AT, average_as=t.EXACT, partition="month"
    )
    jobs.run_incremental(
        spark, rows, paths, t.LOADED_AT, average_as=t.EXACT, partition="month"
    )
    return _gold_columns(read_layer(spark, paths["gold"]))


def _layer_paths(spark: SparkSession, name: str) -> dict[str, str]:
    root = scratch_path(spark, name)
    return {layer: f"{root}/{layer}" for layer in ("bronze", "silver", "gold")}


def _full_run(spark: SparkSession, rows: DataFrame, paths: dict[str, str], **kwargs) -> dict:
    return jobs.run_full(
        spark, rows, paths, t.AS_OF, t.LOADED_AT, average_as=t.EXACT, partition="month", **kwargs
    )


def incremental_correction(spark: SparkSession, sf: str) -> DataFrame:
    """All bars, then a run in which some closes are corrected and some are withdrawn."""
    paths, rows, volume = _layer_paths(spark, "correction"), t.bars(spark, sf), F.col("volume")
    _full_run(spark, rows, paths)
    close = F.when(volume % 43 == 0, F.col("close") * 2).otherwise(F.col("close"))
    corrected = rows.withColumn("close", F.when(volume % 41 != 0, close))
    jobs.run_incremental(
        spark, corrected, paths, t.LOADED_LATER, average_as=t.EXACT, partition="month"
    )
    return _gold_columns(read_layer(spark, paths["gold"]))


def incremental_far_apart(spark: SparkSession, sf: str) -> DataFrame:
    """All bars, then a run that corrects two days nearly six years apart."""
    paths, rows = _layer_paths(spark, "apart"), t.bars(spark, sf)
    _full_run(spark, rows, paths)
    touched = F.col("date").isin(dt.date(1995, 6, 15), dt.date(2001, 3, 5))
    corrected = rows.withColumn("close", F.when(touched, F.col("close") * 2).otherwise(F.col("close")))
    jobs.run_incremental(
        spark, corrected, paths, t.LOADED_LATER, average_as=t.EXACT, partition="month"
    )
    return _gold_columns(read_layer(spark, paths["gold"]))


def incremental_late_bar(spark: SparkSession, sf: str) -> DataFrame:
    """A full run without some weeks of one symbol, which then arrive late."""
    paths, rows = _layer_paths(spark, "late"), t.bars(spark, sf)
    late = (F.col("symbol") == SYMBOL) & F.col("date").between("1998-03-01", "1998-03-20")
    _full_run(spark, rows.where(~late), paths)
    jobs.run_incremental(
        spark, rows.where(late), paths, t.LOADED_LATER, average_as=t.EXACT, partition="month"
    )
    return _gold_columns(read_layer(spark, paths["gold"]))


def rebuild_after_removal(spark: SparkSession, sf: str) -> DataFrame:
    """A full run, a later load whose closes are missing, and a rebuild."""
    paths, rows = _layer_paths(spark, "rebuilt"), t.bars(spark, sf)
    _full_run(spark, rows, paths)
    spoiled = rows.where("volume % 41 = 0").withColumn("close", F.lit(None).cast("double"))
    jobs.run_bronze(spoiled, paths, t.LOADED_LATER, "month")
    jobs.run_silver(spark, paths, partition="month")
    jobs.run_gold(spark, paths, average_as=t.EXACT, partition="month")
    return _gold_columns(read_layer(spark, paths["gold"]))


def full_run_retained(spark: SparkSession, sf: str) -> DataFrame:
    """What a full run with retention leaves in the clean and the analytics layer."""
    paths = _layer_paths(spark, "retained")
    _full_run(spark, t.bars(spark, sf), paths, silver_days=90, gold_days=30)
    clean = read_layer(spark, paths["silver"]).select("date", "symbol")
    rows = _gold_columns(read_layer(spark, paths["gold"]))
    return clean.join(rows, ["date", "symbol"], "left")


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """What the writes of a full run counted."""
    written = _full_run(spark, t.bars(spark, sf), _layer_paths(spark, "metrics"))
    return jobs.run_metrics(spark, written)


def run_history(spark: SparkSession, sf: str) -> DataFrame:
    """Three logged full runs over a growing landing, some of it without a symbol, some below zero."""
    paths, log = _layer_paths(spark, "history"), scratch_path(spark, "run-log")
    landing = t.bars(spark, sf).withColumns({
        "symbol": F.when(F.col("volume") % 7 != 0, F.col("symbol")),
        "volume": F.when(F.col("volume") % 5 == 0, -F.col("volume")).otherwise(F.col("volume")),
    })
    for n, until in enumerate(("1996-12-31", "1998-06-30", "2100-01-01")):
        rows, loaded = landing.where(F.col("date") <= until), t.LOADED_AT + dt.timedelta(days=n)
        full = lambda: jobs.run_full(spark, rows, paths, batch_ts=loaded, average_as=t.EXACT, partition="month")
        runlog.run_logged(spark, log, f"run-{n + 1}", full)
    history = runlog.run_history(runlog.read_log(spark, log))
    return history.withColumn("timed", F.col("seconds") > 0).drop("started", "seconds", "times_as_long")


def gold_provenance(spark: SparkSession, sf: str) -> DataFrame:
    """The loads behind every analytics row over the newest versions, each loaded at a time of its own."""
    newest = silver.latest_version(t.versions(spark, sf), newest=t.VERSION_ORDER)
    text = lambda name: F.date_format(name, "yyyy-MM-dd HH:mm:ss")
    return provenance.gold_provenance(newest).withColumns(
        {"earliest_load": text("earliest_load"), "latest_load": text("latest_load")}
    )


def schema_widening(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads of one raw layer: whole numbers became long, then double; lots became text, then fell away."""
    path, rows = scratch_path(spark, "widened"), t.bars(spark, sf)
    volume = lambda kind: F.col("volume").cast(kind)
    early = rows.where("date < '1997-01-01'").withColumn("lot", volume("int")).withColumn("volume", volume("int"))
    later = rows.where("date BETWEEN '1997-01-01' AND '1998-06-30'")
    later = later.withColumn("lot", F.concat(F.lit("L"), volume("string"))).withColumn("low", F.col("low").cast("decimal(12,2)"))
    last = rows.where("date > '1998-06-30'").withColumn("volume", volume("double"))
    for load in (early, later.select(*sorted(later.columns)), last):
        write_layer(load, path, "append", "month")
    return read_widened(spark, path).select(*BAR, "lot")


def purge_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Superseded versions removed from the stored raw layer."""
    paths = _layer_paths(spark, "purged")
    write_layer(t.versions(spark, sf), paths["bronze"], "append", "month")
    jobs.purge_bronze(
        spark, paths, VERSION_TIME, 24 * 365, newest=t.VERSION_ORDER, partition="month"
    )
    rows = read_layer(spark, paths["bronze"])
    return rows.select(*BAR, "l_linenumber", "l_partkey", "l_suppkey")


def gold_since(spark: SparkSession, sf: str) -> DataFrame:
    """The analytics rows from a date on, computed without those before it."""
    return _gold_columns(gold.gold_since(t.loaded_bars(spark, sf), "2000-02-29", average_as=t.EXACT))


def ml_lag_features(spark: SparkSession, sf: str) -> DataFrame:
    return gold.lag_features(t.bars(spark, sf)).drop("open", "high", "low", "adjusted_close", "volume")


def price_momentum_5d(spark: SparkSession, sf: str) -> DataFrame:
    return gold.price_momentum(t.bars(spark, sf)).select(
        "date", "symbol", "close", "price_momentum_5d"
    )


# --- questions ---------------------------------------------------------------


def stock_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = serving.stock_history(t.gold(spark, sf), SYMBOL, limit=100, as_of=t.AS_OF)
    return _gold_columns(rows)


def stock_performance(spark: SparkSession, sf: str) -> DataFrame:
    rows = serving.stock_performance(t.gold(spark, sf), 365, 10, "2000-06-30")
    return rows.withColumn("avg_volatility_e4", e4("avg_volatility")).drop("avg_volatility")


def top_gainers(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_gainers(t.gold(spark, sf))


def top_gainers_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return serving.top_gainers_per_day(t.gold(spark, sf), 5)


def gold_report(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_columns(serving.gold_report(t.gold(spark, sf), SYMBOL, "1999-01-01"))


def avg_return_by_symbol(spark: SparkSession, sf: str) -> DataFrame:
    rows = serving.avg_return_by_symbol(t.gold(spark, sf))
    return rows.select("symbol", e4("avg_return").alias("avg_return_e4"))


def sql_over_gold(spark: SparkSession, sf: str) -> DataFrame:
    return sql_over_layers(
        spark,
        """
        SELECT symbol, year(date) AS traded_year, count(*) AS days,
               max(daily_high) AS highest, sum(daily_volume) AS volume
        FROM gold
        WHERE date >= '1996-01-01' AND daily_return_pct > 0
        GROUP BY symbol, year(date);
        """,
        {"gold": t.gold(spark, sf)},
    )


def sql_with_ctes(spark: SparkSession, sf: str) -> DataFrame:
    """CTEs, a window, a correlated subquery and a name in an expression, over two given tables."""
    return sql_over_layers(
        spark,
        """
        WITH best AS (
          SELECT symbol, date, daily_close,
                 row_number() OVER (PARTITION BY symbol ORDER BY daily_close DESC, date) AS place
          FROM IDENTIFIER('go' || 'ld')),
        known AS (SELECT symbol, max(sector) AS sector FROM meta GROUP BY symbol)
        SELECT best.symbol, best.date, best.daily_close, known.sector,
               (SELECT count(*) FROM gold g WHERE g.symbol = best.symbol AND g.date > best.date) AS later
        FROM best LEFT JOIN known ON known.symbol = best.symbol
        WHERE place <= 3 AND EXISTS (SELECT 1 FROM gold x WHERE x.symbol = best.symbol AND x.daily_volume > 40)
        """,
        {"gold": t.gold(spark, sf), "meta": t.metadata(spark, sf)},
    )


def export_json_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All columns as JSON, with their NULLs; doubles as whole ten-thousandths."""
    rows = t.gold(spark, sf)
    doubles = ("daily_return_pct", "ma_50_day", "ma_200_day", "volatility_30d")
    prices = [F.col(f"daily_{p}").cast("decimal(10,2)").alias(p) for p in ("open", "high", "low", "close")]
    return serving.json_rows(rows.select("symbol", "date", "daily_volume", *prices, *[e4(c).alias(c) for c in doubles]))


# --- quality, metrics, retention ---------------------------------------------


def dq_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_counts(silver.cast_prices(t.dirty_versions(spark, sf)))


def dq_schema(spark: SparkSession, sf: str) -> DataFrame:
    return quality.schema_differences(
        t.dirty_versions(spark, sf).drop("adjusted_close", *t.VERSION_ORDER[:-1], "_ingestion_date")
        .withColumn("note", F.lit("")), OHLC
    )


def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_keys(t.versions(spark, sf))


def dq_score(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_score(silver.cast_prices(t.dirty_versions(spark, sf)))


def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.distinct_keys(t.versions(spark, sf))


def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    return quality.missing_days(t.bars(spark, sf))


def missing_days_until(spark: SparkSession, sf: str) -> DataFrame:
    """Missing days up to a date after the last bars."""
    return quality.missing_days(t.bars(spark, sf), until="2001-11-20")


def profile_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The exact columns of the profile; the approximate ones have no counterpart in SQL."""
    profile = quality.profile_columns(t.bars(spark, sf))
    return profile.select("column", "rows", "missing", "smallest", "largest")


def _layers(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "bronze": t.dirty_versions(spark, sf),
        "silver": silver.silver_layer(t.dirty_versions(spark, sf), newest=t.VERSION_ORDER),
        "gold": t.gold(spark, sf),
    }


def profile_range(spark: SparkSession, sf: str) -> DataFrame:
    """The profile of two years out of stored sketches, after two days were corrected; approximate
    values as whether they are within twice the stated error of the sketches."""
    layer, stored = scratch_path(spark, "profiled"), scratch_path(spark, "sketches")
    rows, names = t.bars(spark, sf), ("symbol", "close", "volume")
    write_layer(rows, layer, "overwrite", "month")
    jobs.refresh_profile(spark, layer, stored, columns=names)
    touched = F.col("date").isin(dt.date(1996, 3, 5), dt.date(1997, 6, 2))
    spoiled = rows.withColumn("close", F.when(~touched, F.col("close")))
    write_layer(spoiled.where("date BETWEEN '1996-03-01' AND '1996-03-31' OR date BETWEEN '1997-06-01' AND '1997-06-30'"), layer, "replace", "month")
    jobs.refresh_profile(spark, layer, stored, spoiled.where(touched).select("date"), names)
    found = quality.profile_range(read_layer(spark, stored), "1996-01-01", "1997-12-31")
    exact = read_layer(spark, layer, "1996-01-01", "1997-12-31").select(*[F.col(c).cast("double") if c != "symbol" else F.col(c) for c in names])
    q = F.col("_quartiles")
    truth = [
        exact.withColumn("_quartiles", found.where(F.col("column") == c).select("approx_quartiles").scalar()).agg(
            F.lit(c).alias("column"), F.count_distinct(c).alias("distinct"), F.count(c).alias("n"),
            *[F.count_if(F.col(c).try_cast("double") < q[i]).alias(f"below_{i}") for i in range(3)],
            *[F.count_if(F.col(c).try_cast("double") <= q[i]).alias(f"to_{i}") for i in range(3)],
        )
        for c in names
    ]
    checked = found.join(union_sources(truth), "column")
    near = [(F.col(f"below_{i}") <= F.col("n") * (p + 0.03)) & (F.col(f"to_{i}") >= F.col("n") * (p - 0.03)) for i, p in enumerate((0.25, 0.5, 0.75))]
    number = lambda c: F.when(F.col("column") != "symbol", F.floor(F.col(c).try_cast("double") * 100 + 0.5))
    return checked.select(
        "column", "rows", "missing", number("smallest").alias("smallest_e2"), number("largest").alias("largest_e2"),
        (F.abs(F.col("approx_distinct") - F.col("distinct")) <= F.col("distinct") * 0.05 + 1).alias("distinct_near"),
        (F.col("approx_quartiles").isNull() | (near[0] & near[1] & near[2])).alias("quartiles_near"),
    )


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    return quality.layer_counts(_layers(spark, sf))


def layer_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return quality.layer_lineage(_layers(spark, sf))


def symbol_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.symbol_metrics(t.bars(spark, sf))


def return_distribution(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.return_distribution(t.gold(spark, sf))
    return rows.select(
        "symbols", "returns", e4("mean_return").alias("mean_return_e4"),
        e4("std_return").alias("std_return_e4"),
    )


def retain_silver(spark: SparkSession, sf: str) -> DataFrame:
    return retention.retain_silver(t.bars(spark, sf), t.AS_OF)


def retain_gold(spark: SparkSession, sf: str) -> DataFrame:
    return _gold_columns(retention.retain_gold(t.gold(spark, sf), t.AS_OF))


# --- sectors -----------------------------------------------------------------


def symbol_dim(spark: SparkSession, sf: str) -> DataFrame:
    rows = sector.symbol_dim(t.metadata(spark, sf))
    return rows.withColumn("updated_on", F.to_date("updated_at")).withColumn(
        "market_cap", F.col("market_cap").cast("double")
    ).drop("updated_at")


def sector_daily(spark: SparkSession, sf: str) -> DataFrame:
    rows = sector.sector_daily(
        gold.daily_returns(t.bars(spark, sf)), sector.symbol_dim(t.metadata(spark, sf))
    )
    return rows.select(
        "sector", "date", "members", "volume",
        e4("mean_return").alias("mean_return_e4"), e4("median_return").alias("median_return_e4"),
    )


def sector_rollup(spark: SparkSession, sf: str) -> DataFrame:
    rows = sector.sector_rollup(
        gold.daily_returns(t.bars(spark, sf)), sector.symbol_dim(t.metadata(spark, sf))
    )
    return rows.withColumn("mean_return_e4", e4("mean_return")).drop("mean_return")


def asof_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = sector.asof_metadata(t.bars(spark, sf), t.metadata(spark, sf))
    return rows.select(
        "date", "symbol", "close", "company_name", "sector", F.col("market_cap").cast("double")
    )


# --- streams -----------------------------------------------------------------


def _land_and_run(spark: SparkSession, sf: str, start, repeat: bool = False) -> None:
    """The events in three landings, each taken by a run of its own: event times are out of
    order across the micro-batches.  With ``repeat`` a landing sends the one before again."""
    folder, events = scratch_path(spark, "landing"), t.table(spark, sf, "events")
    turn = F.pmod("event_id", F.lit(3))
    for n in range(3):
        sent = events.where(turn == n)
        sent = sent.union(events.where((turn == n - 1) | (turn == n))) if repeat else sent
        sent.write.mode("append").parquet(folder)
        start(t.landed_ticks(spark, folder)).awaitTermination()


# Event times of a landing reach back over the whole month that the events span.
DELAY = "60 days"


def stream_bronze(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint = scratch_path(spark, "stream-bronze"), scratch_path(spark, "checkpoint")
    _land_and_run(spark, sf, lambda ticks: start_bronze_append(ticks, path, checkpoint, "month"))
    return spark.read.parquet(path).select("date", "symbol", "price", "size", "event_id")


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event sent at least twice, in one landing and across two, as by a source that retransmits."""
    path, checkpoint = scratch_path(spark, "stream-dedup"), scratch_path(spark, "checkpoint")
    once = lambda ticks: dedup_stream(ticks, ["event_id"], delay=DELAY)
    _land_and_run(spark, sf, lambda ticks: start_bronze_append(once(ticks), path, checkpoint), True)
    return spark.read.parquet(path).select("date", "symbol", "price", "size", "event_id")


def _bar_log(spark: SparkSession, sf: str) -> str:
    path, checkpoint = scratch_path(spark, "stream-bars"), scratch_path(spark, "checkpoint")
    bars = lambda ticks: bars_from_stream(ticks, t.EVENT_ORDER, delay=DELAY)
    _land_and_run(spark, sf, lambda ticks: start_bar_log(bars(ticks), path, checkpoint))
    return path


def stream_daily_bars(spark: SparkSession, sf: str) -> DataFrame:
    return read_bar_log(spark, _bar_log(spark, sf))


def stream_bars_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Closed days moved from the bar log to the clean layer, and the open days left in the log."""
    log, silver_path = _bar_log(spark, sf), scratch_path(spark, "closed")
    close_days(spark, log, silver_path, "2024-01-20", t.LOADED_AT)
    left = read_bar_log(spark, log).where("date >= '2024-01-20'")  # the last batch is left whole
    closed = read_layer(spark, silver_path).select(*BAR, F.lit("clean").alias("place"))
    return closed.unionByName(left.select(*BAR, F.lit("log").alias("place")))


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    path, checkpoint, staging = (scratch_path(spark, n) for n in ("stream-silver", "checkpoint", "staging"))
    _land_and_run(
        spark, sf,
        lambda ticks: start_silver_upsert(
            t.event_versions(ticks), path, checkpoint, staging, newest=t.EVENT_VERSION_ORDER
        ),
    )
    return read_layer(spark, path).select(*BAR, "event_id")


def _refreshed_gold(spark: SparkSession, sf: str, spoil: Callable[[DataFrame], DataFrame]) -> DataFrame:
    paths, checkpoint, staging = _layer_paths(spark, "stream-gold"), scratch_path(spark, "checkpoint"), scratch_path(spark, "staging")
    _land_and_run(
        spark, sf,
        lambda ticks: start_gold_refresh(
            spoil(t.event_versions(ticks)), paths, checkpoint, staging,
            newest=t.EVENT_VERSION_ORDER, average_as=t.EXACT,
        ),
    )
    return _gold_columns(read_layer(spark, paths["gold"]))


def stream_gold_tail(spark: SparkSession, sf: str) -> DataFrame:
    return _refreshed_gold(spark, sf, lambda versions: versions)


def stream_upsert_invalid(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of which every fifth has no close: a key whose newest one is such has no row."""
    close = F.when(F.col("event_id") % 5 != 0, F.col("close"))
    return _refreshed_gold(spark, sf, lambda versions: versions.withColumn("close", close))


def stream_over_batch_layer(spark: SparkSession, sf: str) -> DataFrame:
    """A clean layer of batch runs, from all but the oldest third of the versions, and a stream that
    then brings those: a key whose newest version is invalid stays out of it."""
    paths = _layer_paths(spark, "over-batch")
    folder, checkpoint, staging = (scratch_path(spark, name) for name in ("versions", "checkpoint", "over-staging"))
    close = F.when(F.col("event_id") % 5 != 0, F.col("close"))
    versions = t.event_versions(t.event_ticks(spark, sf)).withColumn("close", close)
    early = F.col("_ingestion_timestamp") < F.to_timestamp(F.lit("2024-01-11"))
    old = F.pmod("event_id", F.lit(3)) == 0
    write_layer(versions.where(~early | ~old), paths["bronze"], "append", "month")
    raw = read_layer(spark, paths["bronze"])
    write_layer(silver.silver_layer(raw, newest=t.EVENT_VERSION_ORDER), paths["silver"], "overwrite", "month")
    versions.where(early & old).write.parquet(folder)
    for _ in range(2):
        late = spark.readStream.schema(versions.schema).parquet(folder)
        start_silver_upsert(
            late, paths["silver"], checkpoint, staging, t.EVENT_VERSION_ORDER, "month", raw=raw
        ).awaitTermination()
    return _bars_only(read_layer(spark, paths["silver"])).withColumn("volume", F.col("volume").cast("bigint"))


QUERIES: dict[str, Query] = {
    "ohlc_bars_ticks": ohlc_bars_ticks,
    "ohlc_bars_events": ohlc_bars_events,
    "daily_summary": daily_summary,
    "ingest_bars": ingest_bars,
    "ingest_bars_range": ingest_bars_range,
    "ingest_rejects": ingest_rejects,
    "ingest_landed_once": ingest_landed_once,
    "ingest_retried": ingest_retried,
    "ingest_added_column": ingest_added_column,
    "conform_schema": conform_schema,
    "union_sources": union_of_sources,
    "schema_evolution": schema_evolution,
    "calendar_grid": calendar_grid,
    "bronze_rows": bronze_rows,
    "read_bronze_eq": read_bronze_eq,
    "read_silver_range": read_silver_range,
    "read_gold_range": read_gold_range,
    "latest_date": latest_date,
    "distinct_symbols": distinct_symbols,
    "bronze_as_of": bronze_as_of,
    "purge_superseded": purge_superseded,
    "silver_dedup": silver_dedup,
    "silver_cast": silver_cast,
    "silver_not_null": silver_not_null,
    "silver_layer": silver_layer,
    "quality_flags": quality_flags,
    "null_rows": null_rows,
    "upsert_latest": upsert_latest,
    "incremental_new_rows": incremental_new_rows,
    "daily_returns": daily_returns,
    "ma_50_calendar": _average(50, "calendar"),
    "ma_50_rows": _average(50, "rows"),
    "ma_200_calendar": _average(200, "calendar"),
    "ma_200_rows": _average(200, "rows"),
    "volatility_30_calendar": _volatility("calendar"),
    "volatility_30_rows": _volatility("rows"),
    "gold_layer": gold_layer,
    "layers_end_to_end": layers_end_to_end,
    "incremental_run": incremental_run,
    "incremental_correction": incremental_correction,
    "incremental_late_bar": incremental_late_bar,
    "incremental_far_apart": incremental_far_apart,
    "rebuild_after_removal": rebuild_after_removal,
    "full_run_retained": full_run_retained,
    "run_metrics": run_metrics,
    "run_history": run_history,
    "gold_provenance": gold_provenance,
    "schema_widening": schema_widening,
    "purge_stored": purge_stored,
    "gold_since": gold_since,
    "ml_lag_features": ml_lag_features,
    "price_momentum_5d": price_momentum_5d,
    "stock_history": stock_history,
    "stock_performance": stock_performance,
    "top_gainers": top_gainers,
    "top_gainers_per_day": top_gainers_per_day,
    "gold_report": gold_report,
    "avg_return_by_symbol": avg_return_by_symbol,
    "sql_over_gold": sql_over_gold,
    "sql_with_ctes": sql_with_ctes,
    "export_json_rows": export_json_rows,
    "dq_nulls": dq_nulls,
    "dq_schema": dq_schema,
    "dq_duplicates": dq_duplicates,
    "dq_score": dq_score,
    "distinct_keys": distinct_keys,
    "missing_days": missing_days,
    "missing_days_until": missing_days_until,
    "profile_columns": profile_columns,
    "profile_range": profile_range,
    "layer_counts": layer_counts,
    "layer_lineage": layer_lineage,
    "symbol_metrics": symbol_metrics,
    "return_distribution": return_distribution,
    "retain_silver": retain_silver,
    "retain_gold": retain_gold,
    "symbol_dim": symbol_dim,
    "sector_daily": sector_daily,
    "sector_rollup": sector_rollup,
    "asof_metadata": asof_metadata,
    "stream_bronze": stream_bronze,
    "stream_dedup": stream_dedup,
    "stream_daily_bars": stream_daily_bars,
    "stream_bars_closed": stream_bars_closed,
    "stream_upsert": stream_upsert,
    "stream_upsert_invalid": stream_upsert_invalid,
    "stream_gold_tail": stream_gold_tail,
    "stream_over_batch_layer": stream_over_batch_layer,
}
