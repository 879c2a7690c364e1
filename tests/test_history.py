"""The run log, the loads behind analytics rows, and tables whose column types changed."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType, StructType, TimestampType

from barlake.operators.gold import LONG_DAYS, VOLATILITY_DAYS, gold_layer
from barlake.operators.provenance import gold_provenance, outdated
from barlake.plans import jobs
from barlake.plans.runlog import log_progress, observed, read_log, run_history, run_logged
from barlake.sources.layers import read_layer, write_layer
from barlake.sources.widening import common_type, read_widened, type_changes
from barlake.streaming import start_bronze_append
from util import LOADED, bars, day, loaded, same_rows


# --- loads behind a row --------------------------------------------------------


def reads(days, n, frame):
    """The day numbers an analytics row reads, one bar at a time."""
    known = [d for d in sorted(days) if d <= n]
    within = lambda size: [d for d in known if d > n - size] if frame == "calendar" else known[-size:]
    used = set(within(LONG_DAYS))
    for d in within(VOLATILITY_DAYS):
        used |= set([x for x in known if x < d][-1:])
    return used


@pytest.mark.parametrize("frame", ["calendar", "rows"])
def test_loads_behind_a_row(spark, frame):
    pick = random.Random(3)
    days = sorted(pick.sample(range(260), 90) + pick.sample(range(600, 1400), 120) + [2400])
    times = {d: LOADED + dt.timedelta(hours=pick.randrange(5000)) for d in days}
    rows = bars(spark, [100] * len(days), days=days)
    load = spark.createDataFrame([(day(d), t) for d, t in times.items()], "date date, _ingestion_timestamp timestamp")
    got = {r.date: r for r in gold_provenance(rows.join(load, "date"), frame).collect()}
    assert len(got) == len(days)
    for d in days:
        used, r = reads(days, d, frame), got[day(d)]
        assert (r.bars_read, r.first_bar) == (len(used), day(min(used)))
        assert (r.earliest_load, r.latest_load) == (min(times[x] for x in used), max(times[x] for x in used))


def test_one_exchange(spark):
    plan = gold_provenance(loaded(bars(spark, [1, 2, 3])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(symbol") == 1


def test_outdated_rows_are_those_a_later_load_reaches(spark):
    rows = loaded(bars(spark, [10.0] * 300))
    gold = gold_layer(rows, run_ts=F.lit(LOADED + dt.timedelta(hours=1)))
    assert outdated(gold, gold_provenance(rows)).isEmpty()
    late = F.when(F.col("date") == day(50), F.lit(LOADED + dt.timedelta(days=1))).otherwise(F.col("_ingestion_timestamp"))
    stale = outdated(gold, gold_provenance(rows.withColumn("_ingestion_timestamp", late)))
    assert {r.date for r in stale.collect()} == {day(n) for n in range(50, 250)}
    assert outdated(gold.where("false"), gold_provenance(rows)).count() == 300


# --- run log -------------------------------------------------------------------


def layer_paths(folder):
    return {name: f"{folder}/{name}" for name in ("bronze", "silver", "gold")}


def test_runs_are_logged(spark, tmp_path):
    paths, log = layer_paths(tmp_path), f"{tmp_path}/log"
    good = bars(spark, range(10, 20))
    undated = good.withColumn("date", F.when(F.col("close") > 11, F.col("date"))).withColumn("volume", -F.col("volume"))
    start = [dt.datetime(2024, 7, n, tzinfo=dt.timezone.utc) for n in (1, 2, 3)]
    run = lambda rows, ts: lambda: jobs.run_full(spark, rows, paths, batch_ts=ts)
    run_logged(spark, log, "a", run(good, LOADED), start[0])
    with pytest.raises(ZeroDivisionError):
        run_logged(spark, log, "b", lambda: 1 / 0, start[1])
    for _ in range(2):  # the second time nothing is left to load
        run_logged(spark, log, "c", run(undated, LOADED + dt.timedelta(days=1)), start[2])
        a, b, c = run_history(read_log(spark, log)).orderBy("started").collect()
        assert (a.run_id, a.status, a.bronze_rows, a.silver_rows, a.gold_rows) == ("a", "done", 10, 10, 10)
        assert (a.rejected, a.error_rate, a.quality_score, a.score_change) == (0, 0.0, 1.0, None)
        assert (b.run_id, b.status, b.bronze_rows, b.error_rate, b.loaded_so_far) == ("b", "failed", None, None, 10)
        assert (c.status, c.silver_rows, c.quality_score, c.score_change) == ("done", 10, 0.2, pytest.approx(-0.8))
        assert c.seconds > 0 and c.times_as_long == pytest.approx(c.seconds / a.seconds)
        if _ == 0:
            assert (c.bronze_rows, c.rejected, c.error_rate, c.loaded_so_far) == (10, 2, 0.2, 20)
        else:
            assert (c.bronze_rows, c.rejected, c.error_rate, c.loaded_so_far) == (0, 0, None, 10)
    assert read_log(spark, log).count() == 7


def test_stream_batches_are_logged(spark, tmp_path):
    landing, log = f"{tmp_path}/landing", f"{tmp_path}/log"
    rows = bars(spark, range(1, 9))
    for part in (rows.where("close <= 5"), rows.where("close > 5").withColumn("symbol", F.when(F.col("close") > 6, "X"))):
        part.write.mode("append").parquet(landing)
        stream = observed(spark.readStream.schema(rows.schema).parquet(landing))
        query = start_bronze_append(stream, f"{tmp_path}/raw", f"{tmp_path}/checkpoint", "month")
        query.awaitTermination()
        log_progress(log, query)
        log_progress(log, query)
    first, second = run_history(read_log(spark, log)).orderBy("started").collect()
    assert (first.bronze_rows, first.rejected, second.bronze_rows, second.rejected) == (5, 0, 3, 1)
    assert second.loaded_so_far == 8 and second.run_id.endswith("-1")


# --- changed types -------------------------------------------------------------


@pytest.mark.parametrize(
    "types, common",
    [
        ([IntegerType(), LongType()], LongType()),
        ([IntegerType(), LongType(), DoubleType()], DoubleType()),
        ([FloatType(), FloatType()], FloatType()),
        ([FloatType(), IntegerType()], DoubleType()),
        ([LongType(), StringType()], StringType()),
        ([IntegerType(), DecimalType(8, 2)], DecimalType(12, 2)),
        ([DecimalType(38, 0), DecimalType(10, 9)], DoubleType()),
        ([DateType(), TimestampType()], TimestampType()),
        ([DateType(), LongType()], StringType()),
    ],
)
def test_common_type(types, common):
    assert common_type(types) == common and common_type(reversed(types)) == common


def test_nested_types_must_agree():
    with pytest.raises(TypeError):
        common_type([StructType(), StringType()])


def test_loads_of_changed_types_are_read_together(spark, tmp_path):
    paths = layer_paths(tmp_path)
    rows = loaded(bars(spark, range(1, 91)))
    part = lambda a, b: rows.where(F.col("close").between(a, b))
    loads = [
        part(1, 20).withColumn("volume", F.col("volume").cast("int")).withColumn("lot", F.col("close").cast("int")),
        part(21, 40).withColumn("close", F.col("close").cast("decimal(12,2)")),
        part(41, 60).withColumn("volume", F.col("volume").cast("double")).withColumnRenamed("high", "High"),
        part(61, 90).withColumn("lot", F.concat(F.lit("lot "), F.col("close"))).withColumn("date", F.when(F.col("close") != 90, F.col("date"))),
    ]
    for load in loads:
        write_layer(load, paths["bronze"], "append", "month")
    got = read_widened(spark, paths["bronze"])
    kinds = {f.name.lower(): f.dataType.simpleString() for f in got.schema.fields}
    assert (kinds["volume"], kinds["close"], kinds["lot"], kinds["date"], "_month" in kinds) == ("double", "double", "string", "date", False)
    lots = {r.close: r.lot for r in got.select("close", "lot").collect()}
    assert lots == {float(n): str(n) if n <= 20 else f"lot {float(n)}" if n > 60 else None for n in range(1, 91)}
    changes = {(r.column, r.type, r.common): r.files for r in type_changes(spark, paths["bronze"]).collect()}
    assert {k for k in changes if k[0] == "volume"} == {("volume", t, "double") for t in ("int", "bigint", "double")}
    assert all(n > 0 for n in changes.values()) and {k[0] for k in changes} == {"volume", "close", "lot"}

    jobs.run_silver(spark, paths, partition="month", widen=True)
    clean = read_layer(spark, paths["silver"])
    assert same_rows(clean.select("date", "symbol", "close", "high", "volume"), rows.where("close < 90").select("date", "symbol", "close", "high", "volume"))


def test_filters_reach_every_layout(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = bars(spark, range(1, 91))
    write_layer(rows.where("close <= 45").withColumn("volume", F.col("volume").cast("int")), path, "append")
    write_layer(rows.where("close > 45"), path, "append")
    found = read_widened(spark, path).where(F.col("date") == day(3)).select("close")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(date") == 2 and "ReadSchema: struct<close:double>" in plan
    assert [r.close for r in found.collect()] == [4.0]


def test_a_folder_without_files(spark, tmp_path):
    with pytest.raises(ValueError):
        read_widened(spark, str(tmp_path))
