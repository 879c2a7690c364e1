"""Stored layers: chained runs, idempotence, incremental refresh, retention, streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlake.operators import gold, quality, retention, silver
from barlake.plans import jobs
from barlake.sources.files import sample_bars
from barlake.sources import layers
from barlake.sources.layers import read_layer, replace_keys, write_layer
from barlake.sources.scratch import delete_path, path_exists
from barlake.streaming import landing
from barlake.streaming import (
    bars_from_stream,
    close_days,
    dedup_stream,
    parse_records,
    read_bar_log,
    start_bar_log,
    start_bronze_append,
    start_gold_refresh,
    start_landing,
    start_silver_upsert,
)
from util import LOADED, bars, column, day, loaded, same_rows


def layer_paths(tmp_path):
    return {layer: str(tmp_path / layer) for layer in ("bronze", "silver", "gold")}


def stored_gold(spark, paths):
    return read_layer(spark, paths["gold"]).drop("_gold_timestamp")


@pytest.mark.parametrize("partition", ["date", "month"])
def test_full_run_twice_changes_nothing_downstream(spark, tmp_path, partition):
    paths = layer_paths(tmp_path)
    days = 45 if partition == "month" else 8
    sample = sample_bars(spark, 2, days, end="2024-02-14")
    written = jobs.run_full(spark, sample, paths, batch_ts=LOADED, partition=partition)
    assert [written[x]["rows"] for x in ("bronze", "silver", "gold")] == [2 * days] * 3
    metrics = jobs.run_metrics(spark, written).collect()
    assert {(m.layer, m.rows, m.last_date) for m in metrics} == {
        (layer, 2 * days, dt.date(2024, 2, 14)) for layer in ("bronze", "silver", "gold")
    }
    before = stored_gold(spark, paths).collect()
    written = jobs.run_full(spark, sample, paths, batch_ts=LOADED, partition=partition)
    assert [written[x]["rows"] for x in ("bronze", "silver", "gold")] == [0, 2 * days, 2 * days]
    assert read_layer(spark, paths["bronze"]).count() == 2 * days
    assert sorted(before) == sorted(stored_gold(spark, paths).collect())


def test_unknown_layer_is_named(tmp_path):
    with pytest.raises(KeyError):
        jobs.layer_path(layer_paths(tmp_path), "platinum")


@pytest.mark.parametrize("partition", ["date", "month"])
def test_incremental_equals_full(spark, tmp_path, partition):
    step = 1 if partition == "month" else 6  # fewer folders
    everything = (
        bars(spark, range(100, 400, step), "A", range(0, 300, step))
        .union(bars(spark, [5, 9, 7, 8], "GAP", days=[0, 3, 280, 290]))
        .union(bars(spark, range(10, 60, step), "ENDED", range(0, 50, step)))
    )
    early = everything.where(F.col("date") < F.lit(day(270)))
    full, inc = layer_paths(tmp_path / "full"), layer_paths(tmp_path / "inc")
    jobs.run_full(spark, everything, full, batch_ts=LOADED, partition=partition)
    jobs.run_full(spark, early, inc, batch_ts=LOADED, partition=partition)
    for _ in range(2):  # the second run finds nothing new
        jobs.run_incremental(spark, everything, inc, LOADED, partition=partition)
    assert same_rows(stored_gold(spark, inc), stored_gold(spark, full))
    assert read_layer(spark, inc["bronze"]).count() == everything.count()


def test_incremental_resumes_after_a_stop(spark, tmp_path, monkeypatch):
    everything = bars(spark, range(1, 60))
    early = everything.where(F.col("date") < F.lit(day(40)))
    paths, staging = layer_paths(tmp_path / "inc"), str(tmp_path / "staging")
    jobs.run_full(spark, early, paths, batch_ts=LOADED, partition="month")

    def stopped(*args, **kwargs):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "refresh_gold", stopped)
        with pytest.raises(RuntimeError):
            jobs.run_incremental(spark, everything, paths, LOADED, staging, partition="month")
    jobs.run_incremental(spark, everything, paths, LOADED, staging, partition="month")
    assert not path_exists(spark, staging)
    assert read_layer(spark, paths["bronze"]).count() == 59
    want = gold.gold_layer(loaded(everything)).drop("_gold_timestamp")
    assert same_rows(stored_gold(spark, paths), want)


def test_replaced_keys_repair_a_half_replaced_table(spark, tmp_path):
    path, staging = str(tmp_path / "silver"), str(tmp_path / "staging")
    write_layer(loaded(bars(spark, [1, 2, 3])), path, "overwrite")
    batch = loaded(bars(spark, [20, 40], days=[1, 3]))
    replace_keys(spark, path, batch.select("symbol", "date"), batch, staging)
    delete_path(spark, f"{path}/date={day(1)}")  # as if the commit had stopped here
    replace_keys(spark, path, batch.select("symbol", "date"), batch, staging)
    assert column(read_layer(spark, path), "close") == [1.0, 20.0, 3.0, 40.0]
    empty = batch.where("false")
    replace_keys(spark, path, batch.select("symbol", "date"), empty, str(tmp_path / "gone"))
    assert column(read_layer(spark, path), "close") == [1.0, 3.0]
    everything = loaded(bars(spark, [1, 2, 3])).select("symbol", "date")
    replace_keys(spark, path, everything, empty, str(tmp_path / "all"))
    assert not path_exists(spark, f"{path}/date={day(0)}")
    replace_keys(spark, path, batch.select("symbol", "date"), batch, str(tmp_path / "again"))
    assert column(read_layer(spark, path), "close") == [20.0, 40.0]


@pytest.mark.parametrize("partition", ["date", "month"])
def test_incremental_takes_corrections_and_withdrawals(spark, tmp_path, partition):
    step = 1 if partition == "month" else 5
    days = range(0, 260, step)
    before = bars(spark, range(100, 100 + len(days)), "A", days).union(bars(spark, [5, 6, 7], "B", [0, 5, 200]))
    close = F.when(F.col("date") == F.lit(day(20)), 500.0).when(
        (F.col("date") == F.lit(day(5))), F.lit(None).cast("double")
    ).otherwise(F.col("close"))
    after = before.withColumn("close", close)
    full, inc = layer_paths(tmp_path / "full"), layer_paths(tmp_path / "inc")
    later = LOADED + dt.timedelta(days=1)
    jobs.run_full(spark, after, full, batch_ts=LOADED, partition=partition)
    jobs.run_full(spark, before, inc, batch_ts=LOADED, partition=partition)
    folder = "date=" + str(day(255)) if partition == "date" else "_month=2024-09-01"
    untouched = sorted((tmp_path / "inc" / "gold" / folder).glob("*.parquet"))
    for _ in range(2):  # the second run finds nothing new
        jobs.run_incremental(spark, after, inc, later, partition=partition)
    assert same_rows(stored_gold(spark, inc), stored_gold(spark, full))
    assert untouched == sorted((tmp_path / "inc" / "gold" / folder).glob("*.parquet"))
    assert read_layer(spark, inc["bronze"]).count() == before.count() + 3
    jobs.run_incremental(spark, before, inc, later + dt.timedelta(days=1), partition=partition)
    want = gold.gold_layer(loaded(before)).drop("_gold_timestamp")
    assert same_rows(stored_gold(spark, inc), want)


def test_incremental_keeps_undated_records_in_the_raw_layer_once(spark, tmp_path):
    paths = layer_paths(tmp_path)
    rows = bars(spark, [1, 2, 3])
    undated = rows.limit(1).withColumn("date", F.lit(None).cast("date"))
    jobs.run_full(spark, rows, paths, batch_ts=LOADED)
    for n in (1, 2):
        jobs.run_incremental(spark, rows.unionByName(undated), paths, LOADED + dt.timedelta(days=n))
    assert read_layer(spark, paths["bronze"]).count() == 4
    assert stored_gold(spark, paths).count() == 3


@pytest.mark.parametrize("partition", ["date", "month"])
def test_purge_of_the_stored_raw_layer(spark, tmp_path, partition):
    paths = layer_paths(tmp_path)
    for n, closes in enumerate(([1, 2, 3], [10, 2.5], [7])):
        jobs.run_bronze(bars(spark, closes), paths, LOADED + dt.timedelta(days=n), partition)
    jobs.purge_bronze(spark, paths, LOADED + dt.timedelta(days=2, hours=1), 24, partition=partition)
    left = read_layer(spark, paths["bronze"])
    assert sorted(r.close for r in left.collect()) == [2.5, 3.0, 7.0]


@pytest.mark.parametrize("partition", ["date", "month"])
def test_retention_drops_strictly_older_rows(spark, tmp_path, partition):
    path = str(tmp_path / "gold")
    rows = bars(spark, range(1, 100))
    write_layer(rows, path, "overwrite", partition)
    as_of = dt.date(2024, 4, 1)
    retention.cut_layer(spark, path, as_of, 30, partition)
    kept = read_layer(spark, path)
    assert kept.agg(F.min("date")).first()[0] == dt.date(2024, 3, 2)
    assert same_rows(kept, retention.retain_gold(rows, as_of))
    retention.cut_layer(spark, path, as_of, 30, partition)
    assert same_rows(read_layer(spark, path), kept)


def test_retention_refuses_to_starve_averages(spark, tmp_path):
    with pytest.raises(ValueError):
        retention.cut_layer(spark, str(tmp_path), "2024-04-01", 90, look_back=gold.LONG_DAYS)


def test_full_run_with_retention_keeps_whole_averages(spark, tmp_path):
    paths = layer_paths(tmp_path)
    rows = bars(spark, range(1, 301))
    jobs.run_full(
        spark, rows, paths, as_of=day(299), batch_ts=LOADED, silver_days=90, gold_days=30, partition="month"
    )
    assert column(stored_gold(spark, paths), "ma_200_day")[-1] == 200.5
    assert stored_gold(spark, paths).count() == 31
    assert read_layer(spark, paths["silver"]).count() == 91


TICKS = "ts timestamp, symbol string, price double, size bigint, event_id bigint"


def land(spark, folder, number, rows):
    """One file per call, so that a stream taking one file per trigger sees them in order."""
    spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(str(folder / f"n{number}"))


def tick_stream(spark, folder):
    stream = (
        spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True).parquet(str(folder))
    )
    return stream.withColumn("date", F.to_date("ts"))


def at(n, hour=10):
    return dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=n)


def test_messages_are_parsed_and_landed(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    good = '{"date":"2024-01-02","symbol":"A","open":1,"high":2,"low":1,"close":1.5,"volume":7}'
    bad = '{"date":"2024-01-02","symbol":"B","close":"much"}'
    spark.createDataFrame([(bytearray(m, "utf8"),) for m in (good, bad)], "value binary").write.parquet(
        str(source)
    )
    messages = spark.readStream.schema("value binary").parquet(str(source))
    start_bronze_append(parse_records(messages), out, str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(out)
    assert column(got, "close", "symbol") == [1.5, None]
    assert column(got, "_corrupt_record", "symbol") == [None, bad]


def test_stream_dedup_drops_copies_and_late_events(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    land(spark, source, 0, [(at(0), "A", 1.0, 1, 1), (at(0), "A", 1.0, 1, 1), (at(5), "A", 2.0, 1, 2)])
    start_bronze_append(dedup_stream(tick_stream(spark, source), ["event_id"]), out, check).awaitTermination()
    land(spark, source, 1, [(at(0), "A", 9.0, 1, 3), (at(5), "A", 2.0, 1, 2), (at(6), "A", 3.0, 1, 4)])
    start_bronze_append(dedup_stream(tick_stream(spark, source), ["event_id"]), out, check).awaitTermination()
    got = spark.read.parquet(out)
    assert column(got, "event_id", "event_id") == [1, 2, 4]
    assert "_ingestion_timestamp" in got.columns


def batch_ticks(spark, folder):
    return spark.read.schema(TICKS).option("recursiveFileLookup", True).parquet(str(folder)).withColumn(
        "date", F.to_date("ts")
    )


def spread_ticks(spark, source):
    land(spark, source, 0, [(at(0, 9), "A", 5.0, 1, 1), (at(0, 12), "A", 7.0, 2, 2), (at(1), "B", 3.0, 1, 3)])
    land(spark, source, 1, [(at(0, 8), "A", 4.0, 1, 4), (at(1, 11), "B", 2.0, 5, 5), (at(2), "A", 6.0, 1, 6)])
    land(spark, source, 2, [(at(2, 15), "A", 8.0, 1, 7), (at(3), "B", 9.0, 1, 8), (at(1, 23), "A", 6.5, 1, 9)])


def test_stream_bars_equal_batch_bars(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    spread_ticks(spark, source)
    stream = bars_from_stream(tick_stream(spark, source), ("ts", "event_id"), delay="30 days")
    start_bar_log(stream, out, str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3
    want = gold.daily_bars(batch_ticks(spark, source), ("ts", "event_id"))
    assert same_rows(read_bar_log(spark, out), want)
    silver_path = str(tmp_path / "silver")
    for _ in range(2):  # the second call finds no more than the last batch's states
        close_days(spark, out, silver_path, day(2), LOADED)
        clean = read_layer(spark, silver_path).select(*want.columns)
        assert same_rows(clean, want.where(F.col("date") < F.lit(day(2))))
        left = read_bar_log(spark, out).where(F.col("date") >= F.lit(day(2)))
        assert same_rows(left, want.where(F.col("date") >= F.lit(day(2))))
        assert not path_exists(spark, f"{out}/batch_id=0")


def as_versions(ticks):
    price = F.col("price")
    return ticks.select(
        "date", "symbol", *[price.alias(c) for c in ("open", "high", "low", "close", "adjusted_close")],
        F.col("size").alias("volume"), F.col("ts").alias("_ingestion_timestamp"),
        F.to_date("ts").alias("_ingestion_date"),
    )


@pytest.mark.parametrize("partition", ["date", "month"])
def test_stream_upsert_equals_batch(spark, tmp_path, partition):
    source, out = tmp_path / "in", str(tmp_path / "out")
    spread_ticks(spark, source)
    start_silver_upsert(
        as_versions(tick_stream(spark, source)), out, str(tmp_path / "check"), str(tmp_path / "stage"),
        partition=partition,
    ).awaitTermination()
    want = silver.silver_layer(as_versions(batch_ticks(spark, source)))
    drop = "_silver_transformation_timestamp"
    assert same_rows(read_layer(spark, out).drop(drop), want.drop(drop))
    assert path_exists(spark, str(tmp_path / "stage" / "2"))
    assert not path_exists(spark, str(tmp_path / "stage" / "1"))


@pytest.mark.parametrize("partition", ["date", "month"])
def test_invalid_newest_version_leaves_the_streamed_layers(spark, tmp_path, partition):
    source, paths = tmp_path / "in", layer_paths(tmp_path)
    land(spark, source, 0, [(at(0, 9), "A", 5.0, 1, 1), (at(1, 9), "A", 6.0, 1, 2), (at(2, 9), "A", 7.0, 1, 3)])
    land(spark, source, 1, [(at(1, 12), "A", None, 1, 4)])  # withdraws the second day
    land(spark, source, 2, [(at(1, 10), "A", 6.5, 1, 5)])  # late and older: does not bring it back
    start_gold_refresh(
        as_versions(tick_stream(spark, source)), paths, str(tmp_path / "check"), str(tmp_path / "stage"),
        partition=partition,
    ).awaitTermination()
    want = silver.silver_layer(as_versions(batch_ticks(spark, source)))
    assert column(read_layer(spark, paths["silver"]), "close") == [5.0, 7.0]
    assert same_rows(stored_gold(spark, paths), gold.gold_layer(want).drop("_gold_timestamp"))


def test_stream_gold_equals_batch(spark, tmp_path):
    source, paths = tmp_path / "in", layer_paths(tmp_path)
    spread_ticks(spark, source)
    start_gold_refresh(
        as_versions(tick_stream(spark, source)), paths, str(tmp_path / "check"), str(tmp_path / "stage")
    ).awaitTermination()
    want = gold.gold_layer(silver.silver_layer(as_versions(batch_ticks(spark, source))))
    assert same_rows(stored_gold(spark, paths), want.drop("_gold_timestamp"))



@pytest.mark.parametrize("since", [None, "2024-02-02"])
def test_full_run_removes_days_that_fell_away(spark, tmp_path, since):
    paths = layer_paths(tmp_path)
    sample = sample_bars(spark, 2, 8, end="2024-02-08").withColumn("symbol", F.col("symbol"))
    jobs.run_full(spark, sample, paths, batch_ts=LOADED)
    spoiled = sample.where("date = '2024-02-05'").withColumn("close", F.lit(None).cast("double"))
    jobs.run_bronze(spoiled, paths, LOADED + dt.timedelta(days=1))
    jobs.run_silver(spark, paths)
    jobs.run_gold(spark, paths, since=since)
    days = [r.date.day for r in stored_gold(spark, paths).select("date").distinct().orderBy("date").collect()]
    assert days == [1, 2, 3, 4, 6, 7, 8]


def test_refresh_follows_the_touched_days(spark, tmp_path, monkeypatch):
    """Two corrected days of 700 recompute some 400 rows, read no other month, and take six writes."""
    rows = bars(spark, range(1, 1201))
    paths = layer_paths(tmp_path)
    jobs.run_full(spark, rows, paths, batch_ts=LOADED, partition="month")
    touched = F.col("date").isin(day(20), day(900))
    corrected = rows.withColumn("close", F.when(touched, F.col("close") + 5).otherwise(F.col("close")))
    seen, writes = {}, []
    island_rows, write = jobs.gold_islands, layers.write_layer

    def counted(recent, *args):
        out = island_rows(recent, *args)
        seen.update(read=recent.count(), rows=out.count(), months=recent.select(F.trunc("date", "month")).distinct().count())
        return out

    def noted(df, path, *args, **kwargs):
        writes.append(path)
        return write(df, path, *args, **kwargs)

    monkeypatch.setattr(jobs, "gold_islands", counted)
    for module in (jobs, layers):
        monkeypatch.setattr(module, "write_layer", noted)
    jobs.run_incremental(spark, corrected, paths, LOADED + dt.timedelta(days=1), partition="month")
    assert seen["rows"] == 400 and seen["read"] <= 399 + 220 and seen["months"] <= 23
    assert len(writes) == 5  # and the staged batch
    want = gold.gold_layer(loaded(corrected)).drop("_gold_timestamp")
    assert same_rows(stored_gold(spark, paths), want)


def test_retried_load_repeats_no_reject(spark, tmp_path):
    paths, rows = layer_paths(tmp_path), bars(spark, [1, 2, 3, 3])
    rows = rows.withColumn("date", F.when(F.col("close") < 3, F.col("date"))).withColumn("open", F.when(F.col("close") < 3, F.col("open")))
    rows = rows.withColumn("symbol", F.when(F.col("close") != 2, F.col("symbol")))
    for _ in range(2):
        jobs.run_bronze(rows, paths, LOADED)
    assert read_layer(spark, paths["bronze"]).count() == 4
    jobs.run_bronze(rows, paths, LOADED + dt.timedelta(days=1))
    assert read_layer(spark, paths["bronze"]).count() == 8


def test_landed_files_are_read_once(spark, tmp_path, monkeypatch):
    folder, raw = tmp_path / "landed files", str(tmp_path / "raw")
    folder.mkdir()

    def run():
        start_landing(spark, str(folder), raw, str(tmp_path / "log"), str(tmp_path / "staging"), partition="month").awaitTermination()

    def held():
        return sorted((str(r.date), r.symbol, r.close) for r in read_layer(spark, raw).collect()) if path_exists(spark, raw) else []

    (folder / "empty.csv").write_text("")
    run()
    assert held() == []
    (folder / "a.csv").write_text("date,symbol,close\n2024-01-01,A,1\n2024-01-02,A,2\n")
    (folder / "b.csv").write_text("\nsymbol,close,date,extra\nB,3,2024-01-01,x\n")
    run()
    first = [("2024-01-01", "A", 1.0), ("2024-01-01", "B", 3.0), ("2024-01-02", "A", 2.0)]
    assert held() == first
    (folder / "c.csv").write_text("date,symbol,close\n2024-01-03,C,4\n")

    def interrupted(*args):
        append_once(*args)
        raise RuntimeError("driver lost")

    append_once = landing.append_once
    with monkeypatch.context() as patch:
        patch.setattr(landing, "append_once", interrupted)
        with pytest.raises(Exception):
            run()
    run()
    run()
    assert held() == [*first, ("2024-01-03", "C", 4.0)]


def test_stored_profile_equals_a_profile_of_the_rows(spark, tmp_path):
    layer, stored = str(tmp_path / "layer"), str(tmp_path / "sketches")
    rows = bars(spark, range(1, 100)).withColumn("close", F.when(F.col("close") % 7 != 0, F.col("close")))
    undated = rows.limit(2).withColumn("date", F.lit(None).cast("date"))
    write_layer(rows.union(undated), layer, "overwrite", "month")
    jobs.refresh_profile(spark, layer, stored)

    def same(start=None, end=None):
        got = quality.profile_range(read_layer(spark, stored), start, end).drop("approx_quartiles", "approx_distinct")
        held = read_layer(spark, layer, start, end)
        want = quality.profile_columns(held, [c for c in held.columns if c != "date"])
        return same_rows(got, want.drop("approx_quartiles", "approx_distinct"))

    assert same() and same(day(3), day(50)) and same(day(300), day(400))
    touched = rows.where(F.col("date").isin(day(40), day(70))).select("date")
    write_layer(rows.where(F.col("date").between(day(31), day(59))).withColumn("volume", F.lit(5).cast("bigint")), layer, "replace", "month")
    delete_path(spark, f"{layer}/_month=2024-03-01")
    jobs.refresh_profile(spark, layer, stored, touched)
    assert same() and same(day(20), day(90))
    once = quality.profile_range(read_layer(spark, stored), columns=["close"]).first()
    assert once.column == "close" and abs(once.approx_distinct - 58) < 3


def test_stream_over_a_batch_layer_keeps_withdrawn_keys_out(spark, tmp_path):
    clean, raw = str(tmp_path / "silver"), loaded(bars(spark, [1, 2, 3]), LOADED)
    bad = loaded(bars(spark, [9], days=[1]).withColumn("close", F.lit(None).cast("double")), LOADED + dt.timedelta(days=1))
    raw = raw.unionByName(bad)
    write_layer(silver.silver_layer(raw), clean, "overwrite", "month")
    older = loaded(bars(spark, [70, 80], days=[1, 2]), LOADED - dt.timedelta(days=1))
    newer = loaded(bars(spark, [90], days=[0]), LOADED + dt.timedelta(days=2))
    folder = str(tmp_path / "late")
    for late in (older, newer):
        late.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(late.schema).parquet(folder)
        start_silver_upsert(stream, clean, str(tmp_path / "log"), str(tmp_path / "st"), partition="month", raw=raw).awaitTermination()
    assert column(read_layer(spark, clean), "close") == [90.0, 3.0]
