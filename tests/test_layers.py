"""Schemas, files, raw and clean layer."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from barlake.operators import bronze, silver
from barlake.schemas import BRONZE, GOLD, OHLC, SILVER, SYMBOL_META, conform
from barlake.sources.files import absent_symbols, read_bars, readable, rejected, sample_bars, union_sources
from barlake.sources.layers import read_layer, write_layer
from barlake.sources.scratch import scratch_path
from util import LOADED, bars, column, day, loaded, one, same_rows, versions

EARLY = dt.datetime(2024, 6, 1, 6, 0)
LATE = dt.datetime(2024, 6, 2, 6, 0)


def test_declared_schemas():
    assert OHLC.names == [
        "date", "symbol", "open", "high", "low", "close", "adjusted_close", "volume"
    ]
    assert SYMBOL_META.names == ["symbol", "company_name", "sector", "market_cap", "updated_at"]
    assert len(BRONZE.names) == 10 and len(SILVER.names) == 12 and len(GOLD.names) == 12


def test_conform_goes_by_name_and_keeps_rows(spark):
    raw = spark.createDataFrame(
        [("2024-01-01", "12.5", "x", "A", 7)], "Date string, Close string, open string, SYMBOL string, pe int"
    )
    row = one(conform(raw, OHLC, keep_extra=True))
    assert row["date"] == day(0) and row["close"] == 12.5 and row["symbol"] == "A"
    assert row["open"] is None and row["volume"] is None and row["pe"] == 7
    assert "pe" not in conform(raw, OHLC).columns


def test_sample_bars_shape_and_relations(spark):
    df = sample_bars(spark, 5, 20, end="2024-03-31", seed=3)
    assert df.count() == 100
    assert df.select("symbol").distinct().count() == 5
    last = df.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    assert one(last) == {"a": dt.date(2024, 3, 12), "b": dt.date(2024, 3, 31)}
    broken = df.where(
        (F.abs(F.col("open") - F.col("close") * 0.99) > 1e-9)
        | (F.abs(F.col("high") - F.col("close") * 1.05) > 1e-9)
        | (F.abs(F.col("low") - F.col("close") * 0.95) > 1e-9)
        | ~F.col("volume").between(1_000_000, 9_999_999)
    )
    assert broken.isEmpty()
    assert same_rows(df, sample_bars(spark, 5, 20, end="2024-03-31", seed=3))


def test_read_bars_csv_keeps_broken_records_and_filters(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "Date,Open,High,Low,Close,Adj Close,Volume,Note,Symbol\n"
        "2024-01-01,1,2,0.5,1.5,1.25,100,n1,A\n"
        "2024-01-02,1,2,0.5,oops,1.5,100,n2,A\n"
        "2024-01-02,1,2,0.5,1.7,1.5,100,n3,B\n"
        "2022-01-02,1,2,0.5,1.9,1.5,100,n4,A\n"
    )
    rename = {"Adj Close": "adjusted_close"}
    df = read_bars(spark, str(tmp_path), symbols=["A"], start="2023-07-01", rename=rename)
    assert column(df, "close") == [1.5, None]
    assert column(df, "adjusted_close")[0] == 1.25 and column(df, "Note") == ["n1", "n2"]
    assert "oops" in column(df, "_corrupt_record")[1]
    assert column(absent_symbols(df, ["A", "B", "C"]), "symbol", "symbol") == ["B", "C"]
    assert read_bars(spark, str(tmp_path), rename=rename).count() == 4
    assert read_bars(spark, str(tmp_path), symbols=["C"], rename=rename).isEmpty()


def test_read_bars_reads_each_file_by_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,symbol,close\n2024-01-01,A,1\n")
    (tmp_path / "b.csv").write_text("symbol,date,close,pe\nB,2024-01-01,2,7\nC,never,3,8\n,2024-01-02,4,9\n")
    df = read_bars(spark, str(tmp_path), symbols=["A", "B"], start="2024-01-01")
    assert sorted((r.symbol, r.close, r.pe) for r in readable(df).collect()) == [("A", 1.0, None), ("B", 2.0, "7")]
    assert sorted(r.close for r in rejected(df).collect()) == [3.0, 4.0]


def test_read_bars_json(spark, tmp_path):
    path = str(tmp_path / "json")
    bars(spark, [1, 2, 3]).write.json(path)
    assert column(read_bars(spark, path, "json"), "close") == [1.0, 2.0, 3.0]


def test_union_keeps_duplicates_and_fills_columns(spark):
    a = bars(spark, [1, 2])
    both = union_sources([a, a.drop("volume"), a.withColumn("pe", F.lit(1))])
    assert both.count() == 6
    assert both.where("volume IS NULL").count() == 2 and both.where("pe = 1").count() == 2


@pytest.mark.parametrize("partition", ["date", "month"])
def test_write_and_read_layer(spark, tmp_path, partition):
    path = str(tmp_path / "layer")
    rows = bars(spark, range(1, 61)).union(bars(spark, range(1, 61), "OTHER"))
    written = write_layer(rows, path, "append", partition)
    assert written == {"rows": 120, "first_date": day(0), "last_date": day(59)}
    back = read_layer(spark, path)
    assert same_rows(back, rows)
    some = read_layer(spark, path, "2024-01-10", day(39), {"symbol": "OTHER"})
    assert column(some, "date") == [day(n) for n in range(9, 40)]
    assert read_layer(spark, path, equal={"symbol": None}).isEmpty()
    assert read_layer(spark, path, schema=OHLC).columns == OHLC.names
    with pytest.raises(ValueError):
        read_layer(spark, path, start="not a date")


def test_date_bounds_prune_month_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(bars(spark, range(1, 100)), path, "overwrite", "month")
    plan = read_layer(spark, path, day(40), day(50))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan


def test_replace_touches_only_given_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    write_layer(bars(spark, [1, 2, 3]), path, "overwrite")
    write_layer(bars(spark, [20], days=[1]), path, "replace")
    assert column(read_layer(spark, path), "close") == [1.0, 20.0, 3.0]


def test_added_column_survives_append(spark, tmp_path):
    path = str(tmp_path / "bronze")
    bronze.append_bronze(bars(spark, [1, 2]), path, LOADED)
    bronze.append_bronze(
        bars(spark, [3], days=[2]).withColumn("pe_ratio", F.lit(9.5)), path, LOADED
    )
    assert column(read_layer(spark, path, merge_schema=True), "pe_ratio") == [None, None, 9.5]


def test_bronze_metadata_and_lookups(spark, tmp_path):
    path = str(tmp_path / "bronze")
    sample = sample_bars(spark, 3, 5, end="2024-01-05")
    assert bronze.append_bronze(sample, path, LOADED)["rows"] == 15
    stored = bronze.read_bronze(spark, path)
    assert one(stored.select("_ingestion_timestamp", "_ingestion_date").distinct()) == {
        "_ingestion_timestamp": LOADED, "_ingestion_date": LOADED.date()
    }
    assert one(bronze.latest_date(stored)) == {"latest_date": dt.date(2024, 1, 5)}
    assert bronze.distinct_symbols(stored).count() == 3
    assert one(bronze.latest_date(stored.where("false"))) == {"latest_date": None}
    assert bronze.read_bronze(spark, path, {"symbol": "STOCK_001.NS"}).count() == 5


def test_latest_version_breaks_ties_with_further_columns(spark):
    rows = versions(spark, [("A", 0, 1.0, EARLY, 1), ("A", 0, 2.0, LATE, 1), ("A", 0, 3.0, LATE, 2)])
    assert one(silver.latest_version(rows, newest=("_ingestion_timestamp", "seq")))["close"] == 3.0


def test_duplicates_are_removed(spark):
    sample = sample_bars(spark, 2, 5, end="2024-01-05")
    again = sample.where("symbol = 'STOCK_000.NS'")
    clean = silver.silver_layer(loaded(sample.unionByName(again)))
    assert clean.count() == 10
    assert clean.select("symbol", "date").distinct().count() == 10
    assert set(clean.columns) == set(SILVER.names)


def test_a_hot_key_sends_one_row_per_input_partition(spark):
    rows = spark.range(0, 30000, 1, 6).select(
        F.when(F.col("id") < 29990, "HOT").otherwise(F.concat(F.lit("S"), "id")).alias("symbol"),
        F.lit(day(0)).alias("date"),
        F.lit(EARLY).alias("_ingestion_timestamp"),
        F.col("id").alias("seq"),
    )
    latest = silver.latest_version(rows, newest=("_ingestion_timestamp", "seq"))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert one(latest.where("symbol = 'HOT'"))["seq"] == 29989
    assert latest.count() == 11


def test_cast_and_gap_filter(spark):
    raw = spark.createDataFrame(
        [(day(0), "A", "x", "5"), (day(1), "A", "NaN", "x"), (day(2), "A", "3.5", "7"), (None, "A", "1", "1"),
         (day(3), None, "1", "1")],
        "date date, symbol string, close string, volume string",
    )
    typed = silver.cast_prices(raw)
    closes = [r.close for r in typed.where("symbol = 'A' AND date IS NOT NULL").orderBy("date").collect()]
    assert closes[0] is None and math.isnan(closes[1]) and closes[2] == 3.5
    assert one(silver.drop_missing(typed)) == {"date": day(2), "symbol": "A", "close": 3.5, "volume": 7}


def test_null_rows_flags_two_of_three(spark):
    rows = spark.createDataFrame(
        [("TEST", 100.0), ("TEST", None), (None, 102.0)], "symbol string, close double"
    )
    assert silver.null_rows(rows).count() == 2
    assert silver.null_rows(rows.union(rows.selectExpr("'N'", "double('NaN')"))).count() == 7 - 2


def test_quality_flag_names_failed_rules(spark):
    rows = spark.createDataFrame(
        [
            (day(0), "A", 10.0, 11.0, 9.0, 10.0, 5),
            (day(1), "A", 12.0, 11.0, 9.0, 8.0, -1),
            (day(2), "A", None, None, None, 1.0, None),
            (day(3), "A", 10.0, 11.0, 9.0, None, 5),
        ],
        "date date, symbol string, open double, high double, low double, close double, volume bigint",
    )
    flagged = silver.quality_flags(rows)
    assert column(flagged, "_quality_check_passed") == [True, False, True, False]
    assert column(flagged, "_failed_rules")[1] == [
        "open_out_of_range", "close_out_of_range", "volume_negative"
    ]
    assert column(flagged, "_failed_rules")[3] == ["close_missing"]


def test_as_of_and_purge(spark):
    rows = versions(
        spark,
        [
            ("A", 0, 1.0, dt.datetime(2024, 6, 1), 0),
            ("A", 0, 2.0, dt.datetime(2024, 6, 2), 0),
            ("A", 0, 3.0, dt.datetime(2024, 6, 10), 0),
            ("B", 0, 4.0, dt.datetime(2024, 6, 1), 0),
            ("B", 0, 5.0, dt.datetime(2024, 6, 2), 0),
        ],
    )
    then = bronze.bronze_as_of(rows, dt.datetime(2024, 6, 2, 12))
    assert column(then, "close", "symbol") == [2.0, 5.0]
    kept = bronze.purge_superseded(rows, dt.datetime(2024, 6, 10, 1), 24)
    assert column(kept, "close", "close") == [3.0, 5.0]
    kept = bronze.purge_superseded(rows, dt.datetime(2024, 6, 10, 1), 24 * 30)
    assert kept.count() == 5


def test_upsert_and_new_rows(spark):
    old = versions(spark, [("A", 0, 1.0, EARLY, 0), ("A", 1, 2.0, LATE, 0)])
    batch = versions(spark, [("A", 0, 9.0, LATE, 0), ("A", 1, 8.0, EARLY, 0), ("A", 2, 7.0, EARLY, 0)])
    assert column(silver.upsert_latest(old, batch), "close") == [9.0, 2.0, 7.0]
    assert column(silver.new_rows(old, batch), "close") == [7.0]
    assert silver.new_rows(old, batch.where("false")).isEmpty()
    assert same_rows(silver.new_rows(old.where("false"), batch), batch)


def test_scratch_is_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_purge_keeps_rows_without_load_time(spark):
    rows = bars(spark, [1, 2]).withColumn("_ingestion_timestamp", F.lit(None).cast("timestamp"))
    assert bronze.purge_superseded(rows, dt.datetime(2024, 6, 10), 24).count() == 2


def test_newest_version_is_total(spark):
    rows = bars(spark, [1]).union(bars(spark, [3])).union(bars(spark, [2]))
    rows = rows.withColumn("_ingestion_timestamp", F.lit(dt.datetime(2024, 6, 1)))
    for n in (1, 3):
        assert column(silver.latest_version(rows.repartition(n)), "close") == [3.0]
