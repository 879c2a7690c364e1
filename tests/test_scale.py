"""Hot symbols: the plan shapes that keep them apart, and right results on skewed data."""

import random

from pyspark.sql import functions as F

from barlake.operators import gold, quality, sector, serving
from barlake.schemas import OHLC
from barlake.sources.layers import write_layer
from util import bars, day, loaded, one, same_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed_ticks(spark):
    """Half of 60,000 ticks belong to one symbol, a third of them to one of its days."""
    n = F.col("id")
    number = F.when(n % 6 < 2, 0).otherwise(n % 30).cast("int")
    return spark.range(0, 60_000, 1, 6).select(
        F.when(n % 2 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("S"), n % 50)).alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), number).alias("date"),
        (F.abs(F.xxhash64("id")) % 10_000 / 100).alias("price"),
        F.lit(1).cast("bigint").alias("size"),
        n.alias("a"),
        (n % 7).alias("b"),
    )


def test_hot_symbol_is_reduced_before_the_shuffle(spark):
    ticks = skewed_ticks(spark)
    by_sort = gold.daily_bars(ticks, ("a", "b"))
    by_hash = gold.daily_bars(ticks, ("a",))
    for df, kind in ((by_sort, "SortAggregate"), (by_hash, "HashAggregate")):
        text = plan(df)
        assert text.count("Exchange") == 1
        assert "partial_max" in text.split("Exchange")[1] and kind in text.split("Exchange")[1]
    assert by_sort.exceptAll(by_hash).isEmpty()

    rows = [r.asDict() for r in ticks.collect()]
    groups = {}
    for r in rows:
        groups.setdefault((r["date"], r["symbol"]), []).append(r)
    got = {(r.date, r.symbol): r for r in by_sort.collect()}
    assert got.keys() == groups.keys()
    for key, members in groups.items():
        members.sort(key=lambda r: r["a"])
        prices = [m["price"] for m in members]
        bar = got[key]
        assert (bar.open, bar.close) == (prices[0], prices[-1])
        assert (bar.high, bar.low, bar.volume) == (max(prices), min(prices), len(prices))


def test_a_hot_date_is_written_as_several_files(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(0, 300_000, 1, 8).select(
        F.lit("2024-01-01").cast("date").alias("date"),
        F.concat(F.lit("S"), F.col("id")).alias("symbol"),
        F.rand(1).alias("close"),
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "256k")
    try:
        assert write_layer(rows, path, "append")["rows"] == 300_000
    finally:
        spark.conf.set(name, before)
    assert len(list((tmp_path / "hot" / "date=2024-01-01").glob("*.parquet"))) > 3


def test_tail_equals_full_run_on_random_gaps(spark):
    """Forty symbols, a third of all bars in one, gaps from a day to over a year."""
    dice = random.Random(11)
    rows, touched = [], []
    for number in range(40):
        symbol, at = f"S{number}", dice.randrange(50)
        for _ in range(dice.randrange(1, 40) if number else 700):
            rows.append((day(at), symbol, *[round(dice.uniform(1, 99), 2)] * 5, 1))
            at += 1 if number == 0 else dice.choice([1, 1, 2, 3, 30, 90, 210, 400])
        touched.append((symbol, rows[-dice.randrange(1, 8)][0] if number == 0 else day(at // 2)))
    table = loaded(spark.createDataFrame(rows, OHLC))
    touched = spark.createDataFrame(touched, "symbol string, date date")
    first = touched.withColumnRenamed("date", "_from")
    full = gold.gold_layer(table).drop("_gold_timestamp")
    before = gold.gold_layer(table.join(touched, ["symbol", "date"], "left_anti")).drop("_gold_timestamp")
    changed = full.exceptAll(before).select("symbol", "date")
    islands = gold.influence(table, touched)
    for idle in (None, gold.idle_islands(table, islands)):
        tail = gold.gold_islands(table, table, islands, idle).drop("_gold_timestamp")
        assert tail.exceptAll(full).isEmpty() and tail.count() < full.join(first, "symbol").where("date >= _from").count()
        assert changed.join(tail, ["symbol", "date"], "left_anti").isEmpty()


def test_top_per_day_limits_each_input_partition(spark):
    rows = gold.gold_layer(loaded(bars(spark, [1, 2, 3])))
    assert plan(serving.top_gainers_per_day(rows, 3)).count("WindowGroupLimit") == 2


def test_rollup_joins_one_row_per_symbol(spark):
    data = gold.daily_returns(bars(spark, range(1, 30)))
    dim = spark.createDataFrame([("TEST", "Tech")], "symbol string, sector string")
    text = plan(sector.sector_rollup(data, dim))
    assert text.index("Expand") < text.index("Join") < text.index("partial_count(1)")


def test_profile_merges_sketches_in_two_levels(spark):
    text = plan(quality.profile_columns(skewed_ticks(spark)))
    assert text.count("Exchange SinglePartition") == 1 and text.count("Exchange hashpartitioning") == 1
    assert one(quality.profile_columns(skewed_ticks(spark), ["price"]))["rows"] == 60_000


def test_no_cross_joins_and_no_broadcast_hints(spark):
    data = bars(spark, range(1, 30))
    meta = spark.createDataFrame(
        [("TEST", "T", "Tech", "1", "2024-01-01")],
        "symbol string, company_name string, sector string, market_cap string, updated_at string",
    )
    returns = gold.daily_returns(data)
    for df in (
        sector.sector_daily(returns, sector.symbol_dim(meta)),
        sector.asof_metadata(data, meta),
        quality.missing_days(data),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
