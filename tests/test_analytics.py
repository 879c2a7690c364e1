"""Analytics layer, questions, sectors, quality."""

import json
import statistics
from fractions import Fraction

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from barlake.functions import grouped_median
from barlake.operators import gold, quality, sector, serving
from barlake.plans.sql import sql_over_layers
from barlake.schemas import GOLD, OHLC
from barlake.sources.files import sample_bars
from util import bars, column, day, loaded, one, same_rows


def test_daily_returns(spark):
    got = column(gold.daily_returns(bars(spark, [100, 102, 101, 103, 105])), "daily_return_pct")
    assert got[0] is None
    assert got[1:] == pytest.approx([2.0, -0.9803921568, 1.9801980198, 1.9417475728])


def test_zero_previous_close_gives_no_return(spark):
    assert column(gold.daily_returns(bars(spark, [0, 5])), "daily_return_pct") == [None, None]


@pytest.mark.parametrize("frame", ["calendar", "rows"])
@pytest.mark.parametrize("average_as", [None, "decimal(8,2)"])
def test_moving_averages_over_300_days(spark, frame, average_as):
    df = gold.moving_averages(bars(spark, range(1, 301)), frame, average_as)
    assert column(df, "ma_50")[-1] == 275.5 and column(df, "ma_200")[-1] == 200.5
    assert column(df, "ma_50")[0] == 1.0


def test_calendar_and_row_frames_differ_over_gaps(spark):
    thin = bars(spark, range(1, 151), days=range(0, 300, 2))
    by_calendar = column(gold.moving_averages(thin, "calendar"), "ma_50")[-1]
    by_rows = column(gold.moving_averages(thin, "rows"), "ma_50")[-1]
    assert by_calendar == statistics.mean(range(126, 151))
    assert by_rows == statistics.mean(range(101, 151))
    with pytest.raises(ValueError):
        gold.moving_averages(thin, "weekly")


def test_min_periods(spark):
    df = gold.moving_averages(bars(spark, [1, 2, 3]), days=(3,), min_periods=3)
    assert column(df, "ma_3") == [None, None, 2.0]


def test_volatility(spark):
    closes = [100, 102, 101, 103, 105]
    df = gold.volatility(gold.daily_returns(bars(spark, closes)))
    got = column(df, "volatility_30d")
    returns = column(df, "daily_return_pct")[1:]
    assert got[:2] == [None, None]
    assert got[-1] == pytest.approx(statistics.stdev(returns))


def test_daily_bars_first_and_last(spark):
    ticks = spark.createDataFrame(
        [(day(0), "A", 1, 1, 5.0, 2.0), (day(0), "A", 1, 2, 9.0, 1.0), (day(0), "A", 2, 1, 4.0, 1.0)],
        "date date, symbol string, a int, b int, price double, size double",
    )
    want = {"date": day(0), "symbol": "A", "open": 5.0, "high": 9.0, "low": 4.0, "close": 4.0,
            "adjusted_close": 4.0, "volume": 4}
    assert one(gold.daily_bars(ticks, ("a", "b"))) == want
    single = ticks.withColumn("c", F.col("a") * 10 + F.col("b"))
    assert one(gold.daily_bars(single, ("c",))) == want
    assert one(gold.daily_bars(single, ("c",), size=None))["volume"] == 3


def test_gold_layer_columns_and_one_shuffle(spark):
    df = gold.gold_layer(loaded(bars(spark, range(1, 40))))
    assert set(df.columns) == set(GOLD.names)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert df.count() == 39


@pytest.mark.parametrize("frame", ["calendar", "rows"])
def test_gold_since_equals_the_end_of_a_full_run(spark, frame):
    silver = loaded(
        bars(spark, range(100, 420), "A").union(
            bars(spark, [5, 9, 7, 8, 6], "GAP", days=[0, 3, 300, 301, 310])
        )
    )
    full = gold.gold_layer(silver, frame).where(F.col("date") >= F.lit(day(295)))
    since = gold.gold_since(silver, day(295), frame)
    assert same_rows(since.drop("_gold_timestamp"), full.drop("_gold_timestamp"))
    assert since.count() == 28


@pytest.mark.parametrize("frame", ["calendar", "rows"])
def test_gold_tail_equals_full_run(spark, frame):
    silver = loaded(
        bars(spark, range(100, 420), "A")
        .union(bars(spark, [5, 9, 7, 8, 6], "GAP", days=[0, 3, 400, 401, 410]))
        .union(bars(spark, range(10, 60), "SAME"))
    )
    touched = spark.createDataFrame(
        [("A", day(300)), ("A", day(310)), ("GAP", day(400))], "symbol string, date date"
    )
    full = gold.gold_layer(silver, frame).where(
        f"(symbol = 'A' AND date >= date'{day(300)}') OR (symbol = 'GAP' AND date >= date'{day(400)}')"
    )
    islands = gold.influence(silver, touched)
    assert column(gold.idle_islands(silver, islands), "symbol", "symbol") == ["GAP"]
    tails = [gold.gold_tail(silver, touched, frame)]
    if frame == "calendar":
        recent = silver.where(" OR ".join(f"date BETWEEN date'{a}' AND date'{b}'" for a, b in gold.dates_read(islands)))
        tails.append(gold.gold_islands(recent, silver, islands, gold.idle_islands(recent, islands)))
    for tail in tails:
        assert same_rows(tail.drop("_gold_timestamp"), full.drop("_gold_timestamp"))
        assert tail.count() == 23


def test_islands_follow_the_touched_dates(spark):
    """Two touched days of 2,500 cost what each of them reaches."""
    silver = loaded(bars(spark, range(1, 2501), "A").union(bars(spark, [3, 4, 5], "B", days=[0, 900, 1000])))
    touched = spark.createDataFrame([("A", day(5)), ("A", day(2400)), ("B", day(0))], "symbol string, date date")
    islands = {tuple(r) for r in gold.influence(silver, touched).collect()}
    assert islands == {
        ("A", day(5), day(204)), ("A", day(2400), day(2599)), ("B", day(0), day(199)), ("B", day(900), day(929)),
    }
    tail = gold.gold_tail(silver, touched)
    assert tail.count() == 200 + 100 + 2
    full = gold.gold_layer(silver).join(tail.select("symbol", "date"), ["symbol", "date"], "left_semi")
    assert same_rows(tail.drop("_gold_timestamp"), full.drop("_gold_timestamp"))


def test_ranges_that_meet_are_merged(spark):
    rows = [("A", 0, 3), ("A", 4, 5), ("A", 7, 9), ("A", 8, 8), ("B", 1, 1), ("B", 0, 9), (None, 2, 3)]
    ranges = spark.createDataFrame([(s, day(a), day(b)) for s, a, b in rows], "symbol string, first date, last date")
    got = {tuple(r) for r in gold.merged_ranges(ranges, ("symbol",)).collect()}
    assert got == {("A", day(0), day(5)), ("A", day(7), day(9)), ("B", day(0), day(9)), (None, day(2), day(3))}


def test_means_are_exact_and_use_running_sums(spark):
    closes = [0.1, 0.2, 0.3, 1e9, 0.1] * 60
    rows = gold.moving_averages(loaded(bars(spark, closes)), days=(3,))
    got = column(rows, "ma_3")
    want = [float(sum(map(Fraction, map(str, closes[max(0, i - 2) : i + 1])))) / min(i + 1, 3) for i in range(300)]
    assert got == want
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "unboundedpreceding" in plan.lower() and plan.count("Exchange hashpartitioning") == 1
    odd = bars(spark, [1, 2, 3, 4]).withColumn("close", F.when(F.col("close") == 2, F.lit(float("nan"))).otherwise(F.col("close")))
    assert column(gold.moving_averages(odd, "rows", days=(2,)), "ma_2") == [1.0, 1.0, 3.0, 3.5]
    assert column(gold.moving_averages(odd, days=(2,), min_periods=2), "ma_2") == [None, None, None, 3.5]


def test_features(spark):
    df = gold.price_momentum(gold.lag_features(bars(spark, [10, 11, 12, 13, 14, 15]), (1, 5)))
    assert column(df, "close_lag_1") == [None, 10, 11, 12, 13, 14]
    assert column(df, "close_lag_5")[-1] == 10
    assert column(df, "price_momentum_5d")[-1] == 0.5


def gold_rows(spark):
    data = bars(spark, [100, 110, 120], "UP").union(bars(spark, [100, 90, 80], "DOWN"))
    data = data.union(bars(spark, [50, 50.5], "FLAT")).union(bars(spark, [7], "NEW", days=[2]))
    return gold.gold_layer(loaded(data))


def test_history(spark):
    df = serving.stock_history(gold_rows(spark), "UP", limit=2, as_of=day(2))
    assert [r.daily_close for r in df.collect()] == [120.0, 110.0]
    assert serving.stock_history(gold_rows(spark), "UP", day(0), day(1)).count() == 2
    for bad in (0, -1):
        with pytest.raises(ValueError):
            serving.stock_history(gold_rows(spark), "UP", limit=bad)


def test_performance(spark):
    got = serving.stock_performance(gold_rows(spark), 30, 3, day(2)).collect()
    assert [(r.symbol, round(r.return_pct, 6)) for r in got] == [("UP", 20.0), ("FLAT", 1.0), ("NEW", 0.0)]
    with pytest.raises(ValueError):
        serving.stock_performance(gold_rows(spark), 0)


def test_gainers(spark):
    got = serving.top_gainers(gold_rows(spark)).collect()
    assert [r.symbol for r in got] == ["UP", "DOWN", "NEW"]  # NEW has no return: last
    per_day = serving.top_gainers_per_day(gold_rows(spark), 1)
    assert column(per_day.where(F.col("date") > F.lit(day(0))), "symbol") == ["UP", "UP"]


def test_report_and_means(spark):
    report = serving.gold_report(gold_rows(spark), "DOWN", day(1))
    assert [r.daily_close for r in report.collect()] == [80.0, 90.0]
    means = {r.symbol: r.avg_return for r in serving.avg_return_by_symbol(gold_rows(spark)).collect()}
    assert means["FLAT"] == pytest.approx(1.0) and means["NEW"] is None
    assert serving.avg_return_by_symbol(gold_rows(spark), limit=2).count() == 2


def test_json_and_export(spark, tmp_path):
    rows = gold_rows(spark).select("symbol", "daily_volume")
    records = [json.loads(r.record) for r in serving.json_rows(rows).collect()]
    assert all(set(r) == {"symbol", "daily_volume"} for r in records)
    for fmt in ("json", "csv"):
        path = str(tmp_path / fmt)
        serving.export(rows, path, fmt)
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        assert reader.format(fmt).load(path).count() == rows.count()
    with pytest.raises(ValueError):
        serving.export(rows, str(tmp_path / "x"), "xml")


ACCEPTED = [
    "SELECT * FROM IDENTIFIER('go' || 'ld')",
    "SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r FROM gold WINDOW w AS (ORDER BY date)",
    "SELECT a.symbol FROM gold a JOIN gold b ON a.symbol = b.symbol AND a.date > b.date WHERE EXISTS (SELECT 1 FROM gold c WHERE c.symbol = a.symbol)",
    "SELECT symbol, max_by(date, daily_close), percentile_approx(daily_close, 0.5), median(daily_volume) FROM gold GROUP BY ROLLUP (symbol)",
    "SELECT transform(collect_list(daily_close), x -> round(ceil(x) + coalesce(nullif(x, 1), 0), 2)), "
    "left(max(symbol), 2), to_timestamp('2024-01-01'), date_trunc('month', max(date)), lpad('a', 3, 'b'), CASE WHEN true THEN 1 END FROM gold",
    "SELECT s, v FROM gold CROSS JOIN (VALUES ('a'), ('b')) AS w(s) LATERAL VIEW explode(array(1, 2)) t AS v WHERE symbol RLIKE '^U' AND date BETWEEN '2024-01-01' AND '2024-02-01'",
    "SELECT symbol FROM gold UNION SELECT symbol FROM gold EXCEPT SELECT 'x' ORDER BY symbol LIMIT 5 OFFSET 1",
    "SELECT * FROM (SELECT symbol, daily_close FROM gold) PIVOT (max(daily_close) FOR symbol IN ('UP', 'DOWN'))",
    "SELECT max(foreign_rows.daily_close) FROM gold AS foreign_rows",
    "SELECT u.symbol, (SELECT count(*) FROM gold d WHERE d.date = u.date) FROM gold u, LATERAL (SELECT u.daily_close * 2 AS twice)",
    "SELECT symbol, AVG(daily_return_pct) AS avg_return FROM gold GROUP BY symbol LIMIT 10",
    "WITH g AS (SELECT * FROM gold) SELECT count(*) AS n FROM g;",
    "SELECT 1 AS updated_at, 'x' AS insert_note FROM gold",
    "SELECT symbol FROM gold ORDER BY symbol -- the end",
    "SELECT 'reflect(' AS said, g.symbol FROM gold AS g",
]
REJECTED = [
    "SELECT * FROM IDENTIFIER('foreign_rows')",
    "SELECT * FROM IDENTIFIER('parquet.`/root/testdata/sf0.001/nation.parquet`')",
    "SELECT IDENTIFIER('reflect')('java.lang.System', 'getProperty', 'user.home')",
    "SELECT left(try_reflect('java.lang.System', 'getProperty', 'user.home'), 3) FROM gold",
    "SELECT filter(array(1), x -> reflect('java.lang.System', 'getProperty', 'user.home') = 'x') FROM gold",
    "SELECT (SELECT max(java_method('java.lang.System', 'lineSeparator')) FROM gold) FROM gold",
    "SELECT * FROM gold WHERE symbol IN (SELECT CAST(id AS STRING) FROM global_temp.shared_rows)",
    "SELECT my_function(symbol) FROM gold",
    "SELECT input_file_name() FROM gold",
    "SELECT raise_error(symbol) FROM gold",
    "SELECT * FROM range(10)",
    "SELECT 1) UNION ALL (SELECT id FROM foreign_rows",
    "INSERT INTO gold SELECT * FROM gold",
    "CREATE TABLE x AS SELECT 1",
    "DROP VIEW gold",
    "TRUNCATE TABLE gold",
    "CACHE TABLE gold",
    "SET spark.sql.ansi.enabled=false",
    "ADD JAR '/tmp/x.jar'",
    "SELECT 1; SELECT 2",
    "SELECT (1 FROM gold",
    "SELECT TRANSFORM(symbol) USING 'cat' AS (s) FROM gold",
    "SELECT reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT java_method('java.lang.System', 'getProperty', 'user.home')",
    "SELECT * FROM parquet.`/root/testdata/sf0.001/nation.parquet`",
    "SELECT " + ", ".join(f"1 AS c{i}" for i in range(60)) + ", reflect('java.lang.System', 'getProperty', 'user.home')",
    "SELECT * FROM foreign_rows",
    "SELECT * FROM gold AS foreign_rows, (SELECT * FROM foreign_rows)",
    "SELECT (SELECT max(id) FROM foreign_rows) FROM gold",
]


@pytest.mark.parametrize("text", ACCEPTED)
def test_sql_accepts_queries(spark, text):
    assert sql_over_layers(spark, text, {"gold": gold_rows(spark)}).count() > 0


@pytest.mark.parametrize("text", REJECTED)
def test_sql_rejects_everything_else(spark, text):
    spark.range(3).createOrReplaceTempView("foreign_rows")
    spark.range(3).createOrReplaceGlobalTempView("shared_rows")
    spark.udf.register("my_function", lambda x: x)
    with pytest.raises((ValueError, AnalysisException)):
        sql_over_layers(spark, text, {"gold": gold_rows(spark)})
    assert not spark.catalog.tableExists("gold")
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"


def test_sql_leaves_the_callers_views_and_settings_alone(spark):
    spark.range(7).createOrReplaceTempView("gold")
    got = sql_over_layers(spark, "SELECT count(*) AS n, date_format(TIMESTAMP '2024-01-01 00:00:00Z', 'HH') AS h FROM gold", {"Gold": gold_rows(spark)})
    assert one(got) == {"n": gold_rows(spark).count(), "h": "00"} and spark.table("gold").count() == 7
    joined = got.crossJoin(spark.table("gold"))
    assert joined.count() == 7  # a result is a table of the caller's session
    spark.catalog.dropTempView("gold")


def test_sql_limit(spark):
    assert sql_over_layers(spark, "SELECT * FROM gold", {"gold": gold_rows(spark)}, 2).count() == 2


META = "symbol string, company_name string, sector string, market_cap string, updated_at string"


def meta(spark):
    return spark.createDataFrame(
        [
            ("UP", "Up old", "Tech", "1", "2024-01-01"),
            ("UP", "Up new", "Energy", "2.5", "2024-01-03 12:00:00"),
            ("DOWN", "Down", "Tech", "n/a", "2024-01-02"),
            ("FLAT", "Flat", "Tech", "3", "never"),
        ],
        META,
    )


def test_symbol_dim(spark):
    got = {r.symbol: r for r in sector.symbol_dim(meta(spark)).collect()}
    assert got["UP"].sector == "Energy" and float(got["UP"].market_cap) == 2.5
    assert got["DOWN"].market_cap is None and got["FLAT"].updated_at is None


def test_sector_tables_keep_unknown_symbols(spark):
    data = bars(spark, [100, 110, 120], "UP").union(bars(spark, [100, 90, 80], "DOWN"))
    data = gold.daily_returns(data.union(bars(spark, [50, 51], "FLAT")).union(bars(spark, [7, 8], "ODD")))
    dim = sector.symbol_dim(meta(spark))
    daily = {(r.sector, r.date): r for r in sector.sector_daily(data, dim).collect()}
    tech = daily[("Tech", day(1))]
    assert tech.members == 2 and tech.volume == 2_000_000
    assert tech.mean_return == pytest.approx(-4.0) and tech.median_return == pytest.approx(-4.0)
    assert daily[(None, day(1))].members == 1
    assert daily[("Tech", day(0))].median_return is None
    levels = sector.sector_rollup(data, dim).groupBy("level").count().collect()
    assert {r.level: r["count"] for r in levels} == {0: 4, 1: 3, 3: 1}


def test_asof_metadata(spark):
    data = bars(spark, [1, 2, 3, 4], "UP").union(bars(spark, [1, 2], "DOWN")).union(bars(spark, [1], "ODD"))
    got = {(r.symbol, r.date): r.company_name for r in sector.asof_metadata(data, meta(spark)).collect()}
    assert [got[("UP", day(n))] for n in range(4)] == ["Up old", "Up old", "Up new", "Up new"]
    assert [got[("DOWN", day(n))] for n in range(2)] == [None, "Down"]
    assert got[("ODD", day(0))] is None and len(got) == 7


@pytest.mark.parametrize("broadcast_limit", ["10m", "-1"])
def test_grouped_median_against_brute_force(spark, broadcast_limit):
    rows = (
        [("hot", float(v)) for v in [0] * 400 + list(range(-50, 300))]
        + [("even", v) for v in (1e-9, -3.5, 1e12, 7.25)]
        + [("odd", v) for v in (2.0, 2.0, -1.0)]
        + [("gap", None), ("gap", float("nan")), ("gap", 4.0), (None, 1.0), (None, 2.0)]
    )
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    want = {}
    for k, v in rows:
        if v is not None and v == v:
            want.setdefault(k, []).append(v)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, broadcast_limit)
    try:
        got = {r.k: r["median"] for r in grouped_median(df, ["k"], "v").collect()}
    finally:
        for name in names:
            spark.conf.unset(name)
    assert got == {k: statistics.median(v) for k, v in want.items()}


def test_quality_tables(spark):
    rows = spark.createDataFrame(
        [(day(0), "A", 1.0), (day(0), "A", float("nan")), (day(1), None, 2.0), (day(2), "A", None)],
        "date date, symbol string, close double",
    )
    nulls = {r.column: (r.rows, r.missing) for r in quality.null_counts(rows).collect()}
    assert nulls == {"date": (4, 0), "symbol": (4, 1), "close": (4, 2)}
    assert one(quality.duplicate_keys(rows)) == {"symbol": "A", "date": day(0), "copies": 2}
    assert one(quality.distinct_keys(rows)) == {"distinct_keys": 3}
    score = one(quality.quality_score(rows))
    assert (score["rows"], score["missing_rows"], score["duplicate_rows"]) == (4, 3, 1)
    assert score["score"] == 0.5
    assert one(quality.quality_score(rows.where("false")))["score"] is None


def test_schema_differences(spark):
    df = spark.createDataFrame([("x", "1"), ("3", "2")], "close string, extra string")
    got = {r.column: (r.problem, r.expected, r.actual, r.bad_values)
           for r in quality.schema_differences(df, OHLC).collect()}
    assert got["close"] == ("type", "double", "string", 1)
    assert got["extra"] == ("unexpected", None, "string", 0)
    assert got["symbol"] == ("missing", "string", None, 2)
    assert quality.schema_differences(bars(spark, [1]), OHLC).isEmpty()


def test_missing_days_and_calendar(spark):
    data = bars(spark, [1, 2, 3], days=[0, 2, 6])
    assert column(quality.missing_days(data), "date") == [day(n) for n in (1, 3, 4, 5)]
    market = spark.createDataFrame([(day(n),) for n in (0, 1, 2, 5, 6)], "date date")
    assert column(quality.missing_days(data, market), "date") == [day(1), day(5)]
    grid = quality.calendar_grid(data)
    assert column(grid, "date") == [day(n) for n in range(7)]


def test_profile(spark):
    df = sample_bars(spark, 40, 500, end="2025-05-14", seed=1)
    got = {r.column: r for r in quality.profile_columns(df).collect()}
    assert got["symbol"].approx_distinct == pytest.approx(40, rel=0.1)
    assert got["close"].rows == 20_000 and got["close"].missing == 0
    assert got["close"].approx_distinct == pytest.approx(20_000, rel=0.1)
    for share, value in zip((0.25, 0.5, 0.75), got["close"].approx_quartiles):
        rank = df.where(F.col("close") <= value).count() / df.count()
        assert rank == pytest.approx(share, abs=0.01)
    assert got["date"].smallest == "2024-01-01" and got["symbol"].approx_quartiles is None
    gaps = df.select(F.lit(None).cast("double").alias("a"), F.lit(float("nan")).alias("b"))
    got = {r.column: r for r in quality.profile_columns(gaps).collect()}
    assert all(r.missing == 20_000 and r.smallest is None and r.approx_quartiles is None for r in got.values())
    assert {r.rows for r in quality.profile_columns(df.where("false")).collect()} == {0}


def test_layer_metrics(spark):
    a, b = bars(spark, [1, 2, 3]), bars(spark, [1, 2], days=[1, 5])
    counts = {r.layer: r.rows for r in quality.layer_counts({"bronze": a, "silver": b}).collect()}
    assert counts == {"bronze": 3, "silver": 2}
    rows = quality.layer_lineage({"bronze": a, "silver": b}).orderBy("date").collect()
    assert [(r.bronze_rows, r.silver_rows) for r in rows] == [(1, 0), (1, 1), (1, 0), (0, 1)]
    metrics = one(quality.symbol_metrics(a))
    assert metrics == {"symbol": "TEST", "bars": 3, "latest_date": day(2), "avg_volume": 1e6}
    dist = one(quality.return_distribution(gold_rows(spark)))
    assert dist["symbols"] == 4 and dist["returns"] == 5


def test_missing_days_up_to_a_date(spark):
    rows = bars(spark, [1, 2], "STOPPED", days=[0, 2]).union(bars(spark, [1, 2], "LATER", days=[1, 9]))
    got = {(r.symbol, r.date) for r in quality.missing_days(rows, until=day(4)).collect()}
    assert got == {("STOPPED", day(n)) for n in (1, 3, 4)} | {("LATER", day(n)) for n in (2, 3, 4)}
