"""For each registered query the same result in plain SQL over the given tables."""

from __future__ import annotations

LINES = """lines AS (
  SELECT l.*, CAST(l_shipdate AS DATE) AS date, n_name AS symbol
  FROM lineitem l JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
)"""

BARS = LINES + """, bars AS (
  SELECT date, symbol,
         arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS open,
         max(l_extendedprice) AS high, min(l_extendedprice) AS low,
         arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS close,
         arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS adjusted_close,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lines GROUP BY date, symbol
)"""

EVENT_TICKS = """event_ticks AS (
  SELECT CAST(ts AS DATE) AS date, CAST(user_id AS VARCHAR) AS symbol, value AS price,
         CAST(1 AS BIGINT) AS size, ts, event_id
  FROM events
)"""

EVENT_BARS = EVENT_TICKS + """, event_bars AS (
  SELECT date, symbol, arg_min(price, row(ts, event_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts, event_id)) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM event_ticks GROUP BY date, symbol
)"""

EVENT_LATEST = EVENT_TICKS + """, event_latest AS (
  SELECT date, symbol, price AS open, price AS high, price AS low, price AS close,
         price AS adjusted_close, size AS volume, event_id
  FROM event_ticks
  QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ts DESC, event_id DESC) = 1
)"""

VERSIONS = LINES + """, versions AS (
  SELECT date, symbol, l_extendedprice AS open, l_extendedprice AS high, l_extendedprice AS low,
         l_extendedprice AS close, l_extendedprice AS adjusted_close,
         CAST(l_quantity AS BIGINT) AS volume,
         CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_orderkey) AS loaded,
         l_linenumber, l_partkey, l_suppkey
  FROM lines
)"""

DIRTY = LINES + """, dirty AS (
  SELECT CASE WHEN NOT (l_quantity = 13 AND t = 0) THEN date END AS date,
         CASE WHEN NOT (l_quantity = 17 AND t = 0.01) THEN symbol END AS symbol,
         CAST(p AS VARCHAR) AS open,
         CAST(p + CASE WHEN d = 0.07 THEN -5 ELSE 1 END AS VARCHAR) AS high,
         CAST(p + CASE WHEN d = 0.06 THEN 5 ELSE -1 END AS VARCHAR) AS low,
         CASE WHEN d = 0.10 THEN 'n/a' WHEN d = 0.09 THEN 'NaN' WHEN d = 0.08 THEN NULL
              ELSE CAST(p AS VARCHAR) END AS close,
         CAST(p AS VARCHAR) AS adjusted_close,
         CAST(CASE WHEN t = 0.03 AND d = 0.03 THEN -1 ELSE 1 END * CAST(l_quantity AS BIGINT) AS VARCHAR) AS volume,
         CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_orderkey) AS loaded,
         l_linenumber, l_partkey, l_suppkey
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d,
               CAST(l_tax AS DECIMAL(4,2)) AS t FROM lines)
), typed AS (
  SELECT date, symbol, TRY_CAST(open AS DOUBLE) AS open, TRY_CAST(high AS DOUBLE) AS high,
         TRY_CAST(low AS DOUBLE) AS low, TRY_CAST(close AS DOUBLE) AS raw_close,
         CASE WHEN NOT isnan(TRY_CAST(close AS DOUBLE)) THEN TRY_CAST(close AS DOUBLE) END AS close,
         coalesce(isnan(TRY_CAST(close AS DOUBLE)), false) AS close_is_nan,
         TRY_CAST(adjusted_close AS DOUBLE) AS adjusted_close, TRY_CAST(volume AS BIGINT) AS volume,
         loaded, l_linenumber, l_partkey, l_suppkey, close AS text_close
  FROM dirty
), flagged AS (
  SELECT *, concat_ws(',',
           CASE WHEN date IS NULL THEN 'date_missing' END,
           CASE WHEN symbol IS NULL THEN 'symbol_missing' END,
           CASE WHEN close IS NULL THEN 'close_missing' END,
           CASE WHEN open < low OR open > high THEN 'open_out_of_range' END,
           CASE WHEN raw_close < low OR raw_close > high THEN 'close_out_of_range' END,
           CASE WHEN volume < 0 THEN 'volume_negative' END) AS failed_rules
  FROM typed
), silver AS (
  SELECT *, failed_rules = '' AS _quality_check_passed
  FROM (
    SELECT * FROM flagged
    QUALIFY row_number() OVER (PARTITION BY symbol, date
      ORDER BY loaded DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, text_close DESC NULLS LAST) = 1
  )
  WHERE date IS NOT NULL AND symbol IS NOT NULL AND close IS NOT NULL
)"""

BAR = "date, symbol, open, high, low, close, adjusted_close, volume"

NEWEST_VERSION = """row_number() OVER (PARTITION BY symbol, date
  ORDER BY loaded DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, close DESC)"""


def _frame(days: int, frame: str) -> str:
    bounds = (
        f"RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW"
        if frame == "calendar"
        else f"ROWS BETWEEN {days - 1} PRECEDING AND CURRENT ROW"
    )
    return f"(PARTITION BY symbol ORDER BY date {bounds})"


def _mean(days: int, frame: str = "calendar") -> str:
    over = _frame(days, frame)
    return f"CAST(sum(CAST(close AS DECIMAL(8,2))) OVER {over} AS DOUBLE) / count(close) OVER {over}"


RETURN = """(close - lag(close) OVER (PARTITION BY symbol ORDER BY date))
         / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) * 100"""


def _gold_over(bars: str) -> str:
    """The analytics layer as CTE ``gold`` over the CTE of bars with the given name."""
    return f""", enriched AS (
  SELECT *, {RETURN} AS daily_return_pct, {_mean(50)} AS ma_50, {_mean(200)} AS ma_200
  FROM {bars}
), gold AS (
  SELECT date, symbol, open AS daily_open, high AS daily_high, low AS daily_low, close AS daily_close,
         volume AS daily_volume, daily_return_pct, ma_50 AS ma_50_day, ma_200 AS ma_200_day,
         stddev_samp(daily_return_pct) OVER {_frame(30, "calendar")} AS volatility_30d
  FROM enriched
)"""


GOLD = BARS + _gold_over("bars")

# Bars after a later load corrected some closes and withdrew others.
CORRECTED = BARS + """, corrected AS (
  SELECT * REPLACE (CASE WHEN volume % 43 = 0 THEN close * 2 ELSE close END AS close)
  FROM bars WHERE volume % 41 <> 0
)""" + _gold_over("corrected")

# Bars after a later load corrected the closes of two days.
APART = BARS + """, apart AS (
  SELECT * REPLACE (CASE WHEN date IN (DATE '1995-06-15', DATE '2001-03-05') THEN close * 2 ELSE close END AS close)
  FROM bars
)""" + _gold_over("apart")

REMAINING = BARS + ", remaining AS (SELECT * FROM bars WHERE volume % 41 <> 0)" + _gold_over("remaining")

GOLD_COLUMNS = """date, symbol, daily_open, daily_high, daily_low, daily_close, daily_volume,
  daily_return_pct, ma_50_day, ma_200_day, CAST(floor(volatility_30d * 10000) AS BIGINT) AS volatility_e4"""

META = """updates AS (
  SELECT n_name AS symbol, s_name AS company_name, r_name AS sector,
         CASE WHEN s_acctbal >= 0 THEN CAST(s_acctbal AS DECIMAL(12,2)) END AS market_cap,
         CASE WHEN s_acctbal >= 0 THEN DATE '1995-01-01' + CAST(floor(s_acctbal / 4) AS INTEGER) END AS updated_on
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), dim AS (
  SELECT * FROM updates
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY updated_on DESC NULLS LAST,
    company_name DESC, sector DESC, market_cap DESC NULLS LAST) = 1
)"""

SECTOR_RETURNS = BARS + ", " + META + f""", returns AS (
  SELECT bars.*, {RETURN.replace("symbol", "bars.symbol")} AS daily_return_pct, sector
  FROM bars LEFT JOIN dim ON bars.symbol = dim.symbol
)"""

E4 = "CAST(floor({} * 10000) AS BIGINT)"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _average(days: int, frame: str) -> str:
    return _with(BARS, f"SELECT date, symbol, close, {_mean(days, frame)} AS ma_{days} FROM bars")


def _volatility(frame: str) -> str:
    value = f"stddev_samp(r) OVER {_frame(30, frame)}"
    return _with(
        BARS,
        f"SELECT date, symbol, {E4.format(value)} AS volatility_e4 "
        f"FROM (SELECT date, symbol, {RETURN} AS r FROM bars)",
    )


def _layer_count(layer: str, table: str) -> str:
    return f"SELECT '{layer}' AS layer, count(*) AS rows FROM {table}"


def _profile_row(name: str, kind: str, bad: str, actual: str | None, problem: str) -> str:
    shown = "NULL" if actual is None else f"'{actual}'"
    wanted = "NULL" if not kind else f"'{kind}'"
    return (
        f'SELECT \'{name}\' AS "column", {wanted} AS expected, {shown} AS actual, '
        f"'{problem}' AS problem, {bad} AS bad_values FROM dirty"
    )


def _uncastable(name: str, kind: str) -> str:
    return f"count(*) FILTER ({name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL)"


EVENT_ROWS = _with(EVENT_TICKS, "SELECT date, symbol, price, size, event_id FROM event_ticks")

ORACLE: dict[str, str] = {
    "ohlc_bars_ticks": _with(BARS, "SELECT * FROM bars"),
    "ohlc_bars_events": _with(EVENT_BARS, "SELECT *, close AS adjusted_close FROM event_bars"),
    "daily_summary": _with(
        VERSIONS,
        """SELECT date, symbol, arg_min(open, k) AS daily_open, max(high) AS daily_high, min(low) AS daily_low,
  arg_max(close, k) AS daily_close, CAST(sum(volume) AS BIGINT) AS daily_volume,
  arg_min(close - open, k) AS daily_return_pct, arg_max(close, k) AS ma_50_day,
  arg_max(open, k) AS ma_200_day, CAST(arg_max(volume, k) AS DOUBLE) AS volatility_30d
FROM (SELECT *, row(loaded, l_linenumber, l_partkey, l_suppkey, close) AS k FROM versions)
GROUP BY date, symbol""",
    ),
    "ingest_bars": _with(BARS, f"SELECT {BAR} FROM bars"),
    "ingest_rejects": _with(
        BARS, "SELECT symbol, count(*) AS rejects FROM bars WHERE volume % 10 = 0 GROUP BY symbol"
    ),
    "ingest_landed_once": _with(BARS, f"SELECT {BAR} FROM bars"),
    "ingest_retried": _with(
        BARS,
        f"""SELECT {BAR} FROM (
  SELECT * REPLACE (CASE WHEN volume % 10 <> 0 THEN date END AS date, CASE WHEN volume % 7 <> 0 THEN symbol END AS symbol)
  FROM bars)""",
    ),
    "ingest_added_column": _with(
        BARS,
        f"""SELECT {BAR}, CASE WHEN date >= DATE '1998-07-01' THEN CAST(CAST(volume AS BIGINT) AS VARCHAR) END AS lot
FROM bars""",
    ),
    "ingest_bars_range": _with(
        BARS,
        f"""SELECT {BAR} FROM bars
WHERE symbol IN ('NATION_1', 'NATION_7', 'NATION_12', 'NATION_20')
  AND date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""",
    ),
    "conform_schema": _with(DIRTY, f"SELECT {BAR} FROM typed"),
    "union_sources": _with(
        BARS + ", " + EVENT_BARS,
        f"""SELECT {BAR} FROM bars
UNION ALL SELECT date, symbol, open, high, low, close, close, NULL FROM event_bars""",
    ),
    "schema_evolution": _with(
        BARS,
        f"SELECT {BAR}, CASE WHEN date >= DATE '1998-07-01' THEN close / 100 END AS pe_ratio FROM bars",
    ),
    "calendar_grid": _with(
        BARS,
        """SELECT symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT symbol, min(date) AS lo, max(date) AS hi FROM bars GROUP BY symbol)""",
    ),
    "bronze_rows": _with(BARS, f"SELECT {BAR}, DATE '2001-11-05' AS _ingestion_date FROM bars"),
    "read_bronze_eq": _with(
        BARS, f"SELECT {BAR} FROM bars WHERE symbol = 'NATION_19'"
    ),
    "read_silver_range": _with(
        BARS,
        f"SELECT {BAR} FROM bars WHERE date BETWEEN DATE '1996-02-10' AND DATE '1999-11-20'",
    ),
    "read_gold_range": _with(
        GOLD, f"SELECT {GOLD_COLUMNS} FROM gold WHERE date >= DATE '1999-03-05'"
    ),
    "latest_date": _with(LINES, "SELECT max(date) AS latest_date FROM lines"),
    "distinct_symbols": _with(LINES, "SELECT DISTINCT symbol FROM lines"),
    "bronze_as_of": _with(
        VERSIONS,
        f"""SELECT {BAR} FROM versions WHERE loaded <= TIMESTAMP '1999-06-30 00:30:00'
QUALIFY {NEWEST_VERSION} = 1""",
    ),
    "purge_superseded": _with(
        VERSIONS,
        f"""SELECT {BAR}, l_linenumber, l_partkey, l_suppkey FROM versions
QUALIFY {NEWEST_VERSION} = 1 OR loaded >= TIMESTAMP '1999-06-30 00:30:00' - INTERVAL 365 DAYS""",
    ),
    "silver_dedup": _with(VERSIONS, f"SELECT {BAR} FROM versions QUALIFY {NEWEST_VERSION} = 1"),
    "silver_cast": _with(DIRTY, f"SELECT {BAR}, close_is_nan FROM typed"),
    "silver_not_null": _with(
        DIRTY,
        f"""SELECT {BAR} FROM typed
WHERE date IS NOT NULL AND symbol IS NOT NULL AND close IS NOT NULL""",
    ),
    "silver_layer": _with(DIRTY, f"SELECT {BAR}, _quality_check_passed FROM silver"),
    "quality_flags": _with(
        DIRTY,
        f"""SELECT {BAR}, l_partkey, close_is_nan, failed_rules,
  failed_rules = '' AS _quality_check_passed FROM flagged""",
    ),
    "null_rows": _with(
        DIRTY,
        f"""SELECT {BAR}, close_is_nan, l_partkey, l_suppkey FROM typed
WHERE symbol IS NULL OR close IS NULL""",
    ),
    "upsert_latest": _with(VERSIONS, f"SELECT {BAR} FROM versions QUALIFY {NEWEST_VERSION} = 1"),
    "incremental_new_rows": _with(
        BARS,
        f"""SELECT {BAR} FROM bars WHERE NOT EXISTS (
  SELECT 1 FROM lines WHERE l_linestatus = 'F' AND lines.symbol = bars.symbol AND lines.date = bars.date)""",
    ),
    "daily_returns": _with(
        BARS, f"SELECT date, symbol, close, {RETURN} AS daily_return_pct FROM bars"
    ),
    "ma_50_calendar": _average(50, "calendar"),
    "ma_50_rows": _average(50, "rows"),
    "ma_200_calendar": _average(200, "calendar"),
    "ma_200_rows": _average(200, "rows"),
    "volatility_30_calendar": _volatility("calendar"),
    "volatility_30_rows": _volatility("rows"),
    "gold_layer": _with(GOLD, f"SELECT {GOLD_COLUMNS} FROM gold"),
    "layers_end_to_end": _with(GOLD, f"SELECT {GOLD_COLUMNS} FROM gold"),
    "incremental_run": _with(GOLD, f"SELECT {GOLD_COLUMNS} FROM gold"),
    "incremental_correction": _with(CORRECTED, f"SELECT {GOLD_COLUMNS} FROM gold"),
    "incremental_far_apart": _with(APART, f"SELECT {GOLD_COLUMNS} FROM gold"),
    "incremental_late_bar": _with(GOLD, f"SELECT {GOLD_COLUMNS} FROM gold"),
    "rebuild_after_removal": _with(REMAINING, f"SELECT {GOLD_COLUMNS} FROM gold"),
    "full_run_retained": _with(
        GOLD,
        f"""SELECT * FROM (SELECT date, symbol FROM bars WHERE date >= DATE '2001-11-04' - 90)
LEFT JOIN (SELECT {GOLD_COLUMNS} FROM gold WHERE date >= DATE '2001-11-04' - 30) USING (date, symbol)""",
    ),
    "run_metrics": _with(
        BARS,
        """SELECT layer, count(*) AS rows, min(date) AS first_date, max(date) AS last_date
FROM bars CROSS JOIN (VALUES ('bronze'), ('silver'), ('gold')) AS layers(layer) GROUP BY layer""",
    ),
    "run_history": _with(
        BARS,
        """, counted AS (
  SELECT run_id, count(*) AS bronze_rows, count(*) FILTER (volume % 7 = 0) AS rejected,
         count(*) FILTER (volume % 7 <> 0) AS silver_rows,
         count(*) FILTER (volume % 7 <> 0 AND (volume % 5 <> 0 OR volume = 0)) AS passed
  FROM bars JOIN (VALUES ('run-1', DATE '1996-12-31'), ('run-2', DATE '1998-06-30'), ('run-3', DATE '2100-01-01'))
    AS runs(run_id, until) ON date <= until
  GROUP BY run_id
), rated AS (
  SELECT run_id, 'done' AS status, bronze_rows, silver_rows, silver_rows AS gold_rows, rejected,
         CAST(rejected AS DOUBLE) / bronze_rows AS error_rate, CAST(passed AS DOUBLE) / silver_rows AS quality_score
  FROM counted
)
SELECT *, CAST(sum(bronze_rows) OVER (ORDER BY run_id) AS BIGINT) AS loaded_so_far,
  quality_score - lag(quality_score) OVER (ORDER BY run_id) AS score_change, true AS timed
FROM rated""",
    ),
    # Each row paired with all bars it reads, one by one.
    "gold_provenance": _with(
        VERSIONS,
        f""", newest AS (
  SELECT date, symbol, loaded FROM versions QUALIFY {NEWEST_VERSION} = 1
), linked AS (
  SELECT *, lag(date) OVER (PARTITION BY symbol ORDER BY date) AS date_before,
         min(date) OVER {_frame(30, "calendar")} AS first_of_30
  FROM newest
), reading AS (
  SELECT r.date, r.symbol, f.date_before AS before_the_30
  FROM linked r JOIN linked f ON f.symbol = r.symbol AND f.date = r.first_of_30
)
SELECT r.date, r.symbol, strftime(min(i.loaded), '%Y-%m-%d %H:%M:%S') AS earliest_load,
  strftime(max(i.loaded), '%Y-%m-%d %H:%M:%S') AS latest_load, min(i.date) AS first_bar, count(*) AS bars_read
FROM reading r JOIN newest i ON i.symbol = r.symbol AND i.date <= r.date
  AND (i.date >= r.date - 199 OR i.date = r.before_the_30)
GROUP BY r.date, r.symbol""",
    ),
    "schema_widening": _with(
        BARS,
        """SELECT date, symbol, open, high, low, close, adjusted_close, CAST(volume AS DOUBLE) AS volume,
  CASE WHEN date < DATE '1997-01-01' THEN CAST(volume AS VARCHAR)
       WHEN date <= DATE '1998-06-30' THEN 'L' || CAST(volume AS VARCHAR) END AS lot
FROM bars""",
    ),
    "purge_stored": _with(
        VERSIONS,
        f"""SELECT {BAR}, l_linenumber, l_partkey, l_suppkey FROM versions
QUALIFY {NEWEST_VERSION} = 1 OR loaded >= TIMESTAMP '1999-06-30 00:30:00' - INTERVAL 365 DAYS""",
    ),
    "gold_since": _with(GOLD, f"SELECT {GOLD_COLUMNS} FROM gold WHERE date >= DATE '2000-02-29'"),
    "ml_lag_features": _with(
        BARS,
        "SELECT date, symbol, close, "
        + ", ".join(
            f"lag(close, {k}) OVER (PARTITION BY symbol ORDER BY date) AS close_lag_{k}"
            for k in (1, 2, 3, 5, 10)
        )
        + " FROM bars",
    ),
    "price_momentum_5d": _with(
        BARS,
        """SELECT date, symbol, close,
  close / nullif(lag(close, 5) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS price_momentum_5d
FROM bars""",
    ),
    "stock_history": _with(
        GOLD,
        f"""SELECT {GOLD_COLUMNS} FROM gold
WHERE symbol = 'NATION_19' AND date BETWEEN DATE '2000-11-04' AND DATE '2001-11-04'
ORDER BY date DESC LIMIT 100""",
    ),
    "stock_performance": _with(
        GOLD,
        f"""SELECT symbol, return_pct, avg_volume, {E4.format("mean_volatility")} AS avg_volatility_e4
FROM (
  SELECT symbol,
         (arg_max(daily_close, date) - arg_min(daily_close, date)) / nullif(arg_min(daily_close, date), 0) * 100 AS return_pct,
         CAST(sum(daily_volume) AS DOUBLE) / count(daily_volume) AS avg_volume,
         avg(volatility_30d) AS mean_volatility
  FROM gold WHERE date BETWEEN DATE '1999-07-01' AND DATE '2000-06-30' GROUP BY symbol
) ORDER BY return_pct DESC NULLS LAST, symbol LIMIT 10""",
    ),
    "top_gainers": _with(
        GOLD,
        """SELECT symbol, daily_close, daily_return_pct, ma_50_day, ma_200_day FROM gold
WHERE date = (SELECT max(date) FROM gold)
ORDER BY daily_return_pct DESC NULLS LAST, symbol LIMIT 10""",
    ),
    "top_gainers_per_day": _with(
        GOLD,
        """SELECT date, CAST(row_number() OVER (PARTITION BY date ORDER BY daily_return_pct DESC NULLS LAST, symbol) AS INTEGER) AS place,
  symbol, daily_close, daily_return_pct, ma_50_day, ma_200_day
FROM gold QUALIFY place <= 5""",
    ),
    "gold_report": _with(
        GOLD,
        """SELECT symbol, date, daily_close, daily_return_pct, ma_50_day, ma_200_day,
  CAST(floor(volatility_30d * 10000) AS BIGINT) AS volatility_e4
FROM gold WHERE symbol = 'NATION_19' AND date >= DATE '1999-01-01'""",
    ),
    "avg_return_by_symbol": _with(
        GOLD,
        f"""SELECT symbol, {E4.format("avg(daily_return_pct)")} AS avg_return_e4
FROM gold GROUP BY symbol""",
    ),
    "sql_over_gold": _with(
        GOLD,
        """SELECT symbol, CAST(year(date) AS INTEGER) AS traded_year, count(*) AS days, max(daily_high) AS highest,
  CAST(sum(daily_volume) AS BIGINT) AS volume
FROM gold WHERE date >= DATE '1996-01-01' AND daily_return_pct > 0
GROUP BY symbol, year(date)""",
    ),
    "sql_with_ctes": _with(
        GOLD + ", " + META,
        """SELECT symbol, date, daily_close, (SELECT max(sector) FROM updates u WHERE u.symbol = b.symbol) AS sector,
  (SELECT count(*) FROM gold g WHERE g.symbol = b.symbol AND g.date > b.date) AS later
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY daily_close DESC, date) AS place,
        max(daily_volume) OVER (PARTITION BY symbol) AS most FROM gold) b
WHERE place <= 3 AND most > 40""",
    ),
    "export_json_rows": _with(
        GOLD,
        "SELECT '{\"symbol\":\"' || symbol || '\",\"date\":\"' || date || '\",\"daily_volume\":' || daily_volume"
        + "".join(f" || ',\"{p}\":' || CAST(daily_{p} AS DECIMAL(10,2))" for p in ("open", "high", "low", "close"))
        + "".join(
            f" || ',\"{c}\":' || coalesce(CAST({E4.format(c)} AS VARCHAR), 'null')"
            for c in ("daily_return_pct", "ma_50_day", "ma_200_day", "volatility_30d")
        )
        + " || '}' AS record FROM gold",
    ),
    "dq_nulls": _with(
        DIRTY,
        " UNION ALL ".join(
            f"SELECT '{name}' AS \"column\", count(*) AS rows, count(*) - count({name}) AS missing FROM typed"
            for name in ("date", "symbol", "close")
        ),
    ),
    "dq_schema": _with(
        DIRTY,
        " UNION ALL ".join(
            [
                _profile_row(n, "double", _uncastable(n, "DOUBLE"), "string", "type")
                for n in ("open", "high", "low", "close")
            ]
            + [
                _profile_row("adjusted_close", "double", "count(*)", None, "missing"),
                _profile_row("volume", "bigint", _uncastable("volume", "BIGINT"), "string", "type"),
                _profile_row("note", "", "0", "string", "unexpected"),
            ]
        ).replace("0 AS bad_values FROM dirty", "CAST(0 AS BIGINT) AS bad_values"),
    ),
    "dq_duplicates": _with(
        VERSIONS,
        "SELECT symbol, date, count(*) AS copies FROM versions GROUP BY symbol, date HAVING count(*) > 1",
    ),
    "dq_score": _with(
        DIRTY,
        """SELECT rows, missing_rows, duplicate_rows, 2 * rows - missing_rows - duplicate_rows AS score_points,
  2 * rows AS score_maximum,
  CAST(2 * rows - missing_rows - duplicate_rows AS DOUBLE) / (2 * rows) AS score
FROM (
  SELECT count(*) AS rows,
         count(*) FILTER (date IS NULL OR symbol IS NULL OR close IS NULL) AS missing_rows,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT symbol, date FROM typed)) AS duplicate_rows
  FROM typed
)""",
    ),
    "distinct_keys": _with(
        VERSIONS,
        "SELECT count(*) AS distinct_keys FROM (SELECT DISTINCT symbol, date FROM versions)",
    ),
    "missing_days": _with(
        BARS,
        """SELECT g.symbol, g.date FROM (
  SELECT symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT symbol, min(date) AS lo, max(date) AS hi FROM bars GROUP BY symbol)
) g ANTI JOIN bars ON g.symbol = bars.symbol AND g.date = bars.date""",
    ),
    "missing_days_until": _with(
        BARS,
        """SELECT g.symbol, g.date FROM (
  SELECT symbol, CAST(unnest(generate_series(lo, DATE '2001-11-20', INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT symbol, min(date) AS lo FROM bars GROUP BY symbol)
) g ANTI JOIN bars ON g.symbol = bars.symbol AND g.date = bars.date""",
    ),
    "profile_range": _with(
        BARS,
        """, two AS (
  SELECT symbol, volume, CASE WHEN date NOT IN (DATE '1996-03-05', DATE '1997-06-02') THEN close END AS close
  FROM bars WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31')
SELECT 'symbol' AS column, count(*) AS rows, count(*) - count(symbol) AS missing, NULL::BIGINT AS smallest_e2, NULL::BIGINT AS largest_e2,
  true AS distinct_near, true AS quartiles_near FROM two
UNION ALL SELECT 'close', count(*), count(*) - count(close), floor(min(close) * 100 + 0.5)::BIGINT, floor(max(close) * 100 + 0.5)::BIGINT, true, true FROM two
UNION ALL SELECT 'volume', count(*), count(*) - count(volume), min(volume) * 100, max(volume) * 100, true, true FROM two""",
    ),
    "profile_columns": _with(
        BARS,
        " UNION ALL ".join(
            f"""SELECT '{name}' AS "column", count(*) AS rows, count(*) - count({name}) AS missing,
  CAST(min({name}) AS VARCHAR) AS smallest, CAST(max({name}) AS VARCHAR) AS largest FROM bars"""
            for name in BAR.split(", ")
        ),
    ),
    "layer_counts": _with(
        DIRTY + GOLD.removeprefix(LINES),
        " UNION ALL ".join(
            [_layer_count("bronze", "dirty"), _layer_count("silver", "silver"), _layer_count("gold", "gold")]
        ),
    ),
    "layer_lineage": _with(
        DIRTY + GOLD.removeprefix(LINES),
        """SELECT date, coalesce(b.n, 0) AS bronze_rows, coalesce(s.n, 0) AS silver_rows, coalesce(g.n, 0) AS gold_rows
FROM (SELECT date, count(*) AS n FROM dirty WHERE date IS NOT NULL GROUP BY date) b
FULL JOIN (SELECT date, count(*) AS n FROM silver GROUP BY date) s USING (date)
FULL JOIN (SELECT date, count(*) AS n FROM gold GROUP BY date) g USING (date)
UNION ALL SELECT NULL, count(*), 0, 0 FROM dirty WHERE date IS NULL HAVING count(*) > 0""",
    ),
    "symbol_metrics": _with(
        BARS,
        """SELECT symbol, count(*) AS bars, max(date) AS latest_date,
  CAST(sum(volume) AS DOUBLE) / count(volume) AS avg_volume FROM bars GROUP BY symbol""",
    ),
    "return_distribution": _with(
        GOLD,
        f"""SELECT count(DISTINCT symbol) AS symbols, count(daily_return_pct) AS returns,
  {E4.format("avg(daily_return_pct)")} AS mean_return_e4,
  {E4.format("stddev_samp(daily_return_pct)")} AS std_return_e4 FROM gold""",
    ),
    "retain_silver": _with(BARS, f"SELECT {BAR} FROM bars WHERE date >= DATE '2001-11-04' - 90"),
    "retain_gold": _with(
        GOLD, f"SELECT {GOLD_COLUMNS} FROM gold WHERE date >= DATE '2001-11-04' - 30"
    ),
    "symbol_dim": _with(
        META,
        """SELECT symbol, company_name, sector, CAST(market_cap AS DOUBLE) AS market_cap,
  updated_on FROM dim""",
    ),
    "sector_daily": _with(
        SECTOR_RETURNS,
        f"""SELECT sector, date, count(*) AS members, CAST(sum(volume) AS BIGINT) AS volume,
  {E4.format("avg(daily_return_pct)")} AS mean_return_e4,
  {E4.format("median(daily_return_pct)")} AS median_return_e4
FROM returns GROUP BY sector, date""",
    ),
    "sector_rollup": _with(
        SECTOR_RETURNS,
        f"""SELECT sector, symbol, CAST(grouping(sector, symbol) AS INTEGER) AS level, count(*) AS bars,
  CAST(sum(volume) AS BIGINT) AS volume, {E4.format("avg(daily_return_pct)")} AS mean_return_e4
FROM returns GROUP BY ROLLUP (sector, symbol)""",
    ),
    "asof_metadata": _with(
        BARS + ", " + META,
        """SELECT bars.date, bars.symbol, bars.close, m.company_name, m.sector,
  CAST(m.market_cap AS DOUBLE) AS market_cap
FROM bars ASOF LEFT JOIN (
  SELECT * FROM updates WHERE updated_on IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol, updated_on ORDER BY company_name DESC, sector DESC, market_cap DESC) = 1
) m ON bars.symbol = m.symbol AND bars.date >= m.updated_on""",
    ),
    "stream_bronze": EVENT_ROWS,
    "stream_dedup": EVENT_ROWS,
    "stream_daily_bars": _with(EVENT_BARS, "SELECT *, close AS adjusted_close FROM event_bars"),
    "stream_bars_closed": _with(
        EVENT_BARS,
        f"""SELECT {BAR}, CASE WHEN date < DATE '2024-01-20' THEN 'clean' ELSE 'log' END AS place
FROM (SELECT *, close AS adjusted_close FROM event_bars)""",
    ),
    "stream_upsert_invalid": _with(
        EVENT_LATEST + ", valid AS (SELECT * FROM event_latest WHERE event_id % 5 <> 0)" + _gold_over("valid"),
        f"SELECT {GOLD_COLUMNS} FROM gold",
    ),
    "stream_over_batch_layer": _with(EVENT_LATEST, f"SELECT {BAR} FROM event_latest WHERE event_id % 5 <> 0"),
    "stream_upsert": _with(EVENT_LATEST, f"SELECT {BAR}, event_id FROM event_latest"),
    "stream_gold_tail": _with(
        EVENT_LATEST + _gold_over("event_latest"), f"SELECT {GOLD_COLUMNS} FROM gold"
    ),
}
