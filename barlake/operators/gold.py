"""Analytics layer: returns, moving averages, volatility, daily summaries, features.

Bound on a symbol.  The per-symbol windows here read bars, which are unique per
(symbol, date): the clean layer's dedup or ``daily_bars`` guarantees it, both
with a map-side reduction.  A symbol therefore has at most one row per calendar
day (36,525 in a century), however many ticks or versions it had before, and no
symbol can gather a large share of a large table in one window task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barlake.functions import date_bound, over_history, over_prefix, pct_change
from barlake.functions.expressions import DateLike
from barlake.operators.silver import NEWEST

# Frame lengths in days, today included.
SHORT_DAYS = 50
LONG_DAYS = 200
VOLATILITY_DAYS = 30
# The type closes are summed in unless another is given.
EXACT = "decimal(28,8)"


def _by_date() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def daily_returns(df: DataFrame) -> DataFrame:
    """Add ``daily_return_pct`` against the previous bar's close; NULL on the first."""
    return (
        df.withColumn("_previous", F.lag("close").over(_by_date()))
        .withColumn("daily_return_pct", pct_change(F.col("close"), F.col("_previous")))
        .drop("_previous")
    )


def mean_close(
    days: int, frame: str = "calendar", average_as: str | None = None, min_periods: int = 1
) -> Column:
    """Mean close over the last ``days``; early rows average what exists.

    Closes are summed as decimals of the type ``average_as``, by default with 8 digits behind
    the point and 20 before it: sums are exact, so a mean is the running sum of the history
    less that before the frame, and each row is added once, not once per frame it is in.  A
    close that is missing, or no such decimal, is not averaged.  Fewer than ``min_periods``
    closes in the frame give NULL.
    """
    value = f"try_cast(close AS {average_as or EXACT})"
    total = over_prefix(f"sum({value})", days, frame).cast("double")
    count = over_prefix(f"count({value})", days, frame)
    return F.when(count >= max(min_periods, 1), total / count)


def moving_averages(
    df: DataFrame,
    frame: str = "calendar",
    average_as: str | None = None,
    days: Sequence[int] = (SHORT_DAYS, LONG_DAYS),
    min_periods: int = 1,
) -> DataFrame:
    """Add ``ma_{n}`` for each length in ``days``."""
    return df.withColumns(
        {f"ma_{n}": mean_close(n, frame, average_as, min_periods) for n in days}
    )


def volatility(df: DataFrame, days: int = VOLATILITY_DAYS, frame: str = "calendar") -> DataFrame:
    """Add ``volatility_30d``, the sample deviation of the daily return; one value gives NULL."""
    return df.withColumn(
        "volatility_30d", over_history("stddev_samp(daily_return_pct)", days, frame)
    )


def _first_and_last(
    order: Sequence[str], firsts: Sequence[str], lasts: Sequence[str]
) -> tuple[dict[str, Column], dict[str, Column]]:
    """Aggregates for the first and the last row of a group by ``order``, per column.

    A single order column keeps the buffers fixed-width, so Spark aggregates by
    hash.  Several columns need a struct, which Spark aggregates by sorting; one
    struct then carries all values of a row.
    """
    if len(order) == 1:
        return (
            {c: F.min_by(c, order[0]) for c in firsts},
            {c: F.max_by(c, order[0]) for c in lasts},
        )
    packed = lambda columns: F.struct(*order, *[F.col(c).alias(f"_{c}") for c in columns])
    earliest, latest = F.min(packed(firsts)), F.max(packed(lasts))
    return {c: earliest[f"_{c}"] for c in firsts}, {c: latest[f"_{c}"] for c in lasts}


def daily_bars(
    ticks: DataFrame,
    order: Sequence[str],
    price: str = "price",
    size: str | None = "size",
) -> DataFrame:
    """Ticks -> one bar per (date, symbol): first, highest, lowest, last price, total size.

    ``order`` must order the ticks of a day totally; among several order columns
    the price breaks remaining ties.  Partial aggregation runs before the
    shuffle, so a symbol with most of the ticks sends one row per day and input
    partition.
    """
    volume = F.count(F.lit(1)) if size is None else F.sum(size).cast("bigint")
    first, last = _first_and_last(order, (price,), (price,))
    return (
        ticks.groupBy("date", "symbol")
        .agg(
            first[price].alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            last[price].alias("close"),
            volume.alias("volume"),
        )
        .withColumn("adjusted_close", F.col("close"))
        .select("date", "symbol", "open", "high", "low", "close", "adjusted_close", "volume")
    )


def daily_summary(df: DataFrame, order: Sequence[str] = NEWEST) -> DataFrame:
    """One row per (date, symbol) from enriched bars, first and last taken by ``order``.

    After the per-symbol windows the rows are already spread by symbol, which
    this grouping accepts: it adds no shuffle.
    """
    first, last = _first_and_last(
        order, ("open", "daily_return_pct"), ("close", "ma_50", "ma_200", "volatility_30d")
    )
    return df.groupBy("date", "symbol").agg(
        first["open"].alias("daily_open"),
        F.max("high").alias("daily_high"),
        F.min("low").alias("daily_low"),
        last["close"].alias("daily_close"),
        F.sum("volume").alias("daily_volume"),
        first["daily_return_pct"].alias("daily_return_pct"),
        last["ma_50"].alias("ma_50_day"),
        last["ma_200"].alias("ma_200_day"),
        last["volatility_30d"].alias("volatility_30d"),
    )


def gold_layer(
    silver: DataFrame,
    frame: str = "calendar",
    average_as: str | None = None,
    order: Sequence[str] = NEWEST,
    run_ts: Column | None = None,
) -> DataFrame:
    """Clean bars -> returns, averages, volatility, daily summary.

    One shuffle by symbol and one sort serve every window and the summary.
    """
    rows = _with_indicators(silver, frame, average_as)
    return _stamped(daily_summary(rows, order), run_ts)


def _with_indicators(bars: DataFrame, frame: str, average_as: str | None) -> DataFrame:
    return (
        bars.transform(daily_returns)
        .transform(moving_averages, frame, average_as)
        .transform(volatility, frame=frame)
    )


def _stamped(summary: DataFrame, run_ts: Column | None) -> DataFrame:
    return summary.withColumn(
        "_gold_timestamp", F.current_timestamp() if run_ts is None else run_ts
    )


def _last_bar(past: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Date and close of each symbol's last bar: all that a later return reads of it."""
    return past.groupBy(*keys).agg(
        F.max("date").alias("date"), F.max_by("close", "date").alias("close")
    )


def gold_since(
    silver: DataFrame,
    since: DateLike,
    frame: str = "calendar",
    average_as: str | None = None,
    order: Sequence[str] = NEWEST,
    run_ts: Column | None = None,
) -> DataFrame:
    """The rows of ``gold_layer`` from a date on, without computing those before it.

    Windows run over the reach of the longest frame before ``since`` plus one
    row per symbol, its last bar before that.  With ``frame="rows"`` a frame has
    no calendar bound and the whole history is read.
    """
    day = F.col("date")
    if frame == "calendar":
        edge = F.lit(date_bound(since) - dt.timedelta(days=LONG_DAYS - 1))
        before = _last_bar(silver.where(day < edge))
        silver = silver.where(day >= edge).unionByName(before, allowMissingColumns=True)
    rows = _with_indicators(silver, frame, average_as).where(day >= F.lit(date_bound(since)))
    return _stamped(daily_summary(rows, order), run_ts)


def _following(silver: DataFrame, touched: DataFrame) -> DataFrame:
    """(symbol, date, _next): each touched key with the date of the symbol's next bar after it."""
    symbols = touched.select("symbol").distinct()
    first = touched.select(F.min("date")).scalar()
    later = silver.where(F.col("date") > first).join(symbols, "symbol", "left_semi")
    both = later.select("symbol", "date", F.lit(False).alias("_touched")).union(
        touched.select("symbol", "date", F.lit(True))
    )
    # Backwards in time, touched keys before a bar of the same day: what came last is the next bar.
    backwards = Window.partitionBy("symbol").orderBy(F.desc("date"), F.desc("_touched"))
    seen = backwards.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bar = F.when(~F.col("_touched"), F.col("date"))
    return both.withColumn("_next", F.last(bar, ignorenulls=True).over(seen)).where("_touched").drop("_touched")


def merged_ranges(ranges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, first, last): the given date ranges, overlapping and adjoining ones of a key made one."""
    order = Window.partitionBy(*keys).orderBy("first", "last")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.col("first") > F.date_add(F.max("last").over(before), 1), F.lit(True))
    numbered = ranges.withColumn("_apart", apart.cast("int")).withColumn("_island", F.sum("_apart").over(order))
    return numbered.groupBy(*keys, "_island").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("_island")


def influence(silver: DataFrame, touched: DataFrame) -> DataFrame:
    """(symbol, first, last): disjoint date ranges in which changes of the touched keys can be seen.

    A close is read by the averages of ``LONG_DAYS`` from its own date on and, through the
    return of the next bar, by the deviations of ``VOLATILITY_DAYS`` from that bar on.  The
    next bar may lie behind a long gap, so these are two ranges; those that meet are merged.
    """
    reach = F.array(
        F.struct(F.col("date").alias("first"), F.date_add("date", LONG_DAYS - 1).alias("last")),
        F.struct(F.col("_next").alias("first"), F.date_add("_next", VOLATILITY_DAYS - 1).alias("last")),
    )
    ranges = _following(silver, touched.select("symbol", "date").distinct()).select("symbol", F.inline(reach))
    return merged_ranges(ranges.where("first IS NOT NULL"), ("symbol",))


def _with_edge(islands: DataFrame) -> DataFrame:
    """Adds ``_edge``, the first date the frames of an island read."""
    return islands.withColumn("_edge", F.date_sub("first", LONG_DAYS - 1))


def dates_read(islands: DataFrame) -> list[tuple[dt.date, dt.date]]:
    """The date ranges that the islands' frames read, over all symbols.

    They are disjoint, so what is collected is bounded by the calendar.
    """
    # By days: a merge of one row per island would gather them all in one task.
    days = _with_edge(islands).select(F.explode(F.sequence("_edge", "last")).alias("first")).distinct()
    return [(r["first"], r["last"]) for r in merged_ranges(days.withColumn("last", F.col("first"))).collect()]


def idle_islands(silver: DataFrame, islands: DataFrame) -> DataFrame:
    """The islands whose returns may need a close from before the reach of their frames.

    The deviation reads the returns of ``VOLATILITY_DAYS``; a bar between the
    reach of the longest frame and those days is the previous bar of the first.
    ``silver`` needs no dates but those of ``dates_read``.
    """
    early = F.col("date").between(F.col("_edge"), F.date_sub("first", VOLATILITY_DAYS))
    busy = silver.select("symbol", "date").join(_with_edge(islands), "symbol").where(early)
    return islands.join(busy.select("symbol", "first").distinct(), ["symbol", "first"], "left_anti")


def gold_islands(
    recent: DataFrame,
    past: DataFrame,
    islands: DataFrame,
    idle: DataFrame | None = None,
    average_as: str | None = None,
    order: Sequence[str] = NEWEST,
    run_ts: Column | None = None,
) -> DataFrame:
    """The analytics rows dated in the islands (symbol, first, last), equal to those of a full run.

    They are computed from ``recent``, the bars from each island's reach on, plus one carried
    row per island, the last bar before that among ``past``, which only ``lag`` reads.  If the
    islands that need one are known (``idle_islands``), no other symbol's past is used.  An
    island stands in the place of its symbol, so islands of one symbol do not mix.
    """
    within = F.col("date").between(F.col("_edge"), F.col("last"))
    mine = recent.join(_with_edge(islands), "symbol").where(within).drop("_edge", "last")
    before = past.select("symbol", "date", "close").join(_with_edge(islands if idle is None else idle), "symbol")
    carried = _last_bar(before.where(F.col("date") < F.col("_edge")), ("symbol", "first"))
    mine = mine.unionByName(carried, allowMissingColumns=True)
    island = F.struct(F.col("symbol").alias("name"), F.col("first").alias("from"))
    rows = _with_indicators(mine.withColumn("symbol", island).drop("first"), "calendar", average_as)
    summary = daily_summary(rows.where(F.col("date") >= F.col("symbol.from")), order)
    return _stamped(summary.withColumn("symbol", F.col("symbol.name")), run_ts)


def gold_tail(
    silver: DataFrame,
    touched: DataFrame,
    frame: str = "calendar",
    average_as: str | None = None,
    order: Sequence[str] = NEWEST,
    run_ts: Column | None = None,
) -> DataFrame:
    """Gold rows that change when the (symbol, date) pairs in ``touched`` change.

    With calendar frames these are the rows in the islands of ``influence``: their number
    follows the touched dates, however far apart these lie.  With ``frame="rows"`` a frame has no
    calendar bound: all rows from a symbol's first touched date on, from its whole history.
    """
    if frame == "calendar":
        islands = influence(silver, touched)
        return gold_islands(silver, silver, islands, None, average_as, order, run_ts)
    first = touched.groupBy("symbol").agg(F.min("date").alias("_from"))
    rows = _with_indicators(silver.join(first, "symbol"), frame, average_as).where(F.col("date") >= F.col("_from"))
    return _stamped(daily_summary(rows, order), run_ts)


def lag_features(df: DataFrame, lags: Sequence[int] = (1, 2, 3, 5, 10)) -> DataFrame:
    """Add ``close_lag_k`` for each k, counted in the symbol's own bars."""
    return df.withColumns({f"close_lag_{k}": F.lag("close", k).over(_by_date()) for k in lags})


def price_momentum(df: DataFrame, days: int = 5) -> DataFrame:
    """Add ``price_momentum_{days}d``: close against the close that many bars ago, minus one."""
    return df.withColumn(
        f"price_momentum_{days}d",
        F.try_divide(F.col("close"), F.lag("close", days).over(_by_date())) - 1,
    )
