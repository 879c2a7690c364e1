"""Which loads an analytics row rests on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barlake.functions import over_history, over_prefix
from barlake.operators.gold import LONG_DAYS, VOLATILITY_DAYS
from barlake.operators.silver import KEYS


def gold_provenance(
    silver: DataFrame, frame: str = "calendar", load: str = "_ingestion_timestamp"
) -> DataFrame:
    """For each analytics row the earliest and latest load that reached it, and what it read.

    A row reads the bars of the longest frame and, for the first return in the volatility
    frame, the bar before that one, which may lie further back than either frame.  The load
    times pass through the same windows as the values: one exchange by symbol and one sort.
    ``first_bar`` is the oldest date read, ``bars_read`` counts the bars.  A bar without a load
    time counts as read, but names no load.
    """
    by_date = Window.partitionBy("symbol").orderBy("date")
    rows = silver.select(*KEYS, F.col(load).alias("_load")).withColumns(
        {"_load_before": F.lag("_load").over(by_date), "_date_before": F.lag("date").over(by_date)}
    )
    behind = over_history("min(_date_before)", VOLATILITY_DAYS, frame)
    oldest = over_history("min(date)", LONG_DAYS, frame)
    rows = rows.withColumns(
        {
            "earliest_load": F.least(
                over_history("min(_load)", LONG_DAYS, frame), over_history("min(_load_before)", VOLATILITY_DAYS, frame)
            ),
            "latest_load": F.greatest(
                over_history("max(_load)", LONG_DAYS, frame), over_history("max(_load_before)", VOLATILITY_DAYS, frame)
            ),
            "first_bar": F.least(oldest, behind),
            "bars_read": over_prefix("count(1)", LONG_DAYS, frame) + F.coalesce((behind < oldest).cast("bigint"), F.lit(0)),
        }
    )
    return rows.drop("_load", "_load_before", "_date_before")


def outdated(gold: DataFrame, provenance: DataFrame, computed: str = "_gold_timestamp") -> DataFrame:
    """(date, symbol, latest_load, computed): analytics rows that are missing, or older than a load they rest on.

    Both sides hold one row per key, so the join pairs each row once.  Its keys are what
    ``refresh_gold`` takes as touched.
    """
    held = gold.select(*KEYS, F.col(computed).alias("computed"))
    rows = provenance.select(*KEYS, "latest_load").join(held, list(KEYS), "left")
    return rows.where(F.col("computed").isNull() | (F.col("latest_load") > F.col("computed")))
