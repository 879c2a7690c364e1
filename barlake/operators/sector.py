"""Symbol metadata and sector analytics.

Joins carry no broadcast hint: Spark broadcasts the metadata while its size is
under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges,
splitting a hot symbol through its adaptive skew-join handling.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from barlake.operators.silver import latest_version
from barlake.schemas import SYMBOL_META, conform

ATTRIBUTES = ("company_name", "sector", "market_cap")


def typed_metadata(raw: DataFrame) -> DataFrame:
    """Metadata with parsed market cap and update time; text that does not parse becomes NULL."""
    return conform(raw, SYMBOL_META).withColumns(
        {
            "market_cap": F.col("market_cap").try_cast("decimal(20,2)"),
            "updated_at": F.col("updated_at").try_cast("timestamp"),
        }
    )


def symbol_dim(raw: DataFrame) -> DataFrame:
    """The newest metadata row of each symbol."""
    order = ("updated_at", "company_name", "sector", "market_cap")
    return latest_version(typed_metadata(raw), ("symbol",), order)


def with_sector(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """Add the sector; a symbol without metadata keeps its rows with a NULL sector."""
    return bars.join(dim.select("symbol", "sector"), "symbol", "left")


def sector_daily(enriched: DataFrame, dim: DataFrame) -> DataFrame:
    """Per sector and day: members, mean and median return, volume.

    One aggregation: a sector has one row per symbol and day, so a median's group is bounded
    by the number of symbols.
    """
    rows = with_sector(enriched, dim)
    return rows.groupBy("sector", "date").agg(
        F.count(F.lit(1)).alias("members"),
        F.avg("daily_return_pct").alias("mean_return"),
        F.median("daily_return_pct").alias("median_return"),
        F.sum("volume").alias("volume"),
    )


def sector_rollup(enriched: DataFrame, dim: DataFrame) -> DataFrame:
    """Volume, bars and mean return per symbol, per sector and overall.

    ``level`` is 0 for a symbol row, 1 for a sector row, 3 for the total, so a
    NULL sector of unknown symbols is told apart from a total.  Bars are summed
    per symbol first: the join and the roll-up see one row per symbol.
    """
    per_symbol = enriched.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("_bars"),
        F.sum("volume").alias("_volume"),
        F.sum("daily_return_pct").alias("_returned"),
        F.count("daily_return_pct").alias("_returns"),
    )
    return (
        with_sector(per_symbol, dim)
        .rollup("sector", "symbol")
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum("_bars").alias("bars"),
            F.sum("_volume").alias("volume"),
            F.try_divide(F.sum("_returned"), F.sum("_returns")).alias("mean_return"),
        )
    )


def asof_metadata(
    bars: DataFrame, raw: DataFrame, attributes: Sequence[str] = ATTRIBUTES
) -> DataFrame:
    """Each bar with the metadata in force on its date: the newest update up to that day.

    Updates are reduced to one per symbol and day, then laid among the bars in
    date order and carried forward.  A symbol's run is bounded by the calendar,
    and no bar is paired with more than one update.
    """
    updates = (
        typed_metadata(raw)
        .withColumn("_day", F.to_date("updated_at"))
        .where(F.col("_day").isNotNull())
    )
    updates = latest_version(updates, ("symbol", "_day"), ("updated_at", *ATTRIBUTES)).select(
        "symbol",
        F.col("_day").alias("date"),
        F.struct(*attributes).alias("_in_force"),
        F.lit(0).alias("_kind"),
    )
    so_far = (
        Window.partitionBy("symbol")
        .orderBy("date", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        bars.withColumn("_kind", F.lit(1))
        .unionByName(updates, allowMissingColumns=True)
        .withColumn("_in_force", F.last("_in_force", ignorenulls=True).over(so_far))
        .where("_kind = 1")
        .withColumns({name: F.col(f"_in_force.{name}") for name in attributes})
        .drop("_in_force", "_kind")
    )
