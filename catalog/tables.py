"""The given star-schema and event tables seen as market data.

A tick is a line item: its symbol is the supplier's nation, its price the
extended price, its size the quantity.  The sector of a symbol is its region,
and every supplier row is one metadata update of its nation's symbol.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.operators.bronze import with_ingestion
from barlake.operators.gold import daily_bars, gold_layer
from barlake.operators.silver import NEWEST

TICK_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
EVENT_ORDER = ("ts", "event_id")
# Versions of one bar share load times now and then; these make their order total.
VERSION_ORDER = (*NEWEST, "l_linenumber", "l_partkey", "l_suppkey", "close")
EVENT_VERSION_ORDER = (*NEWEST, "event_id")
AS_OF = "2001-11-04"
EVENTS_AS_OF = "2024-01-30"
LOADED_AT = dt.datetime(2001, 11, 5, 6, 0)
LOADED_LATER = dt.datetime(2001, 11, 6, 6, 0)
# Prices have two digits and stay below a million: closes of this type sum exactly.
EXACT = "decimal(8,2)"

# Column types of the given tables.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; with its schema declared, no file is opened before the query runs."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def traded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the symbol they trade.

    The line items meet the supplier scan directly, so the planner sees each
    side's file size and broadcasts the suppliers only while they are small.
    """
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .withColumn("date", F.to_date("l_shipdate"))
        .withColumnRenamed("n_name", "symbol")
        .drop("s_suppkey", "s_nationkey", "n_nationkey")
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return traded_lines(spark, sf_dir).select(
        "date",
        "symbol",
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("size"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_bars(ticks(spark, sf_dir), TICK_ORDER)


def loaded_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with load metadata, all from one load."""
    return with_ingestion(bars(spark, sf_dir), LOADED_AT)


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytics layer over all bars, without its run time."""
    return gold_layer(loaded_bars(spark, sf_dir), average_as=EXACT).drop("_gold_timestamp")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick as a version of its (symbol, date) bar, loaded some time after the day began."""
    price = F.col("l_extendedprice")
    loaded = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(secs=F.col("l_orderkey"))
    lines = traded_lines(spark, sf_dir).select(
        "date",
        "symbol",
        price.alias("open"),
        price.alias("high"),
        price.alias("low"),
        price.alias("close"),
        price.alias("adjusted_close"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        loaded.alias("_loaded"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
    return with_ingestion(lines, F.col("_loaded")).drop("_loaded")


def dirty_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions as raw text, spoiled where the line item's own values say so."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    loaded = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(secs=F.col("l_orderkey"))
    sign = F.when((tax == 0.03) & (discount == 0.03), -1).otherwise(1)
    text = lambda c: c.cast("string")
    lines = traded_lines(spark, sf_dir).select(
        F.when(~((F.col("l_quantity") == 13) & (tax == 0)), F.col("date")).alias("date"),
        F.when(~((F.col("l_quantity") == 17) & (tax == 0.01)), F.col("symbol")).alias("symbol"),
        text(price).alias("open"),
        text(price + F.when(discount == 0.07, -5).otherwise(1)).alias("high"),
        text(price + F.when(discount == 0.06, 5).otherwise(-1)).alias("low"),
        F.when(discount == 0.10, "n/a")
        .when(discount == 0.09, "NaN")
        .when(discount == 0.08, None)
        .otherwise(text(price))
        .alias("close"),
        text(price).alias("adjusted_close"),
        text(sign * F.col("l_quantity").cast("bigint")).alias("volume"),
        loaded.alias("_loaded"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )
    return with_ingestion(lines, F.col("_loaded")).drop("_loaded")


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw metadata updates: one per supplier, spread over the traded years by its balance."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    debtor = F.col("s_acctbal") < 0
    day = F.date_add(F.lit(dt.date(1995, 1, 1)), F.floor(F.col("s_acctbal") / 4).cast("int"))
    return (
        suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("symbol"),
            F.col("s_name").alias("company_name"),
            F.col("r_name").alias("sector"),
            F.when(debtor, "n/a")
            .otherwise(F.col("s_acctbal").cast("decimal(12,2)").cast("string"))
            .alias("market_cap"),
            F.when(debtor, "unknown").otherwise(day.cast("string")).alias("updated_at"),
        )
    )


def _as_ticks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.to_date("ts").alias("date"),
        F.col("user_id").cast("string").alias("symbol"),
        F.col("value").alias("price"),
        F.lit(1).cast("bigint").alias("size"),
        "event_id",
    )


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_ticks(table(spark, sf_dir, "events"))


def landed_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """A folder of landed events as a stream."""
    return _as_ticks(spark.readStream.schema(SCHEMAS["events"]).parquet(folder))


def event_versions(event_ticks: DataFrame) -> DataFrame:
    """Event ticks as versions of their (symbol, date) bar, loaded when they happened."""
    price = F.col("price")
    return with_ingestion(
        event_ticks.select(
            "date",
            "symbol",
            price.alias("open"),
            price.alias("high"),
            price.alias("low"),
            price.alias("close"),
            price.alias("adjusted_close"),
            F.col("size").alias("volume"),
            "ts",
            "event_id",
        ),
        F.col("ts"),
    ).drop("ts")
