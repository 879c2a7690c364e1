"""Declared table schemas and by-name conformance of arbitrary input to them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names, types and nullability of the layer tables.
OHLC = StructType(
    [
        StructField("date", DateType(), False),
        StructField("symbol", StringType(), False),
        StructField("open", DoubleType(), True),
        StructField("high", DoubleType(), True),
        StructField("low", DoubleType(), True),
        StructField("close", DoubleType(), True),
        StructField("adjusted_close", DoubleType(), True),
        StructField("volume", LongType(), True),
    ]
)

SYMBOL_META = StructType(
    [
        StructField("symbol", StringType(), False),
        StructField("company_name", StringType(), True),
        StructField("sector", StringType(), True),
        StructField("market_cap", StringType(), True),
        StructField("updated_at", StringType(), True),
    ]
)

BRONZE = StructType(
    OHLC.fields
    + [
        StructField("_ingestion_timestamp", TimestampType(), True),
        StructField("_ingestion_date", DateType(), True),
    ]
)

SILVER = StructType(
    BRONZE.fields
    + [
        StructField("_quality_check_passed", BooleanType(), True),
        StructField("_silver_transformation_timestamp", TimestampType(), True),
    ]
)

GOLD = StructType(
    [
        StructField("date", DateType(), False),
        StructField("symbol", StringType(), False),
        StructField("daily_open", DoubleType(), True),
        StructField("daily_high", DoubleType(), True),
        StructField("daily_low", DoubleType(), True),
        StructField("daily_close", DoubleType(), True),
        StructField("daily_volume", LongType(), True),
        StructField("daily_return_pct", DoubleType(), True),
        StructField("ma_50_day", DoubleType(), True),
        StructField("ma_200_day", DoubleType(), True),
        StructField("volatility_30d", DoubleType(), True),
        StructField("_gold_timestamp", TimestampType(), True),
    ]
)


def conform(
    df: DataFrame,
    schema: StructType,
    rename: Mapping[str, str] | None = None,
    keep_extra: bool = False,
) -> DataFrame:
    """Project ``df`` onto ``schema`` by column name, never by position.

    ``rename`` maps source names to schema names ("Adj Close" ->
    "adjusted_close").  Names match case-insensitively.  A value that does not
    parse becomes NULL, a column the source lacks becomes a typed NULL, and
    ``keep_extra`` passes columns outside the schema through unchanged.
    """
    if rename:
        df = df.withColumnsRenamed(dict(rename))
    actual = {name.lower(): name for name in df.columns}
    wanted = {field.name.lower() for field in schema.fields}
    columns = [
        (
            F.col(f"`{actual[field.name.lower()]}`").try_cast(field.dataType)
            if field.name.lower() in actual
            else F.lit(None).cast(field.dataType)
        ).alias(field.name)
        for field in schema.fields
    ]
    if keep_extra:
        columns += [F.col(f"`{name}`") for low, name in actual.items() if low not in wanted]
    return df.select(*columns)
