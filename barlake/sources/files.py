"""Landed bar files and generated bars."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from barlake.functions import date_bound, day_between
from barlake.functions.expressions import DateLike
from barlake.schemas import OHLC, conform

CORRUPT = "_corrupt_record"


def read_bars(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "csv",
    symbols: Sequence[str] | None = None,
    start: DateLike | None = None,
    end: DateLike | None = None,
    rename: Mapping[str, str] | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Scan landed bar files into the declared schema; bounds that are not given cut nothing.

    Text formats are read permissively: a field that does not parse is NULL and the raw
    record is kept in ``_corrupt_record``.  A record without a readable date or symbol fails
    no filter, since nobody can say whether it belongs: ``rejected`` lists such records.
    CSV files may differ in their headers; each is read by its own, and a column some files
    lack is NULL there.  A requested symbol without rows is no error (``absent_symbols``).
    """
    options = dict(options or {})
    if fmt == "csv":
        frames = [
            _read_text(spark, files, fmt, options | {"header": True}, _source_schema(rename, names))
            for names, files in _layouts(spark, paths, options).items()
        ]
        frames = frames or [spark.createDataFrame([], OHLC.add(CORRUPT, StringType()))]  # files without a line
        raw = union_sources([conform(f, OHLC, rename, keep_extra=True) for f in frames])
    elif fmt == "json":
        raw = conform(_read_text(spark, _listed(paths), fmt, options, _source_schema(rename)), OHLC, rename, True)
    else:
        raw = conform(spark.read.format(fmt).options(**options).load(_listed(paths)), OHLC, rename, True)
    unknown = _unplaced()
    if start is not None or end is not None:
        raw = raw.where(day_between(start, end) | unknown)
    if symbols is not None:
        raw = raw.where(F.col("symbol").isin(list(symbols)) | unknown)
    return raw


def _unplaced() -> Column:
    return F.col("date").isNull() | F.col("symbol").isNull()


def rejected(bars: DataFrame) -> DataFrame:
    """The landed records without a readable date or symbol."""
    return bars.where(_unplaced())


def readable(bars: DataFrame) -> DataFrame:
    """The landed records with a readable date and symbol."""
    return bars.where(~_unplaced())


def _layouts(
    spark: SparkSession, paths: str | Sequence[str], options: Mapping[str, object]
) -> dict[tuple[str, ...], list[str]]:
    """Header -> files that have it.

    One distributed pass finds the first line of every file, as a hash; a file of each
    different one is then opened for its header.  What reaches the driver are the names of the
    files, which its file index holds anyway.
    """
    plain = {k: v for k, v in options.items() if k.lower() in ("linesep", "recursivefilelookup", "pathglobfilter")}
    lines = spark.read.format("text").options(**plain).load(_listed(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    # The first block of a file is read by one task, in order.  The place of a line there and the
    # line's hash make one fixed-width number, so its minimum is found by hash aggregation.
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).cast("decimal(20,0)")
    line = F.xxhash64("value").cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    shift = F.lit(str(1 << 64)).cast("decimal(20,0)")
    first = lines.where("start = 0 AND trim(value) != ''").select("file", (place * shift + line).cast("decimal(38,0)").alias("line"))
    headers = first.groupBy("file").agg(F.min("line").alias("line")).select("file", (F.col("line") % shift).alias("line"))
    files: dict[object, list[str]] = {}
    for row in sorted(headers.collect()):
        files.setdefault(row["line"], []).append(unquote(row["file"]))
    reader = spark.read.format("csv").options(**options | {"header": True})
    found: dict[tuple[str, ...], list[str]] = {}
    for names in files.values():
        found.setdefault(tuple(reader.load(names[0]).columns), []).extend(names)
    return found


def _read_text(
    spark: SparkSession, paths, fmt: str, options: Mapping[str, object], schema: StructType
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(schema.add(CORRUPT, StringType())).load(paths)


def absent_symbols(bars: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """The requested symbols that have no bar at all."""
    wanted = bars.sparkSession.createDataFrame([(s,) for s in symbols], "symbol string")
    return wanted.join(bars.select("symbol").distinct(), "symbol", "left_anti")


def _listed(paths: str | Sequence[str]) -> str | list[str]:
    return paths if isinstance(paths, str) else list(paths)


def _source_schema(
    rename: Mapping[str, str] | None, names: Sequence[str] | None = None
) -> StructType:
    """The declared bar types under the names, and in the order, of the source files.

    Source columns that are no part of a bar are read as text.
    """
    target = {source.lower(): name.lower() for source, name in (rename or {}).items()}
    if names is None:
        source = {name: s for s, name in (rename or {}).items()}
        names = [source.get(field.name, field.name) for field in OHLC.fields]
    kinds = {field.name: field.dataType for field in OHLC.fields}
    kind = lambda name: kinds.get(target.get(name.lower(), name.lower()), StringType())
    return StructType([StructField(name, kind(name), True) for name in names])


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by name; columns some of them lack become NULL, duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sample_bars(
    spark: SparkSession,
    num_stocks: int = 10,
    num_days: int = 365,
    end: DateLike | None = None,
    seed: int = 0,
) -> DataFrame:
    """Generated bars, one per symbol and day, for trials without market data.

    Close is normal with mean 100 and deviation 20; open, high and low are fixed
    multiples of it; volume is uniform from one million up to ten million.
    """
    last = date_bound(end or dt.date.today())
    first = last - dt.timedelta(days=num_days - 1)
    close = F.col("close")
    return (
        spark.range(num_stocks)
        .select(
            F.format_string("STOCK_%03d.NS", "id").alias("symbol"),
            F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"),
        )
        # Spread and mean of the close, factors of the other prices, volumes.
        .withColumn("close", F.randn(seed) * 20 + 100)
        .select(
            "date",
            "symbol",
            (close * 0.99).alias("open"),
            (close * 1.05).alias("high"),
            (close * 0.95).alias("low"),
            "close",
            close.alias("adjusted_close"),
            F.floor(F.rand(seed + 1) * 9_000_000 + 1_000_000).alias("volume"),
        )
    )
