"""Parquet tables whose loads changed the types of their columns.

One distributed pass reads the footer of every file; files of one layout are then scanned
together, their columns cast to the least type that holds the values of all layouts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from barlake.sources.files import union_sources
from barlake.sources.layers import MONTH

# Digits of the whole numbers.
DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}


def common_type(types: Iterable[DataType]) -> DataType:
    """The least type that takes the values of all given ones.

    Whole numbers widen to the largest of them; with decimals, to a decimal that holds both
    or, past 38 digits, to double; with floating-point numbers, to double.  Dates become
    timestamps beside timestamps; anything else becomes text.  Nested types must agree.
    """

    def wider(a: DataType, b: DataType) -> DataType:
        if a == b or isinstance(b, NullType):
            return a
        if isinstance(a, NullType):
            return b
        if any(isinstance(t, (ArrayType, MapType, StructType)) for t in (a, b)):
            raise TypeError(f"nested types that differ: {a.simpleString()}, {b.simpleString()}")
        if a in DIGITS and b in DIGITS:
            return max(a, b, key=DIGITS.get)
        if all(t in DIGITS or isinstance(t, DecimalType) for t in (a, b)):
            scale = max(getattr(t, "scale", 0) for t in (a, b))
            whole = max(t.precision - t.scale if isinstance(t, DecimalType) else DIGITS[t] for t in (a, b))
            return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
        if all(t in DIGITS or isinstance(t, (DecimalType, FloatType, DoubleType)) for t in (a, b)):
            return DoubleType()
        if all(isinstance(t, (DateType, TimestampType, TimestampNTZType)) for t in (a, b)):
            return TimestampNTZType() if TimestampType() not in (a, b) else TimestampType()
        return StringType()

    return reduce(wider, types, NullType())


def _uri(path: str) -> str:
    scheme, _, place = path.partition(":")
    place = quote("/" + place.lstrip("/")) if scheme == "file" else quote(place)
    return f"file://{place}" if scheme == "file" else f"{'s3' if scheme == 's3a' else scheme}:{place}"


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(path) -> (path, layout): the names and types in each file's footer."""
    from pyarrow import fs, parquet

    for files in batches:
        layouts = []
        for path in files["path"]:
            store, place = fs.FileSystem.from_uri(_uri(path))
            with store.open_input_file(place) as file:
                schema = parquet.read_schema(file)
            layouts.append("\n".join(f"{field.name}\t{field.type}" for field in schema))
        yield files.assign(layout=layouts)


def file_layouts(spark: SparkSession, path: str) -> DataFrame:
    """(path, layout): every Parquet file below a folder with the names and types it holds."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(path)
    return files.select("path").mapInPandas(_footers, "path string, layout string")


def _scans(spark: SparkSession, path: str) -> list[tuple[int, DataFrame]]:
    """For each layout the number of its files, and their scan.

    What reaches the driver are the names of the files, which its file index holds anyway,
    and one text per layout: as many as the table had schemas.
    """
    layouts: dict[str, list[str]] = {}
    for row in file_layouts(spark, path).collect():
        layouts.setdefault(row["layout"], []).append(row["path"])
    if not layouts:
        raise ValueError(f"no Parquet files under {path}")
    widest_first = sorted(layouts, key=lambda text: (-text.count("\n"), text))
    reader = spark.read.option("basePath", path)
    return [(len(layouts[text]), reader.parquet(*sorted(layouts[text]))) for text in widest_first]


def _types(scans: Sequence[DataFrame]) -> dict[str, tuple[str, list[DataType]]]:
    """Lower-case name -> (the name as first met, its type in every scan that has it)."""
    found: dict[str, tuple[str, list[DataType]]] = {}
    for scan in scans:
        for field in scan.schema.fields:
            found.setdefault(field.name.lower(), (field.name, []))[1].append(field.dataType)
    return found


def read_widened(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a Parquet table whose files disagree on columns or their types.

    Names match case-insensitively; a column some files lack is NULL there.  Filters and
    column selection reach the scan of every layout, partition filters included.  A column that
    holds text in some files is text.
    """
    scans = [scan for _, scan in _scans(spark, path)]
    wanted = {low: (name, common_type(types)) for low, (name, types) in _types(scans).items() if low != MONTH}
    frames = []
    for scan in scans:
        own = {name.lower(): name for name in scan.columns}
        frames.append(
            scan.select(
                *[
                    F.col(f"`{own[low]}`").cast(kind).alias(name)
                    for low, (name, kind) in wanted.items()
                    if low in own
                ]
            )
        )
    return union_sources(frames)


def type_changes(spark: SparkSession, path: str) -> DataFrame:
    """(column, type, files, common): the columns that files hold in different types."""
    scans = _scans(spark, path)
    rows = []
    for low, (name, types) in _types([scan for _, scan in scans]).items():
        if len(set(types)) == 1:
            continue
        common, files = common_type(types).simpleString(), {}
        for n, scan in scans:
            for field in scan.schema.fields:
                if field.name.lower() == low:
                    kind = field.dataType.simpleString()
                    files[kind] = files.get(kind, 0) + n
        rows += [(name, kind, n, common) for kind, n in sorted(files.items())]
    return spark.createDataFrame(rows, "column string, type string, files bigint, common string")
