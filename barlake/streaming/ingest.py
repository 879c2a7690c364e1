"""Landing a stream in the raw layer, and dropping retransmitted records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from barlake.operators.bronze import with_ingestion
from barlake.schemas import OHLC
from barlake.sources.files import CORRUPT
from barlake.sources.layers import MONTH

# Process what has arrived and stop; pass another trigger to keep running.
AVAILABLE_NOW = {"availableNow": True}


def parse_records(stream: DataFrame, schema: StructType = OHLC, column: str = "value") -> DataFrame:
    """JSON messages, text or bytes as a message queue delivers them, to typed columns.

    A field that does not parse is NULL and its message is kept in
    ``_corrupt_record``.
    """
    optional = StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
    fields = F.from_json(
        F.col(column).cast("string"),
        optional.add(CORRUPT, StringType()),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return stream.select(fields.alias("_record")).select("_record.*")


def start_bronze_append(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition: str = "date",
    trigger: Mapping[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append a stream from any source to a raw table, each record exactly once.

    The file sink keeps its own log of committed files, and readers of the path
    see only those: give the stream a path of its own and read it together with
    batch loads through ``union_sources``.
    """
    rows = with_ingestion(stream)
    if partition == "month":
        rows = rows.withColumn(MONTH, F.trunc("date", "month"))
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(MONTH if partition == "month" else partition)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def dedup_stream(
    stream: DataFrame, keys: Sequence[str], time: str = "ts", delay: str = "1 day"
) -> DataFrame:
    """First record per key; state is kept for ``delay`` behind the newest event time.

    Copies must arrive within ``delay`` of each other.  Records behind the
    watermark are dropped as too late.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
