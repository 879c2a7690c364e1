"""Landed files read once each, with Spark's file source as the ledger of what was read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from barlake.operators.bronze import with_ingestion
from barlake.plans.jobs import append_once
from barlake.sources.files import read_bars
from barlake.sources.scratch import delete_path, path_exists
from barlake.streaming.ingest import AVAILABLE_NOW

# What a binary file source tells of a file.
FILE = "path string, modificationTime timestamp, length bigint, content binary"


def start_landing(
    spark: SparkSession,
    folder: str,
    path: str,
    checkpoint: str,
    staging: str,
    fmt: str = "csv",
    rename: Mapping[str, str] | None = None,
    options: Mapping[str, object] | None = None,
    files_per_batch: int = 1000,
    partition: str = "date",
    trigger: Mapping[str, object] = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append the bars of files that are new in ``folder`` to the raw layer, each file once.

    The checkpoint knows the files of earlier runs, so a run reads only those landed since, in
    batches of at most ``files_per_batch``.  The stream itself carries the names of new files, not
    their content: each batch reads its files with ``read_bars``, by their own headers and in
    any format.  A batch is staged with its load time before it is appended, so one that
    was interrupted is completed, not loaded twice.
    """
    names = (
        spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", files_per_batch)
        .load(folder).select("path")
    )

    def land(batch: DataFrame, batch_id: int) -> None:
        if batch_id > 0:
            delete_path(spark, f"{staging}/{batch_id - 1}")
        stage = f"{staging}/{batch_id}"
        if not path_exists(spark, f"{stage}/_SUCCESS"):
            files = [row["path"] for row in batch.collect()]  # at most files_per_batch names
            if not files:
                return
            rows = with_ingestion(read_bars(spark, files, fmt, rename=rename, options=options))
            rows.write.mode("overwrite").parquet(stage)
        append_once(spark, path, spark.read.parquet(stage), partition)

    return names.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(**trigger).start()
