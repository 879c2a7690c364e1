"""A stored log of runs: what each wrote and refused, how good it was and how long it took."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from barlake.sources.layers import load_metrics

LOG = (
    "run_id string, layer string, status string, rows bigint, rejected bigint, passed bigint, "
    "first_date date, last_date date, started timestamp, seconds double"
)
LAYERS = ("bronze", "silver", "gold")
OBSERVED = "load"

Written = Mapping[str, Mapping[str, object]]


def log_run(
    spark: SparkSession,
    log: str,
    run_id: str,
    written: Written,
    started: dt.datetime,
    seconds: float,
    status: str = "done",
) -> None:
    """Store what a run wrote, a row per layer; a run logged again under its id replaces its rows.

    ``written`` is what the jobs return, counted by the writes themselves.  A run that wrote
    nothing leaves one row without a layer.
    """
    names = ("rows", "rejected", "passed", "first_date", "last_date")
    rows = [(run_id, layer, status, *[m.get(n) for n in names], started, seconds) for layer, m in written.items()]
    rows = rows or [(run_id, None, status, *[None for _ in names], started, seconds)]
    _store(spark, log, rows)


def _store(spark: SparkSession, log: str, rows: Sequence[tuple]) -> None:
    # Rows of a run make one file.
    out = spark.createDataFrame(rows, LOG).repartition("run_id").write.partitionBy("run_id")
    out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(log)


def run_logged(
    spark: SparkSession, log: str, run_id: str, run: Callable[[], Written], started: dt.datetime | None = None
) -> Written:
    """Carry out a run and log it, also if it fails; the error is raised again."""
    started, clock = started or dt.datetime.now(dt.timezone.utc), time.monotonic()
    try:
        written = run()
    except Exception:
        log_run(spark, log, run_id, {}, started, time.monotonic() - clock, "failed")
        raise
    log_run(spark, log, run_id, written, started, time.monotonic() - clock)
    return written


def observed(stream: DataFrame) -> DataFrame:
    """A stream of bars that counts, per batch, what ``log_progress`` stores."""
    return stream.observe(OBSERVED, *load_metrics(stream))


def log_progress(log: str, query: StreamingQuery, layer: str = "bronze") -> None:
    """Store the batches a stream reports, each as a run of its own.

    The run id is the query's name (or id) and the batch number, so a batch reported again
    replaces its row.  Counts are those of ``observed``; a stream without it reports its
    input rows only.  Spark keeps the last 100 reports: call this at least that often.
    """
    rows = []
    for p in query.recentProgress:
        seen = (p.observedMetrics or {}).get(OBSERVED)
        seen = seen.asDict() if seen is not None else {"rows": p.numInputRows}
        started = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        # Reports carry dates as text.
        dates = [dt.date.fromisoformat(seen[n]) if seen.get(n) else None for n in ("first_date", "last_date")]
        counts = [*[seen.get(n) for n in ("rows", "rejected", "passed")], *dates]
        took = p.durationMs.get("triggerExecution", 0) / 1000
        rows.append((f"{query.name or query.id}-{p.batchId}", layer, "done", *counts, started, took))
    # A batch may be reported more than once, as when it waits for data: the last report counts.
    rows = list({row[0]: row for row in rows if row[3]}.values())
    if rows:
        _store(SparkSession.active(), log, rows)


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(LOG).parquet(log)


def run_history(log: DataFrame, layers: Sequence[str] = LAYERS) -> DataFrame:
    """One row per run in order of time: rows per layer, rejects, shares and trends.

    ``error_rate`` is the share of the records of the first layer that were refused,
    ``quality_score`` the share of checked rows that pass, both NULL where nothing was
    counted; ``loaded_so_far`` adds up the first layer over the runs; ``score_change`` and
    ``times_as_long`` compare a run with the one before it that is done.  The trends are a
    window over all runs: a log has as many rows there as there were runs, not records.
    """
    first = F.col("layer") == layers[0]
    rows = log.groupBy("run_id").agg(
        F.min("started").alias("started"),
        F.max("seconds").alias("seconds"),
        F.max("status").alias("status"),
        *[F.sum(F.when(F.col("layer") == name, F.col("rows"))).alias(f"{name}_rows") for name in layers],
        F.sum(F.when(first, F.col("rejected"))).alias("rejected"),
        F.try_divide(F.sum(F.when(first, F.col("rejected"))), F.sum(F.when(first, F.col("rows")))).alias("error_rate"),
        F.try_divide(F.sum("passed"), F.sum(F.when(F.col("passed").isNotNull(), F.col("rows")))).alias("quality_score"),
    )
    over = Window.orderBy("started", "run_id")
    past = over.rowsBetween(Window.unboundedPreceding, -1)
    before = lambda name: F.last(F.when(F.col("status") == "done", F.col(name)), ignorenulls=True).over(past)
    return rows.withColumns(
        {
            "loaded_so_far": F.sum(f"{layers[0]}_rows").over(over.rowsBetween(Window.unboundedPreceding, 0)),
            "score_change": F.col("quality_score") - before("quality_score"),
            "times_as_long": F.try_divide(F.col("seconds"), before("seconds")),
        }
    )
