"""Exact median per group without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Bins per unit of log1p(|value|).  A double has |log1p| < 710, so a group has
# at most 2 * 710 * BINS_PER_LOG bins however many rows it holds.
BINS_PER_LOG = 1000


def grouped_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "median"
) -> DataFrame:
    """One row per group with the exact median of the non-missing values.

    Rows are counted per value bin, with a map-side step; the one or two bins
    that hold the middle ranks then pick the few rows that matter, which are
    counted per distinct value.  A group with a third of all rows is spread over
    its bins, and the only per-group sort is over the bounded list of bin
    totals.  The list of picked bins has at most two rows per group: while Spark
    finds it small it is broadcast, and the rows are not shuffled at all.
    """
    keys = list(keys)
    rows = (
        df.select(*keys, F.col(value).cast("double").alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .withColumn(
            "_bin", F.floor(F.signum("_v") * F.log1p(F.abs("_v")) * BINS_PER_LOG)
        )
    )
    by_bin = Window.partitionBy(*keys).orderBy("_bin")
    whole = Window.partitionBy(*keys)
    bins = (
        rows.groupBy(*keys, "_bin")
        .agg(F.count(F.lit(1)).alias("_in_bin"))
        .withColumn("_before", F.sum("_in_bin").over(by_bin) - F.col("_in_bin"))
        .withColumn("_total", F.sum("_in_bin").over(whole))
        .withColumn("_low", F.expr("(_total + 1) DIV 2"))
        .withColumn("_high", F.expr("_total DIV 2 + 1"))
        .where("_before < _high AND _before + _in_bin >= _low")
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            F.col("_bin").alias("_b"),
            "_before",
            "_low",
            "_high",
        )
    )
    same_bin = F.col("_bin") == F.col("_b")
    for i, k in enumerate(keys):
        same_bin = same_bin & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    in_bin = Window.partitionBy(*keys, "_bin").orderBy("_v")
    ranked = (
        rows.join(bins, same_bin)
        .groupBy(*keys, "_bin", "_v", "_before", "_low", "_high")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_last", F.col("_before") + F.sum("_n").over(in_bin))
    )

    def at(rank: str) -> Column:
        holds = (F.col("_last") >= F.col(rank)) & (F.col("_last") - F.col("_n") < F.col(rank))
        return F.max(F.when(holds, F.col("_v")))

    return ranked.groupBy(*keys).agg(((at("_low") + at("_high")) / 2).alias(name))
