"""Data-quality checks, profiling and run metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import NumericType, StructType

from barlake.functions import any_missing, date_bound, day_between, missing
from barlake.functions.expressions import DateLike
from barlake.operators.silver import CRITICAL, KEYS


# Tasks that merge the profile sketches of all input partitions.
MERGE_SLOTS = 1000
# Size of a quartile sketch: ranks are right to about 0.2 percent.
QUARTILE_K = 2000


def _long_form(df: DataFrame, structs: Sequence) -> DataFrame:
    """Turn one aggregated row into one row per struct."""
    return df.agg(F.array(*structs).alias("_all")).select(F.inline("_all"))


def null_counts(df: DataFrame, columns: Sequence[str] = CRITICAL) -> DataFrame:
    """Per column: rows and missing values (NULL or NaN), in one pass."""
    return _long_form(
        df,
        [
            F.struct(
                F.lit(name).alias("column"),
                F.count(F.lit(1)).alias("rows"),
                F.count_if(missing(df, name)).alias("missing"),
            )
            for name in columns
        ],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def distinct_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Number of different keys."""
    return df.select(*keys).distinct().agg(F.count(F.lit(1)).alias("distinct_keys"))


def quality_score(
    df: DataFrame, keys: Sequence[str] = KEYS, critical: Sequence[str] = CRITICAL
) -> DataFrame:
    """One row: incomplete rows, surplus duplicate rows, and the mean of both clean shares.

    Grouping by key with map-side counts answers both questions in one pass.
    """
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(any_missing(df, critical)).alias("_missing"),
    )
    return (
        per_key.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("_missing"), F.lit(0)).alias("missing_rows"),
            F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_rows"),
        )
        .withColumn("score_points", F.expr("2 * rows - missing_rows - duplicate_rows"))
        .withColumn("score_maximum", F.expr("2 * rows"))
        .withColumn("score", F.try_divide(F.col("score_points"), F.col("score_maximum")))
    )


def schema_differences(df: DataFrame, schema: StructType) -> DataFrame:
    """Per column that departs from the declared schema: how, and how many values do not fit.

    ``missing`` columns miss every row, ``unexpected`` ones count no bad value;
    for a ``type`` difference the values are counted that do not cast.
    """
    actual = {field.name: field.dataType for field in df.schema.fields}
    declared = {field.name: field.dataType for field in schema.fields}

    def entry(name, expected, found, problem, bad):
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(expected).cast("string").alias("expected"),
            F.lit(found).cast("string").alias("actual"),
            F.lit(problem).alias("problem"),
            bad.alias("bad_values"),
        )

    rows = F.count(F.lit(1))
    found = []
    for name, kind in declared.items():
        if name not in actual:
            found.append(entry(name, kind.simpleString(), None, "missing", rows))
        elif actual[name] != kind:
            uncastable = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
            found.append(
                entry(name, kind.simpleString(), actual[name].simpleString(), "type",
                      F.count_if(uncastable))
            )
    for name, kind in actual.items():
        if name not in declared:
            found.append(
                entry(name, None, kind.simpleString(), "unexpected", F.count_if(F.lit(False)))
            )
    if not found:
        same = entry("", None, None, "", rows)
        return _long_form(df, [same]).where(F.lit(False))
    return _long_form(df, found)


def missing_days(
    bars: DataFrame, calendar: DataFrame | None = None, until: DateLike | None = None
) -> DataFrame:
    """Days without a bar between a symbol's first and last bar, or up to ``until``.

    With ``until`` a symbol whose feed stopped misses every day after its last bar, and bars
    after that date are not looked at.  The gap before each bar is known from the previous bar, so only the missing
    days are generated, not a grid of all days.  ``calendar`` (column ``date``)
    keeps only the days the market was open.
    """
    if until is not None:
        bars = bars.where(day_between(None, until))
    previous = F.lag("date").over(Window.partitionBy("symbol").orderBy("date"))
    gaps = (
        bars.select("symbol", "date", previous.alias("_previous"))
        .where(F.datediff("date", "_previous") > 1)
        .select(
            "symbol",
            F.explode(
                F.sequence(F.date_add("_previous", 1), F.date_sub("date", 1))
            ).alias("date"),
        )
    )
    if until is not None:
        last = bars.groupBy("symbol").agg(F.max("date").alias("_last"))
        open_days = F.sequence(F.date_add("_last", 1), F.lit(date_bound(until)))
        stopped = last.where(F.col("_last") < F.lit(date_bound(until)))
        gaps = gaps.unionByName(stopped.select("symbol", F.explode(open_days).alias("date")))
    if calendar is None:
        return gaps
    return gaps.join(calendar.select("date").distinct(), "date", "left_semi").select("symbol", "date")


def calendar_grid(bars: DataFrame) -> DataFrame:
    """Every (symbol, day) from a symbol's first to its last bar."""
    return (
        bars.groupBy("symbol")
        .agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
        .select("symbol", F.explode(F.sequence("_first", "_last")).alias("date"))
    )


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: rows, missing values, smallest and largest value, distinct values, quartiles.

    One pass; distinct values (HLL) and quartiles (KLL) come from sketches of
    bounded size.  The sketches of the input partitions are merged in up to
    ``MERGE_SLOTS`` tasks before the last merge, so that the final task reads
    that many sketches per column, not one per input partition.
    """
    names = list(columns or df.columns)
    slot = (F.spark_partition_id() % MERGE_SLOTS).alias("_slot")
    return _profile_of(df.groupBy(slot).agg(*_sketches(df, names)), names)


def profile_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per date: counts, extremes and mergeable sketches of each column.

    Rows without a date are profiled under a date of NULL.
    """
    names = [c for c in columns or df.columns if c != "date"]
    return df.groupBy("date").agg(*_sketches(df, names))


def profile_range(
    sketches: DataFrame, start: DateLike | None = None, end: DateLike | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """The profile of any range of dates out of stored ``profile_sketches``, without reading the rows again.

    Counts and extremes are exact; distinct values and quartiles have the error of the sketches,
    however many dates are merged.  With no bound, undated rows are included.
    """
    names = list(columns or _profiled(sketches))
    if start is not None or end is not None:
        sketches = sketches.where(day_between(start, end))
    return _profile_of(sketches, names)


def _profiled(sketches: DataFrame) -> list[str]:
    return [c.removeprefix("hll_") for c in sketches.columns if c.startswith("hll_")]


def _sketches(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Aggregates that can be merged: what the rows of a group say about each column."""
    sketches = [F.count(F.lit(1)).alias("rows")]
    for name in names:
        value = F.when(~missing(df, name), F.col(name))
        sketches += [
            F.count_if(missing(df, name)).alias(f"missing_{name}"),
            F.min(value).alias(f"smallest_{name}"),
            F.max(value).alias(f"largest_{name}"),
            F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value))).alias(f"hll_{name}"),
        ]
        if isinstance(df.schema[name].dataType, NumericType):
            values = F.kll_sketch_agg_double(value.cast("double"), QUARTILE_K)
            sketches.append(values.alias(f"kll_{name}"))
    return sketches


def _profile_of(sketches: DataFrame, names: Sequence[str]) -> DataFrame:
    """The profile that rows of ``_sketches`` add up to."""

    def profile(name):
        present = F.sum("rows") - F.sum(f"missing_{name}")
        quartiles = F.lit(None).cast("array<double>")
        if f"kll_{name}" in sketches.columns:
            at = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
            merged_kll = F.kll_merge_agg_double(f"kll_{name}", QUARTILE_K)
            quartiles = F.when(present > 0, F.kll_sketch_get_quantile_double(merged_kll, at))
        return F.struct(
            F.lit(name).alias("column"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(f"missing_{name}"), F.lit(0)).alias("missing"),
            F.min(f"smallest_{name}").cast("string").alias("smallest"),
            F.max(f"largest_{name}").cast("string").alias("largest"),
            F.hll_sketch_estimate(F.hll_union_agg(f"hll_{name}")).alias("approx_distinct"),
            quartiles.alias("approx_quartiles"),
        )

    return _long_form(sketches, [profile(name) for name in names])


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per layer."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_lineage(layers: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per date in each layer, side by side; a date absent from a layer counts 0.

    All layers are counted per date in one map-side combined aggregation
    instead of being joined.
    """
    tagged = [df.select("date", F.lit(name).alias("_layer")) for name, df in layers.items()]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("date")
        .agg(*[F.count_if(F.col("_layer") == name).alias(f"{name}_rows") for name in layers])
    )


def symbol_metrics(bars: DataFrame) -> DataFrame:
    """Per symbol: bars, latest date, mean volume."""
    return bars.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"),
        F.max("date").alias("latest_date"),
        F.try_divide(F.sum("volume").cast("double"), F.count("volume")).alias("avg_volume"),
    )


def return_distribution(gold: DataFrame) -> DataFrame:
    """One row: symbols, returns, their mean and sample deviation."""
    return gold.agg(
        F.count_distinct("symbol").alias("symbols"),
        F.count("daily_return_pct").alias("returns"),
        F.avg("daily_return_pct").alias("mean_return"),
        F.stddev_samp("daily_return_pct").alias("std_return"),
    )
