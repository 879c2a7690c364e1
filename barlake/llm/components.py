"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barlake.sources.scratch import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _towards_least(edges: DataFrame, keep_larger: bool) -> DataFrame:
    """One star step: neighbours of each node are tied to the least of them.

    ``keep_larger`` ties the neighbours above the node, otherwise those below it and the node.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if keep_larger:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.join(least, "u")
    if keep_larger:
        tied = tied.where("v > u").select("v", "m")
    else:
        tied = tied.select("v", "m").union(least.select(F.col("u").alias("v"), "m"))
    return tied.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for every node that has a link.

    ``links`` has columns a and b.  Each step only joins and takes minima, so a component
    of any size is never gathered; the steps grow with the logarithm of its diameter.
    """
    edges = stored(links.where("a != b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        edges = stored(_towards_least(_towards_least(edges, True), False), "stars")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == mark:
            break
        mark = (row[0], row[1])
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
