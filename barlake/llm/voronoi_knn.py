"""Exact top-k by inner product as a Voronoi join.

Vectors and queries are grouped by their nearest pivot.  Every query is first answered inside
its own cell.  From that the cells get summaries: the worst k-th score of the cell's queries,
the greatest distance of a query from the pivot and the longest query.  A vector x can only
enter the answer of a query q in the cell of pivot p if <q, x> reaches q's k-th score so far,
and <q, x> <= <p, x> + |q - p| * |x|; so x is sent to the cells where that bound reaches the
cell's worst k-th score, and to no other.  There the queries are answered over what arrived.

The pivots are a bounded sample: one for 64 queries, 8 to ``pivots`` of them, the vectors with
the least hash of their id.  A cell's summary is a few numbers, so what is broadcast is
bounded too, and a vector is sent to no more cells than there are pivots.  A cell's queries and
vectors meet in blocks of at most about ``block`` rows, so a cell with a third of all rows, or
of one vector repeated, is many tasks.

Components are turned into floor(scale * x); scores are exact integers (computed as doubles
below 2**53).  Ties go to the smaller id.  Vectors that are null, empty, or hold a null or
non-finite component take no part, nor do rows without an id; shorter vectors count as
continued by zeros; rows that repeat an id are vectors of their own, but a query never finds a row
of its own id.  A row that asks repeatedly, with the same id and vector, asks once.  An id
that asks with several vectors has one answer: each row found counts once, with the best of its
scores.  Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barlake.llm.components import stored

# ``asked`` and ``held`` are hashes of the query's and the found row's vector.
FOUND = "query_id long, asked long, vec_id long, held long, score long"


def _integers(scale: int):
    """Task: (vec_id, v) with v the integer vector as bytes of doubles; unusable vectors are left out."""

    def run(batches):
        for batch in batches:
            keys, out = [], []
            for key, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                if key is None or not x.is_valid or not len(x.values) or x.values.null_count:
                    continue
                values = np.floor(scale * np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64))
                if np.isfinite(values).all():
                    keys.append(key)
                    out.append(values.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.binary())], names=["vec_id", "v"])

    return run


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(-1, width)


def _first_distinct(x: np.ndarray, most: int) -> np.ndarray:
    """The first distinct rows, in their order."""
    return x[np.sort(np.unique(x, axis=0, return_index=True)[1])[:most]]


def _assign(pivots: np.ndarray):
    """Task: nearest pivot of each vector, its distance, and the vector's length."""
    half = (pivots**2).sum(1) / 2

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1).to_pylist(), pivots.shape[1])
            cell = np.argmax(x @ pivots.T - half, 1) if len(x) else np.empty(0, int)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], names=["vec_id", "v", "cell", "away"]
            )

    return run


def _best(k: int, width: int):
    """Group: the k best vectors for each query of the group; queries are rows with a query id."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        asked = group["query_id"].notna().to_numpy()
        queries, data = group[asked], group[~asked].sort_values("vec_id")
        out = []
        if len(queries) and len(data):
            x, ids, held = _matrix(data["v"], width), data["vec_id"].to_numpy(np.int64), data["h"].to_numpy(np.int64)
            for at in range(0, len(queries), 64):
                some = queries.iloc[at : at + 64]
                scores = _matrix(some["v"], width) @ x.T
                for q, h, row in zip(some["query_id"].to_numpy(np.int64), some["h"].to_numpy(np.int64), scores):
                    row[ids == q] = -np.inf
                    if len(row) > k:
                        least = np.partition(row, -k)[-k]
                        at_least = np.flatnonzero(row >= least)
                    else:
                        at_least = np.arange(len(row))
                    # Ids ascend, so a stable sort by falling score gives ties to the smaller id.
                    top = at_least[np.argsort(-row[at_least], kind="stable")][:k]
                    out += [(q, h, int(ids[i]), int(held[i]), int(row[i])) for i in top if row[i] > -np.inf]
        return pd.DataFrame(out, columns=["query_id", "asked", "vec_id", "held", "score"]).astype("int64")

    return run


def _reach(pivots: np.ndarray, summaries: dict[int, tuple[float, float]]):
    """Task: the other cells whose queries a vector may still answer."""
    cells = np.array(sorted(summaries), int)
    worst = np.array([summaries[c][0] for c in cells])
    radius = np.array([summaries[c][1] for c in cells])

    def run(batches):
        # A vector may be sent to every cell: slices keep what is held at once small.
        for batch in (b.slice(at, 1024) for b in batches for at in range(0, len(b), 1024)):
            x = _matrix(batch.column(1).to_pylist(), pivots.shape[1])
            own = np.array(batch.column(2).to_pylist(), int)
            size = np.sqrt((x**2).sum(1))
            bound = x @ pivots[cells].T + size[:, None] * radius[None, :]
            # A little slack, upwards whatever the sign: the bound is rounded, the scores are not.
            send = (bound + 1e-9 * np.abs(bound) + 1e-6 >= worst[None, :]) & (own[:, None] != cells[None, :])
            row, to = np.nonzero(send)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(cells[to].astype(np.int32))],
                names=["vec_id", "v", "cell"],
            )

    return run


def _join(queries: DataFrame, data: DataFrame, block: int, k: int, width: int) -> DataFrame:
    """The k best of each query over the vectors sent to its cell, block by block."""
    # Blocks per cell: at most one row for each pivot.
    q_blocks = queries.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("qb"))
    x_blocks = data.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("xb"))
    blocks = q_blocks.join(x_blocks, "cell")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    asked = queries.join(F.broadcast(blocks), "cell").select(
        "cell", own("qb").alias("q"), each("xb").alias("x"), F.col("vec_id").alias("query_id"), F.lit(None).cast("long").alias("vec_id"), "v",
        F.xxhash64("v").alias("h"),
    )
    held = data.join(F.broadcast(blocks), "cell").select(
        "cell", each("qb").alias("q"), own("xb").alias("x"), F.lit(None).cast("long").alias("query_id"), "vec_id", "v",
        F.xxhash64("v").alias("h"),
    )
    return asked.unionByName(held).groupBy("cell", "q", "x").applyInPandas(_best(k, width), FOUND)


def _ranked(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _answers(found: DataFrame, k: int) -> DataFrame:
    """One answer per id: a row found with several of its vectors counts once, with its best score."""
    best = _ranked(found, k, "query_id", "asked")
    copy = Window.partitionBy("query_id", "asked", "vec_id", "held").orderBy("rank")
    rows = best.withColumn("copy", F.row_number().over(copy)).groupBy("query_id", "vec_id", "held", "copy").agg(F.max("score").alias("score"))
    return _ranked(rows, k, "query_id").select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries, k: int = 5, scale: int = 256, pivots: int = 1024, block: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of ``vectors`` (vec_id, embedding) for each query.

    ``queries`` is a condition on ``vec_id`` that picks the rows that ask; ``pivots`` is the
    greatest number of cells.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    whole = rows.mapInArrow(_integers(scale), "vec_id long, v binary")
    asked, least, most = whole.agg(F.count_if(queries), F.min(F.length("v")), F.max(F.length("v"))).first()
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if least < most:
        whole = whole.withColumn("v", F.rpad("v", most, F.lit(bytes(1))))
    pivots, width = max(8, min(pivots, asked // 64)), most // 8
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(4 * pivots).collect()
    chosen = _first_distinct(_matrix([r["v"] for r in sample], width), pivots)
    cells = stored(whole.mapInArrow(_assign(chosen), "vec_id long, v binary, cell int, away double"), "cells")
    asking = stored(cells.where(queries).dropDuplicates(["vec_id", "v"]), "asking")
    near = stored(_ranked(_join(asking, cells, block, k, width), k, "query_id", "asked"), "near")
    kth = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("asked").alias("h"), F.col("score").alias("kth"))
    summary = (
        asking.withColumn("h", F.xxhash64("v")).join(kth, ["vec_id", "h"], "left").groupBy("cell")
        .agg(F.min(F.coalesce("kth", F.lit(float("-inf")))).alias("worst"), F.max("away").alias("radius"))
    )
    summaries = {r["cell"]: (r["worst"], r["radius"]) for r in summary.collect()}
    if not summaries:
        return _answers(near.drop("rank"), k)
    sent = stored(cells.select("vec_id", "v", "cell").mapInArrow(_reach(chosen, summaries), "vec_id long, v binary, cell int"), "sent")
    far = _join(asking, sent, block, k, width)
    return _answers(near.drop("rank").unionByName(far), k)


def op5_voronoi_knn(spark, sf_dir: str) -> DataFrame:
    """The five best vectors for every vector whose id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
asked AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0),
s AS (
  SELECT q.vec_id AS query_id, c.row, c.vec_id, max(CAST(list_dot_product(q.e, c.e) AS BIGINT)) AS score
  FROM asked q JOIN v c ON c.vec_id <> q.vec_id GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
