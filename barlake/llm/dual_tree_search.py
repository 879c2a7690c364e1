"""Ranked lexical search by dual trees: all documents for each item, exactly.

Documents and items are vectors over the items' terms: a document has the gain of each term, an
item the weight of each.  The score is their product.  Over both sides stands a hierarchy, whose
nodes hold the greatest value of each coordinate below them.  The product of two nodes bounds
every score below the pair; where it stays under the weakest k-th score of the node's items, the
whole pair is left out, and what remains is refined level by level down to scores.

* Each task builds the tree over its documents chunk by chunk, so nothing about documents
  but statistics leaves a task: memory is that of a chunk (``cells`` coordinates), and a task's
  result is at most k rows per item.
* The k-th scores start from a search over some documents picked by hash, so that every task
  prunes from its first chunk on; any documents' k-th score is a bound, so nothing is lost.
* Items are taken in blocks of about ``block`` bytes of text (at least one item), whose terms,
  vectors and tree are broadcast and whose document frequencies pass the driver.
* Documents are read once per block of items, and reduced to counts of the block's terms.
* Values are whole numbers, multiplied as doubles only while every bound is below 2**53.

Terms are runs of letters, digits and all that is not ASCII (A-Z lower-cased).  Null and empty texts
have none and are no document of the statistics.  A document without id counts in the statistics
but is no answer; an item without id, or without terms, has none.  Rows that repeat a document
are ranked each; an item id with several texts asks for all of them together, repeated rows
of it once.  Ties go to the smaller id.  Extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barlake.llm.components import stored
from barlake.llm.words import pack

# Bytes of letters and digits stay (A-Z in lower case), other ASCII separates.
TERMS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
COUNTED = "doc_id long, n long, ids binary, tfs binary, docs long, words long, df array<long>"
FOUND = "item int, doc_id long, score long"
GAIN = 1_000_000  # no gain reaches it
LEAF, FAN = 4, 4


def _term_counts(vocabulary):
    """Task: the counts of the vocabulary's terms in each document, then statistics of the task."""

    def run(batches):
        known = vocabulary.value
        df, docs, words = np.zeros(len(known), np.int64), 0, 0
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = text.as_buffer().to_pybytes().translate(TERMS).split() if text.is_valid else ()
                if not terms:
                    continue
                docs, words = docs + 1, words + len(terms)
                tf = Counter(map(known.get, terms))
                tf.pop(None, None)
                if not tf:
                    continue
                ids = np.fromiter(tf, np.int32, len(tf))
                df[ids] += 1
                if key is not None:
                    out.append((key, len(terms), *pack(ids, np.fromiter(tf.values(), np.int64, len(tf)))))
            columns = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            nothing = [pa.nulls(len(out), t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns, kinds), *nothing], names=NAMES)
        nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary())]
        totals = [pa.array([docs], pa.int64()), pa.array([words], pa.int64()), pa.array([df.tolist()], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*nothing, *totals], names=NAMES)

    return run


NAMES = ["doc_id", "n", "ids", "tfs", "docs", "words", "df"]


def arranged(x: np.ndarray) -> np.ndarray:
    """An order of the rows in which aligned blocks of a tree's sizes hold similar rows.

    Halves by which of two unlike rows each is nearer to, down to the leaves.
    """
    order, open_ = np.arange(len(x)), [(0, len(x))]
    while open_:
        at, end = open_.pop()
        if end - at <= LEAF:
            continue
        rows = x[order[at:end]]
        near = rows @ rows[np.argmax(rows.sum(1))]
        split = np.argsort(rows @ rows[np.argmin(near)] - near, kind="stable")
        order[at:end] = order[at:end][split]
        half = LEAF
        while half * 2 < end - at:
            half *= 2
        open_ += [(at, at + half), (at + half, end)]
    return order


def hierarchy(x: np.ndarray) -> list[np.ndarray]:
    """Coordinate maxima of the blocks of rows, level by level: the rows, their leaves, up to one root."""
    levels = [x]
    while len(levels[-1]) > 1:
        levels.append(np.maximum.reduceat(levels[-1], np.arange(0, len(levels[-1]), LEAF if len(levels) == 1 else FAN), axis=0))
    return levels


def _least(kth: np.ndarray, depth: int) -> list[np.ndarray]:
    """The weakest k-th score below each node of the items' tree."""
    levels = [kth]
    while len(levels) < depth:
        levels.append(np.minimum.reduceat(levels[-1], np.arange(0, len(levels[-1]), LEAF if len(levels) == 1 else FAN)))
    return levels


def _children(node: np.ndarray, level: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes below the given ones on the next level down, and whose child each is."""
    fan = LEAF if level == 1 else FAN
    below = (node[:, None] * fan + np.arange(fan)).ravel()
    parent = np.repeat(np.arange(len(node)), fan)
    real = below < count
    return below[real], parent[real]


def surviving(items: list[np.ndarray], docs: list[np.ndarray], kth: np.ndarray):
    """(item, document, score) that may still enter an item's best, by descent over node pairs.

    Both trees are refined together; a pair of nodes is kept while its bound is above 0 and
    reaches the weakest k-th score of the node's items.
    """
    up, down = len(items) - 1, len(docs) - 1
    weakest = _least(kth, len(items))
    i, d = np.arange(len(items[up])), np.arange(len(docs[down]))
    alive = np.ones((len(i), len(d)), bool)
    while True:
        bound = items[up][i] @ docs[down][d].T
        alive &= (bound >= weakest[up][i][:, None]) & (bound > 0)
        if up == 0 and down == 0:
            break
        rows, columns = alive.any(1), alive.any(0)
        i, d, alive = i[rows], d[columns], alive[rows][:, columns]
        if not len(i):
            return np.empty(0, int), np.empty(0, int), np.empty(0, np.int64)
        if up > 0:
            up -= 1
            i, parent = _children(i, up + 1, len(items[up]))
            alive = alive[parent]
        if down > 0:
            down -= 1
            d, parent = _children(d, down + 1, len(docs[down]))
            alive = alive[:, parent]
    a, b = np.nonzero(alive)
    return i[a], d[b], bound[a, b].astype(np.int64)


def _search(vectors, start: np.ndarray, docs: int, words: int, k: int, cells: int):
    """Task: the k best documents of each item among the task's, best first."""

    def run(batches):
        tree, order = vectors.value
        width, kind = tree[0].shape[1], tree[0].dtype
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in order]
        kth = start.copy()
        chunk, size = [], max(64, cells // max(width, 1))

        def look():
            x = np.zeros((len(chunk), width), kind)
            keys = np.array([c[0] for c in chunk], np.int64)
            for row, (_, n, ids, tfs) in enumerate(chunk):
                tf = np.frombuffer(tfs, np.int64)
                m = 75 + (25 * n * docs) // words
                x[row, np.frombuffer(ids, np.int32)] = (1000000000 * tf) // (1000 * tf + 12 * m)
            placed = arranged(x)
            item, doc, score = surviving(tree, hierarchy(x[placed]), kth)
            doc = keys[placed[doc]]
            for at in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1):
                if not len(at):
                    continue
                one = item[at[0]]
                scores, ids = np.r_[best[one][0], score[at]], np.r_[best[one][1], doc[at]]
                first = np.lexsort((ids, -scores))[:k]
                best[one] = (scores[first], ids[first])
                if len(first) == k:
                    kth[one] = max(kth[one], scores[first[-1]])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                chunk.append(row)
                if len(chunk) == size:
                    look()
                    chunk.clear()
        if chunk:
            look()
        for one, (scores, ids) in enumerate(best):
            place = pa.array(np.full(len(ids), order[one], np.int32))
            yield pa.RecordBatch.from_arrays([place, pa.array(ids), pa.array(scores)], names=["item", "doc_id", "score"])

    return run


def _of_block(docs: DataFrame, asked: list[tuple], k: int, cells: int, sample: int) -> DataFrame | None:
    """(item, doc_id, score) found by the tasks for a block of items; ``asked`` has id and term counts."""
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    terms = sorted(set().union(*(tf for _, tf in asked)))
    place = {t: i for i, t in enumerate(terms)}
    counted = stored(docs.mapInArrow(_term_counts(sc.broadcast(place)), COUNTED), "counted")
    totals = counted.where("docs IS NOT NULL")
    n, words = totals.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    if n == 0:
        return None
    df = np.zeros(len(terms), np.int64)
    frequent = totals.select(F.posexplode("df").alias("term", "df")).where("df > 0").groupBy("term").agg(F.sum("df").alias("df"))
    for row in frequent.collect():  # at most one row per term of the block
        df[row["term"]] = row["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(f) + 1))) for f in df], np.int64)
    q = np.zeros((len(asked), len(terms)), np.int64)
    for row, (_, tf) in enumerate(asked):
        for term, count in tf.items():
            q[row, place[term]] = count * weight[place[term]]
    if sum(map(int, q.max(0))) * GAIN < 2**53:
        q = q.astype(np.float64)
    order = arranged(q)
    vectors = sc.broadcast((hierarchy(q[order]), order))
    counted = counted.where("docs IS NULL").select("doc_id", "n", "ids", "tfs")
    search = lambda rows, kth: rows.mapInArrow(_search(vectors, kth, n, words, k, cells), FOUND)

    kth = np.zeros(len(asked), np.int64)
    some = counted.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, n // sample))) == 0)
    last = _first(search(some, kth), k).where(F.col("rank") == k)
    for row in last.collect():  # at most one row per item of the block
        kth[row["item"]] = row["score"]
    return search(counted, kth[order])


def _first(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, block: int = 1 << 18, cells: int = 1 << 22, sample: int = 8192
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    ``sample`` is about how many documents the first bounds come from; it changes no result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    items = items.where("item_id IS NOT NULL").groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_set("text")), " ").alias("text"))
    items = stored(items, "items")
    size, count = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    blocks = min(-(-size // block), count)  # one very long item asks for no empty blocks
    kind = items.schema["item_id"].dataType.simpleString()
    answers = []
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()  # bounded by block
        asked = [(r["item_id"], Counter(r["text"].encode().translate(TERMS).split())) for r in rows]
        asked = [(key, tf) for key, tf in asked if tf]
        found = _of_block(docs, asked, k, cells, sample) if asked else None
        if found is not None:
            names = spark.createDataFrame([(i, key) for i, (key, _) in enumerate(asked)], f"item int, item_id {kind}")
            found = stored(_first(found, k), "ranked")
            answers.append(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    if not answers:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    whole = answers[0]
    for part in answers[1:]:
        whole = whole.unionByName(part)
    return whole


def op13_dual_tree_search(spark, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
l AS (SELECT doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM l),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
qn AS (SELECT item_id, term, count(*)::BIGINT AS times FROM q GROUP BY ALL),
f AS (
  SELECT doc_id, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM f GROUP BY term), total),
s AS (
  SELECT qn.item_id, f.doc_id,
    sum(times * w.w * ((1000000000 * f.tf) // (1000 * f.tf + 12 * (75 + (25 * l.n * docs) // words))))::BIGINT AS score
  FROM qn JOIN f ON f.term = qn.term JOIN w ON w.term = qn.term JOIN l ON l.doc_id = f.doc_id, total GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""
