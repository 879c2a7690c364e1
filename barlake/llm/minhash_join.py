"""Near-duplicate documents by an inverted join over MinHash coordinates.

A signature has ``coordinates`` minima of the set of word shingles, each under its own order.
Every document is posted under each of its coordinate-value pairs.  Two sets of similarity s
collide in a coordinate with chance s, so linked documents collide in at least ``matches`` of
them, but for a chance of below one in a million at the threshold itself and far less above it.

* Prefix.  Documents that collide ``matches`` times meet in one of either's ``coordinates -
  matches + 1`` shortest lists.  Only there are they posted; lists of one document, usually most
  of them, count as places of the prefix and are not written.
* Skip.  The long lists are never merged: of a pair that met in a short one, the collisions
  in all others are read off a byte per coordinate that travels with the posting.  (Another
  value has the same byte once in 256 times, which can add a collision and never hides one.)
  Only pairs that reach ``matches``, and whose set sizes allow the similarity, go on.

What remains is confirmed on the full sets of shingles, family by family: a family is what pairs
above the match threshold hold together.

Groups of copies.  Equal sets are one node from the start.  Neither a list nor a family gives out
its pairs: a task follows the pairs from node to node and compares each only with nodes not
reached yet, so it returns at most one link per node, and in a group of near copies nearly all
are reached from the first.  Lists of more than ``block`` nodes and families of more than
``shingles`` shingles are split, and every two parts meet in a task of their own.  No pair is left
out: one that is not compared is connected already.

Shingles and sets are compared as 64-bit hashes.  Nulls and empty texts have an empty set, link
with nothing and are their own component.  Rows that repeat are separate rows with the same
result (all are kept, or none); extra columns are ignored; a null id takes part like any other
and never becomes the component id of a row that has one.  Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from xxhash import xxh64_intdigest

from barlake.llm.components import components, stored
from barlake.llm.words import WordHashes, mix, pieces, sequence_hashes

SETS = "rid long, doc_id long, n long, node long, pairs array<long>, marks binary"


def shingles(ids: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles of a word sequence; a shorter sequence is one shingle."""
    if len(ids) < width:
        return sequence_hashes(ids, len(ids)) if len(ids) else np.empty(0, np.uint64)
    return np.unique(sequence_hashes(ids, width))


class Orders:
    """``count`` orders of shingles: by a * x + b on 32 bits of their hash, a being odd."""

    def __init__(self, count: int):
        bits = mix(np.arange(1, 2 * count + 1, dtype=np.uint64))
        self.a = (bits[:count] | np.uint64(1)).astype(np.uint32)[:, None]
        self.b = bits[count:].astype(np.uint32)[:, None]
        self.salts = mix(np.arange(1, count + 1, dtype=np.uint64) << np.uint64(32))

    def signature(self, own: np.ndarray, piece: int = 4096) -> np.ndarray:
        """The least shingle under each order."""
        least, value = None, None
        for at in range(0, len(own), piece):
            part = own[at : at + piece]
            ranks = part.astype(np.uint32)[None, :] * self.a + self.b
            place = ranks.argmin(1)
            rank, shingle = ranks[np.arange(len(place)), place], part[place]
            if least is None:
                least, value = rank, shingle
            else:
                value = np.where(rank < least, shingle, value)
                least = np.minimum(rank, least)
        return value


def _signed(width: int, coordinates: int):
    """Task: set size, set fingerprint, coordinate-value pairs and their bytes for each document."""

    def run(batches):
        words, orders = WordHashes(), Orders(coordinates)
        for batch in batches:
            out = []
            for rows in pieces(batch):
                for rid, body in rows:
                    own = shingles(words.of(body), width)
                    if not len(own):
                        out.append((rid, 0, None, None, None))
                        continue
                    # One 64-bit value for a coordinate and its value.
                    pairs = mix(orders.signature(own) ^ orders.salts)
                    node = int(np.uint64(xxh64_intdigest(own.tobytes())).view(np.int64))
                    out.append((rid, len(own), node, pairs.view(np.int64), pairs.astype(np.uint8).tobytes()))
            rid, n, node, pairs, marks = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rid, pa.int64()), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                    pa.array(pairs, pa.list_(pa.int64())), pa.array(marks, pa.binary()),
                ],
                names=["rid", "doc_id", "n", "node", "pairs", "marks"],
            )

    return run


def reached(count: int, near) -> list[tuple[int, int]]:
    """Links that connect what ``near`` connects: at most one per member.

    ``near(x, rest)`` tells which of the members ``rest`` are linked with member x; it is asked
    only for members that nothing has reached yet.
    """
    links, rest = [], np.arange(count)
    while len(rest) > 1:
        waiting, rest = [int(rest[0])], rest[1:]
        while waiting and len(rest):
            x = waiting.pop()
            hit = near(x, rest)
            found, rest = rest[hit], rest[~hit]
            links += [(x, int(y)) for y in found]
            waiting += found.tolist()
    return links


def _edges(node: np.ndarray, links: list[tuple[int, int]]):
    x, y = np.array(links, int).reshape(-1, 2).T
    return pa.table({"a": np.minimum(node[x], node[y]), "b": np.maximum(node[x], node[y])})


def _runs(key: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal neighbours."""
    starts = np.flatnonzero(np.r_[True, np.diff(key) != 0]) if len(key) else np.empty(0, int)
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(key)]))


def _collide(matches: int, percent: int):
    """Group: links between nodes of the group's lists whose bytes agree often enough."""

    def run(table):
        table = table.sort_by([("pair", "ascending"), ("node", "ascending")])
        pair, node, n = (table.column(x).to_numpy() for x in ("pair", "node", "n"))
        marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(len(node), -1)

        def agree(x, y):
            size = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
            return size & ((marks[x] == marks[y]).sum(1) >= matches)

        runs = _runs(pair)
        two = np.array([start for start, end in runs if end - start == 2], int)
        two = two[agree(two, two + 1)]
        links = list(zip(two.tolist(), (two + 1).tolist()))
        for start, end in runs:
            if end - start > 2:
                found = reached(end - start, lambda x, rest: agree(np.array([start + x]), start + rest))  # noqa: B023
                links += [(start + x, start + y) for x, y in found]
        return _edges(node, links)

    return run


class Common:
    """How many shingles a set shares with each of some sets, by lists over the latter."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes, self.held = sets, np.array([len(s) for s in sets]), None

    def _hold(self, members: np.ndarray):
        flat = np.concatenate([self.sets[m] for m in members])
        order = np.argsort(flat, kind="stable")
        self.held, self.values = members, flat[order]
        self.owners = np.repeat(np.arange(len(members)), self.sizes[members])[order]

    def linked(self, x: int, rest: np.ndarray, percent: int) -> np.ndarray:
        # Lists are built anew whenever half their members are gone; ``rest`` ascends.
        if self.held is None or len(rest) * 2 < len(self.held):
            self._hold(rest)
        first, last = (np.searchsorted(self.values, self.sets[x], side) for side in ("left", "right"))
        counts = last - first
        places = np.repeat(first - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
        common = np.bincount(self.owners[places], minlength=len(self.held))[np.searchsorted(self.held, rest)]
        return 100 * common >= percent * (self.sizes[x] + self.sizes[rest] - common)


def _confirm(width: int, percent: int):
    """Group: links between nodes of the group's families whose full sets reach the similarity."""

    def run(table):
        words = WordHashes()
        table = table.sort_by([("family", "ascending"), ("node", "ascending")])
        family, node = (table.column(x).to_numpy() for x in ("family", "node"))
        bodies, links = table.column("body"), []
        for start, end in _runs(family):
            common = Common([shingles(words.of(bodies[i].as_py()), width) for i in range(start, end)])
            found = reached(end - start, lambda x, rest: common.linked(x, rest, percent))  # noqa: B023
            links += [(start + x, start + y) for x, y in found]
        return _edges(node, links)

    return run


def _met(rows: DataFrame, key: str, parts: Column, small: int, task, columns: list[str]) -> DataFrame:
    """The links a task finds in each group of rows with equal ``key``.

    Groups of one part are packed, ``small`` groups of groups in all; of others every two parts meet.
    """
    rows = rows.select("node", key, *columns, parts.cast("int").alias("parts"))
    one = rows.where("parts = 1").select(
        F.pmod(F.xxhash64(key), F.lit(small)).alias("g"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), key, "node", *columns
    )
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    many = (
        rows.where("parts > 1").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("own != other")
        .select(F.col(key).alias("g"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), key, "node", *columns)
    )
    return one.unionByName(many).groupBy("g", "i", "j").applyInArrow(task, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    width: int = 2,
    percent: int = 80,
    coordinates: int = 64,
    matches: int = 34,
    block: int = 2048,
    family: int = 1_000_000,
) -> DataFrame:
    """(rid, doc_id, n_shingles, component_id, component) per row of ``docs`` (doc_id, text).

    ``component_id`` is the least id of a component and null if all its ids are; ``component``
    tells components apart and is null without words.  ``rid`` is the hash of id and text.
    ``block`` is the nodes of a list, ``family`` the shingles of a family one task takes.
    """
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("rid"),
        F.col("text").cast("binary").alias("body"),
        F.col("doc_id").cast("long").alias("doc_id"),
    )
    sets = stored(rows.mapInArrow(_signed(width, coordinates), SETS), "sets")
    nodes = stored(sets.where("n > 0").select("node", "n", "pairs", "marks").dropDuplicates(["node"]), "nodes")
    sets = sets.select("rid", "doc_id", "n", "node")

    # Lists of two and more, and each node's places in the shortest of them.
    posted = nodes.select("node", F.explode("pairs").alias("pair"))
    lengths = posted.groupBy("pair").agg(F.count("*").alias("length")).where("length > 1")
    of_node = Window.partitionBy("node")
    prefix = (
        posted.join(lengths, "pair")
        .withColumn("alone", F.lit(coordinates) - F.count("*").over(of_node))
        .withColumn("place", F.col("alone") + F.row_number().over(of_node.orderBy("length", "pair")))
        .where(F.col("place") <= coordinates - matches + 1)
        .select("pair", "node", "length")
    )
    lists = stored(prefix.join(nodes.select("node", "n", "marks"), "node"), "lists")
    parts = F.ceil(F.col("length") / block)
    met = _met(lists, "pair", parts, _tasks(lists.count(), 50_000), _collide(matches, percent), ["n", "marks"])
    families = stored(components(met.distinct()), "families").withColumnRenamed("component", "family")

    size = families.join(nodes.select("node", "n"), "node").groupBy("family").agg(F.sum("n").alias("size"))
    holders = sets.join(families, "node").groupBy("family", "node").agg(F.min("rid").alias("rid"))
    bodies = rows.select("rid", "body").join(holders, "rid").dropDuplicates(["rid"]).join(size, "family")
    bodies = stored(bodies.select("family", "node", "body", "size"), "bodies")
    total = bodies.agg(F.coalesce(F.sum(F.length("body")), F.lit(0))).first()[0]
    parts = F.ceil(F.col("size") / family)
    links = _met(bodies, "family", parts, _tasks(total, 4_000_000), _confirm(width, percent), ["body"])
    known = stored(components(links), "known")

    least = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    least = least.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = least.groupBy("component").agg(F.min("least").alias("component_id"))
    found = least.join(ids, "component").select("node", "component_id", "component")
    return sets.join(found, "node", "left").select(
        "rid",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "component",
    )


def _tasks(amount: int, each: int) -> int:
    return max(12, -(-amount // each))


def op12_minhash_join(spark, sf_dir: str) -> DataFrame:
    """Set size, component and whether it stays for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


# Quadratic, but complete: every shingle of every text, every pair that shares one.
ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) = 1 THEN [ws[1]]
    ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * i >= 80 * (p.n + q.n - i)),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a)
  SELECT a, min(b) AS least FROM r GROUP BY a),
c AS (
  SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(reach.least, d.doc_id)) AS component_id
  FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.a = d.doc_id)
SELECT *, doc_id = component_id AS kept FROM c
"""
