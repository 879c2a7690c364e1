"""Documents linked by n-gram Jaccard similarity, by filters under several token orders.

Tokens are hashed word shingles.  Two sets whose Jaccard similarity reaches the threshold
share a token among the first few of either set, whatever total order the tokens are put
in.  The first order is rarest first and makes the candidates: only documents that share an
early token meet, and only if enough of both sets follows that token.  Candidates must then
share early tokens under further, independent orders too, and what is left is verified on
the whole sets.

* Frequencies come from a fixed-size count sketch over every document, so the order is
  total, the same everywhere, and never needs a dictionary of all tokens.
* Equal sets collapse to one node before anything is paired.
* A token's documents are never paired with one another.  Each is paired with the one that
  has the fewest rare tokens of its own (a star); once those links are merged, only pairs
  that are still in different components are looked at.  Any other pair of the token is
  connected already, so no link is lost and a group of copies costs a multiple of its size.
* Shingles and sets are compared as 64-bit hashes: different ones are taken as equal with
  a chance of about pairs / 2**64.

Nulls and empty texts have an empty set, link with nothing and are their own component.
Rows that repeat are separate rows with the same result; extra columns are ignored; a null
id takes part like any other and never becomes the component id of a row that has one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from barlake.llm.components import components, stored
from barlake.llm.words import WordHashes, by_bucket, mix, pack, pieces, sequence_hashes, unpack

SKETCH_BITS = 20
ORDER_SALTS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)


def shingle_set(ids: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles of a word sequence; a shorter sequence is one shingle."""
    if len(ids) < width:
        return sequence_hashes(ids, len(ids)) if len(ids) else np.empty(0, np.uint64)
    return np.unique(sequence_hashes(ids, width))


def prefix_length(size: int, percent: int) -> int:
    """So many first tokens hold a common one if the similarity reaches the threshold."""
    return size - (size * percent + 99) // 100 + 1


def overlap_needed(size: int, other: int, percent: int) -> int:
    """Least common tokens with 100 * common >= percent * union."""
    return -(-percent * (size + other) // (100 + percent))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.xxhash64(F.col("doc_id"), F.col("text")).alias("rid"),
        F.col("text").cast("binary").alias("body"),
        F.col("doc_id").cast("long").alias("doc_id"),
    )


def _sets_and_sketch(width: int, bits: int):
    """Task: set size and fingerprint of each document, then the task's token counts."""

    def run(batches):
        words, sketch = WordHashes(), np.zeros(1 << bits, np.int64)
        for batch in batches:
            ids = batch.column(2)
            rid, size, node = [], [], []
            for rows in pieces(batch):
                tokens = []
                for key, body in rows:
                    own = shingle_set(words.of(body), width)
                    tokens.append(own)
                    rid.append(key)
                    size.append(len(own))
                    node.append(xxh64_intdigest(own.tobytes()))
                flat = np.concatenate(tokens) >> np.uint64(64 - bits)
                sketch += np.bincount(flat.astype(np.int64), minlength=1 << bits)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rid, pa.int64()),
                    ids,
                    pa.array(size, pa.int64()),
                    pa.array(np.array(node, np.uint64).view(np.int64)),
                    pa.nulls(len(rid), pa.int32()),
                    pa.nulls(len(rid), pa.binary()),
                ],
                names=["rid", "doc_id", "n", "node", "slice", "counts"],
            )
        slices = np.split(sketch.astype(np.uint32), 64)
        full = [i for i, part in enumerate(slices) if part.any()]
        none = pa.nulls(len(full), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(full, pa.int32()), pa.array([slices[i].tobytes() for i in full], pa.binary())],
            names=["rid", "doc_id", "n", "node", "slice", "counts"],
        )

    return run


def _sum_slices(batches):
    """Task: sums of the sketch slices it gets, read one after another."""
    total = {}
    for batch in batches:
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(x.as_buffer(), np.uint32).astype(np.uint64)
            total[i] = total[i] + part if i in total else part
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
        names=["slice", "counts"],
    )


POSTINGS = "bucket int, tokens binary, places binary, nodes binary, sizes binary, runs binary"


def _prefixes(sketch, width: int, percent: int, buckets: int, hot: int, bits: int):
    """Task: first tokens of each set, rarest first, packed by token bucket.

    A token that the sketch calls frequent goes to buckets by document instead, so that
    its documents never meet in one task.
    """

    def run(batches):
        words, counts = WordHashes(), sketch.value
        for batch in batches:
            for rows in pieces(batch, 8 << 20):
                tokens, places, nodes, sizes, estimates = [], [], [], [], []
                for _, body in rows:
                    own = shingle_set(words.of(body), width)
                    if not len(own):
                        continue
                    seen = counts[own >> np.uint64(64 - bits)]
                    first = np.argsort(seen, kind="stable")[: prefix_length(len(own), percent)]
                    tokens.append(own[first])
                    estimates.append(seen[first])
                    places.append(np.arange(len(first), dtype=np.uint32))
                    nodes.append(np.full(len(first), xxh64_intdigest(own.tobytes()), np.uint64))
                    sizes.append(np.full(len(first), len(own), np.uint32))
                if not tokens:
                    continue
                tokens, places, nodes, sizes = map(np.concatenate, (tokens, places, nodes, sizes))
                often = np.concatenate(estimates) >= hot
                bucket = np.where(often, nodes % np.uint64(buckets) + np.uint64(buckets), tokens % np.uint64(buckets))
                out = []
                for key, at in by_bucket(bucket.astype(np.int64)):
                    starts = np.flatnonzero(np.r_[True, np.diff(nodes[at].view(np.int64)) != 0])
                    runs = np.diff(np.r_[starts, len(at)]).astype(np.uint32)
                    out.append([key, *pack(tokens[at], places[at], nodes[at][starts], sizes[at][starts], runs)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*out))],
                    names=["bucket", "tokens", "places", "nodes", "sizes", "runs"],
                )

    return run


def _shared_tokens(buckets: int):
    """Group: postings of the bucket's tokens that at least two nodes have."""

    def run(table):
        tokens, places = unpack(table.column("tokens"), np.uint64), unpack(table.column("places"), np.uint32)
        runs = unpack(table.column("runs"), np.uint32)
        nodes = np.repeat(unpack(table.column("nodes"), np.uint64), runs)
        sizes = np.repeat(unpack(table.column("sizes"), np.uint32), runs)
        order = np.lexsort((nodes, tokens))
        tokens, places, nodes, sizes = tokens[order], places[order], nodes[order], sizes[order]
        keep = np.r_[True, (np.diff(tokens.view(np.int64)) != 0) | (np.diff(nodes.view(np.int64)) != 0)]
        tokens, places, nodes, sizes = tokens[keep], places[keep], nodes[keep], sizes[keep]
        if table.column("bucket")[0].as_py() < buckets:
            same = np.diff(tokens.view(np.int64)) == 0
            keep = np.r_[False, same] | np.r_[same, False]
            tokens, places, nodes, sizes = tokens[keep], places[keep], nodes[keep], sizes[keep]
        return pa.table(
            {
                "token": tokens.view(np.int64),
                "node": nodes.view(np.int64),
                "n": sizes.astype(np.int32),
                "pos": places.astype(np.int32),
            }
        )

    return run


def _enough(percent: int, x: str, y: str):
    """What follows the shared token in either set can still reach the overlap needed."""
    rest = F.least(F.col(f"{x}.n") - F.col(f"{x}.pos"), F.col(f"{y}.n") - F.col(f"{y}.pos"))
    return rest * (100 + percent) >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * percent


def _pair(x, y):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def similar(x: np.ndarray, y: np.ndarray, percent: int, salts=ORDER_SALTS) -> bool:
    """Whether two sets reach the threshold: first the filters of the other orders, then the sets."""
    needed = overlap_needed(len(x), len(y), percent)
    if min(len(x), len(y)) < needed:
        return False
    for salt in salts:
        early = []
        for own in (x, y):
            p, ranks = prefix_length(len(own), percent), mix(own ^ np.uint64(salt))
            early.append(np.partition(ranks, p - 1)[:p])
        if not len(np.intersect1d(*early, assume_unique=True)):
            return False
    return len(np.intersect1d(x, y, assume_unique=True)) >= needed


def _verify(width: int, percent: int):
    def run(batches):
        words, last, left = WordHashes(), None, None
        for batch in batches:
            a, b, text_a, text_b = batch.columns
            keep = np.zeros(len(batch), bool)
            for i, key in enumerate(a.to_pylist()):
                if key != last:
                    last, left = key, shingle_set(words.of(text_a[i].as_py()), width)
                keep[i] = similar(left, shingle_set(words.of(text_b[i].as_py()), width), percent)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))

    return run


def _verified(pairs: DataFrame, rows: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that link; texts are fetched for nodes in a pair only."""
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = sets.join(needed, "node", "left_semi").groupBy("node").agg(F.min("rid").alias("rid"))
    texts = stored(
        rows.select("rid", "body").join(wanted, "rid").dropDuplicates(["rid"]).select("node", "body"),
        "texts",
    )
    full = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("body").alias("text_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("body").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )
    return stored(full.mapInArrow(_verify(width, percent), "a long, b long"), "links")


def link_documents(
    docs: DataFrame,
    width: int = 5,
    percent: int = 75,
    hot: int = 50_000,
    bucket_tokens: int = 1_000_000,
    bits: int = SKETCH_BITS,
) -> DataFrame:
    """(rid, doc_id, n_shingles, component_id, component) per row of ``docs`` (doc_id, text).

    ``component_id`` is the least id of a component, which two components share if rows repeat
    an id, and null if all its ids are; ``component`` tells them apart and is null without words.

    ``rid`` is the hash of id and text.  ``hot`` is the estimated document count from which
    a token's postings are spread over buckets, ``bucket_tokens`` the postings a bucket
    holds on average, ``bits`` the width of the sketch (2**bits counters are broadcast:
    4 MB at the default; take more bits for corpora above some billions of words).
    """
    spark, rows = docs.sparkSession, _keyed(docs)
    first = stored(
        rows.mapInArrow(
            _sets_and_sketch(width, bits), "rid long, doc_id long, n long, node long, slice int, counts binary"
        ),
        "sets",
    )
    sets = first.where("slice is null").select("rid", "doc_id", "n", "node")
    slices = (
        first.where("slice is not null").select("slice", "counts").repartition(16, "slice")
        .mapInArrow(_sum_slices, "slice int, counts binary").collect()
    )
    counts = np.zeros((64, (1 << bits) // 64), np.uint64)
    for part in slices:
        counts[part["slice"]] = np.frombuffer(part["counts"], np.uint64)
    counts = np.minimum(counts, 2**31 - 1).astype(np.int32).ravel()
    sketch = spark.sparkContext.broadcast(counts)
    postings = int(counts.sum(dtype=np.int64)) * (100 - percent) // 100
    buckets = max(12, -(-postings // bucket_tokens))
    tokens = stored(
        rows.mapInArrow(_prefixes(sketch, width, percent, buckets, hot, bits), POSTINGS)
        .groupBy("bucket")
        .applyInArrow(_shared_tokens(buckets), "token long, node long, n int, pos int"),
        "tokens",
    )

    centre = tokens.groupBy("token").agg(
        F.min(F.struct((F.col("pos") / F.col("n")).alias("share"), "n", "pos", "node")).alias("h")
    )
    centre = centre.select("token", "h.n", "h.pos", "h.node")
    star = (
        tokens.alias("x").join(centre.alias("h"), "token")
        .where((F.col("x.node") != F.col("h.node")) & _enough(percent, "x", "h"))
        .select(*_pair(F.col("x.node"), F.col("h.node"))).distinct()
    )
    star = stored(star, "star")
    links = _verified(star, rows, sets, width, percent)
    known = stored(components(links), "known")

    placed = tokens.join(known, "node", "left").select(
        "token", "node", "n", "pos", F.coalesce("component", "node").alias("c")
    )
    home = centre.join(known, "node", "left").select("token", F.coalesce("component", "node").alias("home"))
    outside = placed.join(home, "token").where("c != home").drop("home")
    cross = (
        outside.alias("x").join(placed.alias("y"), "token")
        .where((F.col("x.c") != F.col("y.c")) & _enough(percent, "x", "y"))
        .select(*_pair(F.col("x.node"), F.col("y.node"))).distinct()
        .join(star, ["a", "b"], "left_anti")
    )
    cross = stored(cross, "cross")
    links = links.union(_verified(cross, rows, sets, width, percent))
    known = stored(components(links), "known")

    nodes = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(least, "component").select("node", "component_id", "component")
    return sets.join(nodes, "node", "left").select(
        "rid",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("component")).alias("component"),
    )


def op6_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return link_documents(docs).select("doc_id", "n_shingles", "component_id")


# Quadratic, but complete: every shingle of every text, every pair that shares one.
ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [md5(array_to_string(ws, ' '))]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: md5(array_to_string(ws[i:i + 4], ' '))) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i
    FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * i >= 75 * (p.n + q.n - i)),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a)
  SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(reach.least, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.a = d.doc_id
"""
