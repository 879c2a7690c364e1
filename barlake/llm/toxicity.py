"""Toxicity by the nearest labelled examples, exact TF-IDF cosine over a block-max index.

The labelled examples are a bounded sample: at most ``sample`` training rows of either
label, those with the least hash of their id.  Everything else covers the whole corpus:
document frequencies are counted over every text and every text is scored whole.

* Terms are whole words: runs of letters (A-Z lower-cased; characters above ASCII count as
  letters).  The index keeps every word of the examples, however rare.  Vectors are (1 + ln tf) * idf * relevance, of length
  one; relevance is 0.1 plus the size of the log ratio of the term's shares among toxic and
  clean examples, a weight that is never 0.  Words that no example has can match none and are
  left out of a text's vector.
* The index is inverted: per term its examples with their weights, in blocks of ``block``
  examples, and the greatest weight of each block.  Terms of an eighth of the examples or more
  are rows of a matrix instead, multiplied for many texts at once.  What they give and a text's
  other terms bound every block; the blocks with the highest bounds are read first, then those
  that can still reach the k-th best.
  The k nearest are exact, ties to the smaller id.
* Each neighbour votes with 1 / (distance + 0.1), distance being 1 - cosine; ``prior`` votes
  are cast at the share of toxic rows.
  A logistic curve, fitted on the examples with each left out of its own neighbours, turns
  votes into a probability; the ids of the neighbours are the evidence.

Null and empty texts and texts without a word of the examples have no neighbours and get the probability of the prior votes alone.  Labels are taken per id (the greatest, if one repeats); without
labels of both kinds every score is the share of toxic rows, 0 without any.  Rows that
repeat get equal scores; null ids are never training rows; only the columns named are kept.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from barlake.llm.components import stored

LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def tokens(body: bytes | None) -> list[bytes]:
    return body.translate(LETTERS).split() if body else []


def found_in(chosen: dict[bytes, int], body: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions of a text's terms, ascending, and how often they occur."""
    found = [at for at in map(chosen.get, tokens(body)) if at is not None]
    return np.unique(np.array(found, np.int64), return_counts=True)


def _body(docs: DataFrame, *names) -> DataFrame:
    return docs.select(F.col("text").cast("binary").alias("_body"), *names)


def training_rows(labels: DataFrame) -> DataFrame:
    """(doc_id, y) of the rows whose checksum mod 3 is not 1."""
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    return known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("y"))


def _terms(batches):
    """Task: the distinct terms of labelled texts."""
    for batch in batches:
        rows = []
        for body, key, y in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            rows.append({"doc_id": key, "y": y, "terms": list(set(tokens(body.as_py())))})
        yield pa.RecordBatch.from_pylist(rows, _EXAMPLES)


_EXAMPLES = pa.schema(
    [("doc_id", pa.int64()), ("y", pa.int32()), ("terms", pa.list_(pa.binary()))]
)


def _frequencies(chosen: dict[bytes, int]):
    """Task: in how many texts each term of the examples occurs; the last entry counts texts."""

    def run(batches):
        df = np.zeros(len(chosen) + 1, np.int64)
        for batch in batches:
            for body in batch.column(0):
                df[found_in(chosen, body.as_py())[0]] += 1
            df[-1] += len(batch)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    return run


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    size = stop - start
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())


class BlockMaxIndex:
    """Inverted index of unit vectors in blocks, with each block's greatest weight per term."""

    def __init__(self, ids, labels, vectors: list, width: int, block: int = 64):
        # A vector is a dict, or its terms and their weights as arrays.
        vectors = [(np.array([*v], np.int64), np.array([*v.values()], float)) if isinstance(v, dict) else v for v in vectors]
        # Examples whose heaviest terms agree share blocks, which keeps the bounds tight.
        heaviest = [terms[np.lexsort((terms, -weights))].astype(">u4").tobytes() for terms, weights in vectors]
        order = sorted(range(len(ids)), key=lambda i: (heaviest[i], ids[i]))
        self.ids, self.labels = np.array([ids[i] for i in order], np.int64), np.array([labels[i] for i in order], float)
        self.block, self.blocks = block, -(-len(order) // block)
        term = np.concatenate([np.zeros(0, np.int64), *(vectors[i][0] for i in order)])
        weight = np.concatenate([np.zeros(0), *(vectors[i][1] for i in order)])
        at = np.repeat(np.arange(len(order)), np.array([len(vectors[i][0]) for i in order], np.int64))
        often = np.flatnonzero(np.bincount(term, minlength=width) * 8 >= max(len(order), 64))
        self.row = np.full(width, -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), self.blocks * block))
        dense = self.row[term] >= 0
        self.matrix[self.row[term[dense]], at[dense]] = weight[dense]
        term, at, weight = term[~dense], at[~dense], weight[~dense]
        sort = np.lexsort((at, term))
        term, at, self.weight = term[sort], at[sort], weight[sort]
        self.at = at.astype(np.int32)
        # A list is the postings of a term in a block.
        new = np.flatnonzero(np.diff(term * self.blocks + at // block, prepend=-1))
        self.start = np.append(new, len(term))
        self.of_block = (at[new] // block).astype(np.int32)
        self.most = np.maximum.reduceat(self.weight, new) if len(new) else np.zeros(0)
        self.lists = np.searchsorted(term[new], np.arange(width + 1))

    def nearest(self, query: dict[int, float], k: int, without: int | None = None):
        """(cosine, example) of the k nearest with a cosine above 0, best first, ties to the smaller id."""
        terms = np.array(sorted(query), np.int64)
        return self.nearest_each([(terms, np.array([query[t] for t in terms.tolist()], float))], k, [without])[0]

    def nearest_each(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list | None = None) -> list:
        """The same for many queries, each its terms, ascending, and their weights."""
        dense = np.zeros((len(queries), len(self.matrix)))
        for i, (terms, weights) in enumerate(queries):
            row = self.row[terms]
            dense[i, row[row >= 0]] = weights[row >= 0]
        return [
            self._nearest(terms, weights, part, k, without[i] if without else None)
            for i, ((terms, weights), part) in enumerate(zip(queries, dense @ self.matrix))
        ]

    def _nearest(self, terms, weights, part, k, without):
        sparse = self.row[terms] < 0
        terms, weights = terms[sparse], weights[sparse]
        lo, hi = self.lists[terms], self.lists[terms + 1]
        lists, w = _ranges(lo, hi), np.repeat(weights, hi - lo)
        part = part.reshape(self.blocks, self.block)
        bounds = part.max(1) + np.bincount(self.of_block[lists], w * self.most[lists], self.blocks) if self.blocks else np.zeros(0)
        best: list[tuple[float, int, int]] = []
        first = np.zeros(self.blocks, bool)
        first[np.argsort(-bounds, kind="stable")[: max(4, self.blocks // 16)]] = True
        for chosen in (first, ~first):
            least = -best[-1][0] if len(best) == k else 0.0
            chosen = chosen & (bounds > 0) & (bounds >= least - 1e-12)
            if not chosen.any():
                continue
            read = chosen[self.of_block[lists]]
            lo, hi = self.start[lists[read]], self.start[lists[read] + 1]
            held = _ranges(lo, hi)
            scores = np.bincount(self.at[held], np.repeat(w[read], hi - lo) * self.weight[held], self.blocks * self.block)
            scores = np.where(chosen[:, None], scores.reshape(part.shape) + part, 0).ravel()[: len(self.ids)].round(12)
            if len(scores) > k + 1:
                # One more than k, as ``without`` may be among them.
                least = max(least, np.partition(scores, -k - 1)[-k - 1])
            found = np.flatnonzero((scores > 0) & (scores >= least))
            if len(found) > 4 * k + 4:
                # Many equal scores: only those with the smaller ids can win.
                found = found[np.lexsort((self.ids[found], -scores[found]))[: k + 1]]
            found = [(-float(scores[a]), int(self.ids[a]), int(a)) for a in found]
            best = sorted(best + [x for x in found if x[1] != without])[:k]
        return [(-s, at) for s, _, at in best]


def _found(chosen: dict[bytes, int]):
    """Task: the index terms of labelled texts and how often they occur."""

    def run(batches):
        for batch in batches:
            counts = [found_in(chosen, body.as_py()) for body in batch.column(0)]
            done = [pa.array([c[i] for c in counts], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *done], names=["doc_id", "y", "found", "times"])

    return run


def vector(terms: np.ndarray, times: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms found in a text and their weights, of length one."""
    raw = (1 + np.log(times)) * heavy[terms]
    return terms, raw / np.sqrt((raw * raw).sum()) if len(raw) else raw


def votes(index: BlockMaxIndex, near, share: float, prior: float) -> float:
    cast = [(1 / (1.1 - s), index.labels[at]) for s, at in near]
    return (sum(w * y for w, y in cast) + prior * share) / (sum(w for w, _ in cast) + prior)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and constant of the calibration curve, by Newton's steps with a light ridge."""
    a = np.zeros(2)
    design = np.stack([x, np.ones(len(x))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        slope = design.T @ (weight * (p - y)) + 1e-2 * a
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        a -= np.linalg.solve(curve, slope)
    return float(a[0]), float(a[1])


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 2000, k: int = 16, prior: float = 1.0
) -> dict:
    """The model: terms with their weights, the index of the sample, and the calibration curve."""
    rows = training_rows(labels)
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    share = toxic / max(1, toxic + clean)
    model = {"share": share, "k": k, "prior": prior, "chosen": {}, "curve": None}
    if not toxic or not clean:
        return model
    picked = None
    for y in (0, 1):
        part = rows.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = part if picked is None else picked.union(part)
    # At most 2 * sample rows of two numbers each.
    held = _body(docs, F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(picked), "doc_id").select("_body", "doc_id", "y")
    held = stored(held.dropDuplicates(["doc_id"]), "examples")
    examples = held.mapInArrow(_terms, "doc_id long, y int, terms array<binary>")
    n = {r["y"]: r["n"] for r in examples.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return model
    # As many rows as the sample has different terms.
    every = examples.select(F.explode("terms").alias("term")).distinct().toArrow()["term"].to_pylist()
    chosen = {t: i for i, t in enumerate(sorted(every))}
    counted = _body(docs).mapInArrow(_frequencies(chosen), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(len(chosen) + 1)
    df[counted["term"].to_numpy()] = counted["df"].to_numpy()
    held = held.mapInArrow(_found(chosen), "doc_id long, y int, found array<bigint>, times array<bigint>").toArrow().sort_by("doc_id")
    ids, ys = held["doc_id"].to_pylist(), held["y"].to_pylist()
    texts = [(f.values.to_numpy(), t.values.to_numpy()) for f, t in zip(held["found"], held["times"])]
    shares = []
    for y in (1, 0):
        at = [f for (f, _), label in zip(texts, ys) if label == y]
        shares.append((np.bincount(np.concatenate(at), minlength=len(chosen)) + 0.5) / (n[y] + 1))
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    heavy = idf * (0.1 + np.abs(np.log(shares[0] / shares[1])))
    vectors = [vector(f, t, heavy) for f, t in texts]
    full = [i for i, (f, _) in enumerate(vectors) if len(f)]
    index = BlockMaxIndex(
        [ids[i] for i in full], [ys[i] for i in full], [vectors[i] for i in full], len(chosen)
    )
    near = [x for at in range(0, len(ids), 64) for x in index.nearest_each(vectors[at : at + 64], k, ids[at : at + 64])]
    raw = np.array([votes(index, x, share, prior) for x in near])
    weight = np.where(np.array(ys) == 1, toxic / n[1], clean / n[0])
    curve = _logistic(raw, np.array(ys, float), weight)
    return model | {"chosen": chosen, "heavy": heavy, "index": index, "curve": curve}


def _score(shared, first: int):
    """Task: the columns from ``first`` on, with score and evidence; column 0 is the text."""

    def run(batches):
        model = pickle.loads(shared.value)
        chosen, index = model["chosen"], model.get("index")
        # Slices keep the matrix of partial scores small.
        for batch in (b.slice(at, 64) for b in batches for at in range(0, len(b), 64)):
            if model["curve"] is None:
                scores, near = [model["share"]] * len(batch), [[]] * len(batch)
            else:
                bodies = batch.column(0).cast(pa.binary())
                found = index.nearest_each([vector(*found_in(chosen, body.as_py()), model["heavy"]) for body in bodies], model["k"])
                raw = np.array([votes(index, x, model["share"], model["prior"]) for x in found])
                slope, constant = model["curve"]
                scores = 1 / (1 + np.exp(-np.clip(slope * raw + constant, -30, 30)))
                near = [[int(index.ids[at]) for _, at in x] for x in found]
            done = [pa.array(scores, pa.float64()), pa.array(near, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[first:], *done], names=[*batch.schema.names[first:], "score", "evidence"])

    return run


def score(docs: DataFrame, model: dict, *names: str, text_as: str | None = None) -> DataFrame:
    """The named columns of ``docs`` with score (0 to 1) and evidence (ids of the nearest examples).

    ``text_as`` also gives the text back, under this name: a text then travels once, not once
    to be scored and once to be kept.  The model that is broadcast holds at most 2 * sample
    examples with all their terms.
    """
    rows = _body(docs, *names) if text_as is None else docs.select(F.col("text").alias(text_as), *names)
    first = 1 if text_as is None else 0
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[first:])
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    return rows.mapInArrow(_score(shared, first), f"{schema}, score double, evidence array<bigint>")


def op8_toxicity_nearest_examples(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    scored = score(docs, model, "doc_id")
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")
