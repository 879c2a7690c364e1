"""Interpolated modified Kneser-Ney bigram model, counted in Spark and memory-mapped by workers.

Training takes two passes over the texts.  Tasks count words, then pairs of neighbouring
words, and send packed arrays to buckets of the hash range; each bucket sums its part and
writes it as sorted arrays to the shared model folder.  A context that holds a large share
of all words has its pairs spread over all buckets, so no bucket follows one word.

Model folder, for bucket b of 2**bits (hashes are 64 bits, sorted, so the buckets one after
another are one sorted array): ``words-b.npy`` word hashes with ``count`` (occurrences),
``left`` (distinct words before it), ``total`` and ``n1 n2 n3`` (occurrences as a context
and its continuations seen once, twice, more often); ``pairs-b.npy`` pair hashes with
``pair_count``.  Workers map these files and search them; nothing is loaded whole, and what
they hold in memory does not grow with the model.

    p(w | v) = max(c(v w) - D(c), 0) / c(v .) + g(v) * q(w)
    q(w)     = max(N(. w) - D'(N), 0) / N(. .) + g' / (V + 1)

with the three discounts of the modified form at either level, g and g' the mass they free,
and N the number of distinct words before w.  The start of a text is the context END; every
unknown word shares the one extra place of the last term.  A text's score is the sum of
log10 p over its words and one END.

Null and empty texts are one END; rows that repeat count as often as they occur; a null id
counts as training; with no training rows every word has probability 1.  The model folder
must be a path every executor has mounted (the folder of ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barlake.llm.words import WordHashes, by_bucket, mix, pack, pieces, sequence_hashes, unpack
from barlake.sources.scratch import scratch_path

END = 0x243F6A8885A308D3
TOKENS_A_TASK_STEP = 3_000_000


def model_folder(spark) -> str:
    """A fresh folder on the mounted shared path."""
    path = urlparse(scratch_path(spark, "ngrams"))
    if path.scheme not in ("", "file"):
        raise ValueError(f"workers map the model: {path.scheme}: is no mounted path")
    os.makedirs(path.path, exist_ok=True)
    return path.path


def save(folder: str, name: str, values: np.ndarray) -> None:
    """Write an array; a retried task replaces it with the same content."""
    held = f"{folder}/.{name}-{uuid.uuid4().hex}.npy"
    np.save(held, values)
    os.replace(held, f"{folder}/{name}.npy")


def load(folder: str, name: str) -> np.ndarray:
    return np.load(f"{folder}/{name}.npy", mmap_mode="r")


def _steps(batches):
    """Arrays of word hashes with END before, between and after texts, of bounded length."""
    words, parts, size = WordHashes(), [np.array([END], np.uint64)], 1
    end = np.array([END], np.uint64)
    for batch in batches:
        for rows in pieces(batch):
            for _, body in rows:
                ids = words.of(body)
                parts += [ids, end]
                size += len(ids) + 1
            if size >= TOKENS_A_TASK_STEP:
                yield np.concatenate(parts)
                parts, size = [end], 1
    if size > 1:
        yield np.concatenate(parts)


def _rows(out, names):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*out))], names=names
    )


def _shift(bits: int) -> np.uint64:
    return np.uint64(64 - bits)


def _count_words(bits: int):
    def run(batches):
        for ids in _steps(batches):
            keys, counts = np.unique(ids[1:], return_counts=True)
            out = [[b, *pack(keys[at], counts[at].astype(np.uint32))] for b, at in by_bucket((keys >> _shift(bits)).astype(np.int64))]
            yield _rows(out, ["bucket", "keys", "counts"])

    return run


def _sum(keys: np.ndarray, counts: np.ndarray):
    """Distinct keys in order with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def _write_words(folder: str):
    """Group: the bucket's words, sorted; returns their number and occurrences."""

    def run(table):
        b = table.column("bucket")[0].as_py()
        keys, counts = _sum(unpack(table.column("keys"), np.uint64), unpack(table.column("counts"), np.uint32))
        save(folder, f"words-{b}", keys)
        save(folder, f"count-{b}", counts)
        most = np.argsort(-counts)[:8]
        return pa.table(
            {
                "bucket": pa.array([b], pa.int32()),
                "words": pa.array([len(keys)], pa.int64()),
                "tokens": pa.array([int(counts.sum())], pa.int64()),
                "often": pa.array([keys[most].tobytes()], pa.binary()),
                "times": pa.array([counts[most].tobytes()], pa.binary()),
            }
        )

    return run


def pair_place(context: np.ndarray, word: np.ndarray, hot: np.ndarray, bits: int):
    """Bucket and sorted key of pairs: by context, or spread out for the hot contexts."""
    key = mix(context * np.uint64(0x9E3779B97F4A7C15) + mix(word))
    spread = np.isin(context, hot)
    bucket = np.where(spread, key & np.uint64((1 << bits) - 1), context >> _shift(bits))
    return bucket, (bucket << _shift(bits)) | (key >> np.uint64(bits))


def _count_pairs(hot, bits: int):
    def run(batches):
        for ids in _steps(batches):
            v, w = ids[:-1], ids[1:]
            bucket, key = pair_place(v, w, hot, bits)
            order = np.argsort(key)
            starts = np.flatnonzero(np.r_[True, np.diff(key[order].view(np.int64)) != 0])
            counts = np.diff(np.r_[starts, len(key)]).astype(np.uint32)
            first = order[starts]
            v, w, bucket = v[first], w[first], bucket[first]
            out = []
            for b, at in by_bucket(bucket.astype(np.int64)):
                at = at[np.argsort(v[at], kind="stable")]
                heads = np.flatnonzero(np.r_[True, np.diff(v[at].view(np.int64)) != 0])
                runs = np.diff(np.r_[heads, len(at)]).astype(np.uint32)
                out.append([b, *pack(v[at][heads], runs, w[at], counts[at])])
            yield _rows(out, ["bucket", "contexts", "runs", "words", "counts"])

    return run


def _counts_of_counts(counts: np.ndarray) -> bytes:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.int64).tobytes()


def _write_pairs(folder: str, hot, bits: int):
    """Group: the bucket's pairs, sorted; returns what they add to words and contexts."""

    def run(table):
        b = table.column("bucket")[0].as_py()
        runs = unpack(table.column("runs"), np.uint32)
        v = np.repeat(unpack(table.column("contexts"), np.uint64), runs)
        w, counts = unpack(table.column("words"), np.uint64), unpack(table.column("counts"), np.uint32)
        _, key = pair_place(v, w, hot, bits)
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(key[order].view(np.int64)) != 0])
        counts = np.add.reduceat(counts[order].astype(np.int64), starts)
        first = order[starts]
        v, w = v[first], w[first]
        save(folder, f"pairs-{b}", key[first])
        save(folder, f"pair_count-{b}", counts.astype(np.uint32))
        words, left = np.unique(w, return_counts=True)
        contexts, at = np.unique(v, return_inverse=True)
        size = len(contexts)
        parts = [np.bincount(at, counts, size).astype(np.int64)]
        parts += [np.bincount(at[pick], minlength=size) for pick in (counts == 1, counts == 2, counts > 2)]
        keys = np.union1d(words, contexts)
        stats = np.zeros((5, len(keys)), np.int64)
        stats[0, np.searchsorted(keys, words)] = left
        stats[1:, np.searchsorted(keys, contexts)] = parts
        seen, out = _counts_of_counts(counts), []
        for place, at in by_bucket((keys >> _shift(bits)).astype(np.int64)):
            out.append([place, *pack(keys[at], stats[:, at].T.astype(np.uint32)), seen])
            seen = None
        return pa.Table.from_batches([_rows(out, ["bucket", "keys", "stats", "seen"])])

    return run


def _write_stats(folder: str):
    """Group: left neighbours and context sums of the bucket's words, in the words' order."""

    def run(table):
        b = table.column("bucket")[0].as_py()
        keys, words = unpack(table.column("keys"), np.uint64), np.load(f"{folder}/words-{b}.npy")
        at = np.searchsorted(words, keys)
        stats = unpack(table.column("stats"), np.uint32).reshape(-1, 5)
        for i, name in enumerate(("left", "total", "n1", "n2", "n3")):
            sums = np.bincount(at, stats[:, i], len(words)).astype(np.int64)
            save(folder, f"{name}-{b}", sums)
            if name == "left":
                left = sums
        seen = sum((np.frombuffer(x, np.int64) for x in table.column("seen").to_pylist() if x), np.zeros(4, np.int64))
        return pa.table(
            {
                "pairs": pa.array([int(left.sum())], pa.int64()),
                "left_seen": pa.array([_counts_of_counts(left[left > 0])], pa.binary()),
                "left_more": pa.array([np.array([(left == 1).sum(), (left == 2).sum(), (left > 2).sum()]).tobytes()], pa.binary()),
                "pair_seen": pa.array([seen.tobytes()], pa.binary()),
            }
        )

    return run


def discounts(seen: np.ndarray) -> list[float]:
    """D1, D2, D3+ from the numbers of items seen one to four times; half an item if too few are."""
    n1, n2, n3, n4 = (float(x) for x in seen)
    if min(n1, n2, n3, n4) == 0:
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(raw)]


def train(docs: DataFrame, folder: str) -> dict:
    """Count the texts of ``docs`` into the model folder; returns the model's few numbers."""
    rows = docs.select(F.lit(0).cast("long").alias("key"), F.col("text").cast("binary").alias("body"))
    bits = max(4, min(14, int(np.ceil(np.log2(2 * max(1, rows.rdd.getNumPartitions()))))))
    heads = (
        rows.mapInArrow(_count_words(bits), "bucket int, keys binary, counts binary").groupBy("bucket")
        .applyInArrow(_write_words(folder), "bucket int, words long, tokens long, often binary, times binary").collect()
    )
    tokens, words = sum(h["tokens"] for h in heads), sum(h["words"] for h in heads)
    often = np.concatenate([np.frombuffer(h["often"], np.uint64) for h in heads] or [np.empty(0, np.uint64)])
    times = np.concatenate([np.frombuffer(h["times"], np.int64) for h in heads] or [np.empty(0, np.int64)])
    hot = np.sort(often[times >= max(1, tokens // (4 << bits))])
    sums = (
        rows.mapInArrow(_count_pairs(hot, bits), "bucket int, contexts binary, runs binary, words binary, counts binary")
        .groupBy("bucket")
        .applyInArrow(_write_pairs(folder, hot, bits), "bucket int, keys binary, stats binary, seen binary").groupBy("bucket")
        .applyInArrow(_write_stats(folder), "pairs long, left_seen binary, left_more binary, pair_seen binary").collect()
    )
    total = lambda name, k: sum((np.frombuffer(s[name], np.int64) for s in sums), np.zeros(k, np.int64))
    pairs = sum(s["pairs"] for s in sums)
    lower, upper = discounts(total("left_seen", 4)), discounts(total("pair_seen", 4))
    freed = float(np.dot(lower, total("left_more", 3)))
    return {
        "folder": folder,
        "bits": bits,
        "hot": hot,
        "tokens": tokens,
        "words": words,
        "pairs": pairs,
        "upper": upper,
        "lower": lower,
        "rest": (freed / pairs if pairs else 1.0) / (words + 1),
    }


class Mapped:
    """The model as mapped files, searched with sorted keys, bucket by bucket."""

    def __init__(self, model: dict):
        self.model, self.files = model, {}

    def array(self, name: str, bucket: int) -> np.ndarray | None:
        key = f"{name}-{bucket}"
        if key not in self.files:
            known = os.path.exists(f"{self.model['folder']}/{key}.npy")
            self.files[key] = load(self.model["folder"], key) if known else None
        return self.files[key]

    def find(self, table: str, keys: np.ndarray, names) -> list[np.ndarray]:
        """For sorted keys: the named columns, 0 where a key is not there."""
        out = [np.zeros(len(keys), np.int64) for _ in names]
        buckets = (keys >> _shift(self.model["bits"])).astype(np.int64)
        ends = np.flatnonzero(np.diff(buckets)) + 1
        for lo, hi in zip(np.r_[0, ends], np.r_[ends, len(keys)]):
            if lo == hi or (held := self.array(table, int(buckets[lo]))) is None or not len(held):
                continue
            at = np.minimum(np.searchsorted(held, keys[lo:hi]), len(held) - 1)
            hit = held[at] == keys[lo:hi]
            for column, name in zip(out, names):
                column[lo:hi][hit] = self.array(name, int(buckets[lo]))[at[hit]]
        return out

    def probabilities(self, ids: np.ndarray):
        """Of ids[1:], each after the one before it: (p, occurrences in training)."""
        model = self.model
        keys, at = np.unique(ids, return_inverse=True)
        count, left, total, n1, n2, n3 = (
            c[at] for c in self.find("words", keys, ("count", "left", "total", "n1", "n2", "n3"))
        )
        _, key = pair_place(ids[:-1], ids[1:], model["hot"], model["bits"])
        keys, at = np.unique(key, return_inverse=True)
        pair = self.find("pairs", keys, ("pair_count",))[0][at]
        cut = lambda c, d: np.maximum(c - np.array([0.0, *d])[np.minimum(c, 3)], 0)
        low = cut(left[1:], model["lower"]) / max(model["pairs"], 1) + model["rest"]
        d1, d2, d3 = model["upper"]
        seen = total[:-1] > 0
        whole = np.where(seen, total[:-1], 1)
        back = np.where(seen, (d1 * n1[:-1] + d2 * n2[:-1] + d3 * n3[:-1]) / whole, 1.0)
        return cut(pair, model["upper"]) / whole + back * low, count[1:]


SCORES = "n_tokens long, n_known long, base_score double, score double"


def _score(model: dict):
    def run(batches):
        words, mapped = WordHashes(), Mapped(model)
        unit, end = np.log10(model["tokens"] + model["words"] + 1), np.array([END], np.uint64)
        for batch in batches:
            columns = []
            for rows in pieces(batch, 4 << 20):
                parts, lengths = [end], []
                for _, body in rows:
                    ids = words.of(body)
                    parts += [ids, end]
                    lengths.append(len(ids) + 1)
                p, count = mapped.probabilities(np.concatenate(parts))
                starts = np.cumsum([0, *lengths[:-1]])
                base = np.log10(count + 1) - unit
                columns.append(
                    (lengths, *(np.add.reduceat(x, starts) for x in ((count > 0).astype(np.int64), base, np.log10(p))))
                )
            if columns:
                done = [pa.array(np.concatenate(c)) for c in zip(*columns)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[2:], *done], names=[*batch.schema.names[2:], "n_tokens", "n_known", "base_score", "score"]
                )

    return run


def score(docs: DataFrame, model: dict, keep: str) -> DataFrame:
    """The model's log10 probability of each text; ``keep``: schema of further columns to carry."""
    names = [part.split()[0] for part in keep.split(",")]
    rows = docs.select(F.lit(0).cast("long").alias("key"), F.col("text").cast("binary").alias("body"), *names)
    return rows.mapInArrow(_score(model), f"{keep}, {SCORES}")


def op2_kneser_ney_scoring(spark, sf_dir: str) -> DataFrame:
    """Every document scored by a model of those whose checksum mod 7 is not 2."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held)
    model = train(docs.where("not held_out"), model_folder(spark))
    scored = score(docs, model, "doc_id long, held_out boolean")
    return scored.withColumn("train_tokens", F.lit(model["tokens"]).cast("long"))
