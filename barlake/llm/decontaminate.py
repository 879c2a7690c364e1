"""Benchmark passages in training documents, by a broadcast set of word windows.

A benchmark item gives all its runs of ``width`` words; an item of fewer words is one run.
Every window of every document is looked up by a hash of three of its words in that set;
what is found is verified word by word against the windows themselves.

Only built-in expressions run.  A document is scanned once, in its own row: the set of
hashes is part of the expression, so nothing is exploded or shuffled but the hits.  The set
is broadcast while it holds at most ``broadcast_windows`` hashes; a larger benchmark takes
the other way, a shuffled join of the windows' hashes.

Null texts have no words and no hits; an item without words gives no window; repeated rows
each get their result; benchmark items may repeat, and null item ids are not listed; extra
columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from barlake.llm.components import stored

SEPARATORS = "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; none for a null."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    body = F.btrim(lower, F.lit(SEPARATORS))
    return F.when(F.coalesce(F.length(body), F.lit(0)) > 0, F.split(body, SPLIT)).otherwise(F.array().cast("array<string>"))


def _three(hashes: Column, at, width: Column | int) -> Column:
    """Hash of the first, middle and last word of the window that starts at ``at`` (from 0)."""
    return F.xxhash64(F.get(hashes, at), F.get(hashes, at + F.floor(F.lit(width) / 2).cast("int")), F.get(hashes, at + width - 1))


def benchmark_windows(benchmark: DataFrame, width: int = 13) -> DataFrame:
    """(item_id, width, window, key) for every distinct window of every item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("width", F.least(F.size("w"), F.lit(width)))
    runs = F.transform(
        F.sequence(F.lit(1), F.size("w") - F.col("width") + 1),
        lambda i: F.slice(F.col("w"), i, F.col("width")),
    )
    split = items.select("item_id", "width", F.explode(runs).alias("run"))
    hashes = F.transform("run", lambda x: F.xxhash64(x))
    key = F.xxhash64(F.get("h", F.lit(0)), F.get("h", F.floor(F.col("width") / 2).cast("int")), F.get("h", F.col("width") - 1))
    return (
        split.withColumn("h", hashes)
        .select("item_id", "width", F.concat_ws(" ", "run").alias("window"), key.alias("key"))
        .distinct()
    )


def _starts(width: int) -> Column:
    """Starts (from 0) of a document's windows."""
    last = F.size("w") - width
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _known_starts(keys: DataFrame, width: int) -> Column:
    """Starts whose hash is in the set of the benchmark's windows of this width."""
    known = [r["key"] for r in keys.where(F.col("width") == width).collect()]
    return F.filter(_starts(width), lambda at: _three(F.col("h"), at, width).isin(known))


def find_windows(docs: DataFrame, benchmark: DataFrame, width: int = 13, broadcast_windows: int = 200_000) -> DataFrame:
    """Hits per row of ``docs`` (doc_id, text): what is hit, by which items, and whether it counts.

    Columns: doc_id, rid (hash of id and text), n_words, n_hit (words in any occurrence of a
    window), n_items, items (sorted ids), spans (start word and length of each occurrence)
    and contaminated (n_hit > 0 and 20 * n_hit >= n_words).
    """
    windows = stored(benchmark_windows(benchmark, width), "windows")
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())
    keys = windows.select("width", "key").distinct()
    few = len(keys.limit(broadcast_windows + 1).collect()) <= broadcast_windows
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id"),
        F.xxhash64(F.col("doc_id"), F.col("text")).alias("rid"),
        words(F.col("text")).alias("w"),
    ).withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))

    def run(at, k):
        return F.struct(at.alias("pos"), F.lit(k).alias("width"), F.concat_ws(" ", F.slice("w", at + 1, k)).alias("window"))

    def runs_at(starts, k):
        return F.transform(starts, lambda at: run(at, k))

    def keyed_runs(k):
        return F.transform(_starts(k), lambda at: F.struct(_three(F.col("h"), at, k).alias("key"), run(at, k).alias("run")))

    whole = ["row", "doc_id", "rid", F.size("w").cast("long").alias("n_words")]
    if few:
        rows = rows.withColumns({f"at{k}": _known_starts(keys, k) for k in widths})
        hits = [runs_at(F.col(f"at{k}"), k) for k in widths]
        hit = F.concat(*hits) if hits else F.array().cast("array<struct<pos:int,width:int,window:string>>")
        rows = rows.select(*whole, F.explode_outer(hit).alias("hit")).select(*whole[:3], "n_words", "hit.*")
        matched = rows.join(windows.drop("key").withColumn("known", F.lit(True)), ["width", "window"], "left")
    else:
        runs = F.concat(*[keyed_runs(k) for k in widths])
        each = rows.select("row", F.explode(runs).alias("x")).select("row", "x.key", "x.run.*")
        hits = each.join(windows, ["key", "width", "window"]).select("row", "pos", "width", "item_id", F.lit(True).alias("known"))
        matched = rows.select(*whole).join(hits, "row", "left")
    matched = matched.withColumn("span", F.when(F.col("known"), F.struct("pos", "width")))
    grouped = matched.groupBy("row", "doc_id", "rid", "n_words").agg(
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["pos"], s["pos"] + s["width"] - 1)))
    return (
        grouped.withColumn("n_hit", F.size(F.array_distinct(covered)).cast("long"))
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .drop("row")
    )


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_windows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


ORACLE_SQL = r"""
WITH split AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
w AS (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'),
    lambda x: x <> '') AS ws
  FROM split),
bench AS (
  SELECT DISTINCT id AS item, least(len(ws), 13) AS k,
    unnest(list_transform(range(1, len(ws) - least(len(ws), 13) + 2),
      lambda i: array_to_string(ws[i:i + least(len(ws), 13) - 1], ' '))) AS win
  FROM w WHERE kind = 'b' AND len(ws) > 0),
docs AS (
  SELECT id, k, unnest(range(1, len(ws) - k + 2)) AS pos,
    unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS win
  FROM w CROSS JOIN (SELECT DISTINCT k FROM bench) WHERE kind = 'd' AND len(ws) >= k),
hits AS (SELECT docs.id, docs.pos, docs.k, bench.item FROM docs JOIN bench USING (k, win)),
per AS (
  SELECT id, count(DISTINCT item) AS n_items,
    sha256(string_agg(DISTINCT CAST(item AS VARCHAR), ',' ORDER BY CAST(item AS VARCHAR))) AS sha FROM hits GROUP BY id),
cover AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(pos, pos + k)) AS p FROM hits) GROUP BY id)
SELECT w.id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN per ON per.id = w.id LEFT JOIN cover ON cover.id = w.id WHERE kind = 'd'
"""
