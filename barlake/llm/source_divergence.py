"""Audit of how far the sources of a language differ in their words, by cube partitioning.

Each task owns one cell of a cube: a block of sources, a block of sources and a block of terms.
The term shares of a source block are cut into slices by term block, and a slice is replicated
to the cells of that block with every other block and to no more.  A cell has all it needs for
its part of the divergences: those of each source in one block from each in the other, in both
directions, summed over its terms, and on the diagonal those of each source from its language,
term by term, of which it keeps the largest.  Sums and largest terms are then reduced along the
term axis.

* Words are counted in the tasks that read them, so a source with a third of all rows sends
  one row per task and distinct term.
* A cell holds at most about ``2 * sources * terms`` shares: memory does not depend on the number
  of documents, sources or terms.  Cells of a language with S sources and V terms number
  (S / sources)**2 / 2 * V / terms.
* Shares are whole billionths, computed from counts as decimals; everything else is 64-bit
  integers, so results are exact and do not depend on partitions.

A term is a run of letters (A-Z lower-cased, and all that is not ASCII).  Null text, language or
source is read as ''.  A language keeps the terms that ``least`` of its documents hold; without
any, its divergences are 0.  A source without terms takes part, a language with one source has
no pairs.  Repeated rows are documents of their own; ids are not read, extra columns are
ignored, an empty table gives no rows.  Ties go to the smaller item by UTF-8.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from barlake.llm.components import stored

# Bytes of letters stay (A-Z in lower case), other ASCII separates, bytes above it belong to terms.
LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256)).lower()
COUNTS = "lang string, source string, term string, n long, docs long"
ROWS = "lang string, i int, j int, k int, kind int, block int, source string, term string, p long, v long"
HEAD, SLICE, LANGUAGE = 0, 1, 2


def _counts(most: int):
    """Task: occurrences and documents per source and term, and a row without term per source."""

    def rows(held):
        for (lang, source), (words, docs) in held.items():
            terms = list(words)
            columns = [[lang] * (len(terms) + 1), [source] * (len(terms) + 1), [None, *(t.decode() for t in terms)]]
            numbers = [[0, *words.values()], [0, *(docs[t] for t in terms)]]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.string()) for c in columns), *(pa.array(c, pa.int64()) for c in numbers)],
                names=["lang", "source", "term", "n", "docs"],
            )

    def run(batches):
        held, size = {}, 0
        for batch in batches:
            langs, sources, texts = batch.columns
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts):
                words, docs = held.setdefault((lang, source), (Counter(), Counter()))
                terms = text.as_buffer().to_pybytes().translate(LETTERS).split()
                size -= len(words)
                words.update(terms)
                docs.update(set(terms))
                size += len(words)
                if size > most:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    return run


def _share(count: str, total: str, kinds: str):
    """Whole billionths plus one, by decimals: a count times a billion can pass 64 bits."""
    exact = f"1 + (CAST({count} + 1 AS DECIMAL(20, 0)) * 1000000000) div CAST({total} + {kinds} AS DECIMAL(20, 0))"
    return F.when(F.expr(f"{total} + {kinds} > 0"), F.expr(exact)).otherwise(F.lit(1)).cast("long")


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _cell(top: int):
    """Group: partial divergences of the cell's pairs, and on the diagonal the largest terms of each source."""

    def run(table):
        lang, i, j = (table.column(c)[0].as_py() for c in ("lang", "i", "j"))
        heads = table.filter(pc.equal(table.column("kind"), HEAD))
        sources = heads.column("source").to_pylist()
        block = heads.column("block").to_numpy()
        floor, kinds = heads.column("p").to_numpy(), heads.column("v")[0].as_py()
        places = {s: at for at, s in enumerate(sources)}

        rest = table.filter(pc.not_equal(table.column("kind"), HEAD))
        coded = rest.column("term").combine_chunks().dictionary_encode()
        terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        share, kind = rest.column("p").to_numpy(), rest.column("kind").to_numpy()
        mine = kind == SLICE
        row = np.array([places[s] for s in rest.column("source").filter(pa.array(mine)).to_pylist()], int)
        p = np.repeat(floor[:, None], len(terms), 1)
        p[row, code[mine]] = share[mine]

        out = []
        for a, source in enumerate(sources):
            others = np.flatnonzero(block != block[a]) if i != j else np.delete(np.arange(len(sources)), a)
            # Terms of the block that neither side of the cell holds differ by the floors alone.
            neither = (kinds - len(terms)) * _divergence(floor[a], floor[others])
            sums = _divergence(p[a], p[others]).sum(1) + neither
            out += [(lang, source, "pair", sources[b], int(x)) for b, x in zip(others, sums)]
        if i == j and len(terms):
            q = np.empty(len(terms), np.int64)
            q[code[~mine]] = share[~mine]
            alphabetic = np.empty(len(terms), int)
            alphabetic[pc.sort_indices(terms.cast(pa.binary())).to_numpy()] = np.arange(len(terms))
            for a, source in enumerate(sources):
                own = code[mine][row == a]
                own = own[p[a, own] > q[own]]
                value = _divergence(p[a, own], q[own])
                first = np.lexsort((alphabetic[own], -value))[:top]
                out += [(lang, source, "term", terms[int(t)].as_py(), int(x)) for t, x in zip(own[first], value[first])]
        columns = list(zip(*out)) or [()] * 5
        return pa.table({
            name: pa.array(c, pa.int64() if name == "value" else pa.string())
            for name, c in zip(("lang", "source", "part", "item", "value"), columns)
        })

    return run


def _cells(rows: DataFrame) -> DataFrame:
    """The cells of a source block: with every block of its language, itself included."""
    return (
        rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "with"), "j": F.greatest("block", "with")})
        .selectExpr(*ROWS_FROM)
    )


ROWS_FROM = ["lang", "i", "j", "k", "kind", "block", "source", "term", "p", "v"]


def divergences(
    docs: DataFrame, least: int = 3, top: int = 200, sources: int = 16, terms: int = 4096, most: int = 400_000
) -> DataFrame:
    """(lang, source, part, item, value, rank) over ``docs`` (text, lang, source).

    Part ``pair`` has the divergence of a source from each other one of its language, part
    ``term`` the ``top`` terms in which a source exceeds its language.  ``sources`` and ``terms``
    are the sizes of a cell's blocks, ``most`` the distinct terms a counting task holds.
    """
    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = read.withColumn("text", F.col("text").cast("binary")).mapInArrow(_counts(most), COUNTS)
    counts = stored(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")

    # A window holds one row per source.
    of_term = Window.partitionBy("lang", "term")
    block_of = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    kept = stored(
        counts.where("term IS NOT NULL")
        .withColumns({"held": F.sum("docs").over(of_term), "total": F.sum("n").over(of_term)})
        .withColumn("first", F.row_number().over(of_term.orderBy("source")) == 1)
        .where(F.col("held") >= least)
        .select("lang", "source", "term", "n", "total", "first"),
        "kept",
    )
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.count_if("first").alias("firsts"))
    groups = counts.where("term IS NULL").select("lang", "source").join(own, ["lang", "source"], "left").fillna(0, ["own", "firsts"])
    langs = groups.groupBy("lang").agg(
        F.sum("own").alias("words"),
        F.sum("firsts").alias("kinds"),
        F.greatest(F.lit(1), F.ceil(F.count("*") / sources)).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.sum("firsts") / terms)).cast("int").alias("parts"),
    )
    groups = stored(
        groups.join(langs, "lang").withColumn("block", block_of("source", "blocks")).withColumn("floor", _share("0", "own", "kinds")),
        "groups",
    )

    # What a row needs of its language comes with its source: no join puts a language in one task.
    of_group = ["lang", "source", "own", "words", "kinds", "blocks", "parts", "block"]
    rows = kept.join(groups.select(*of_group), ["lang", "source"]).withColumn("k", block_of("term", "parts"))
    slices = rows.withColumns({"p": _share("n", "own", "kinds"), "kind": F.lit(SLICE), "v": F.lit(0).cast("long")})
    placed = rows.where("first")
    in_part = placed.groupBy("lang", "k").agg(F.count("*").alias("v"))
    heads = (
        groups.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(in_part, ["lang", "k"], "left").fillna(0, ["v"])
        .withColumns({"kind": F.lit(HEAD), "term": F.lit(None).cast("string"), "p": F.col("floor")})
    )
    diagonal = (
        placed.drop("source", "block").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"j": F.col("i"), "block": F.col("i"), "kind": F.lit(LANGUAGE), "source": F.lit(None).cast("string")})
        .withColumns({"p": _share("total", "words", "kinds"), "v": F.lit(0).cast("long")})
        .selectExpr(*ROWS_FROM)
    )
    # A block that hashing left without a source has no cells.
    filled = groups.select("lang", F.col("block").alias("i")).distinct()
    diagonal = diagonal.join(filled, ["lang", "i"], "left_semi").selectExpr(*ROWS_FROM)
    cells = _cells(slices).unionByName(_cells(heads)).unionByName(diagonal)
    parts = stored(
        cells.groupBy("lang", "i", "j", "k").applyInArrow(_cell(top), "lang string, source string, part string, item string, value long"),
        "cells",
    )

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", rank)
    largest = parts.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= top)
    return pairs.unionByName(largest)


def op11_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Divergences of all sources of all documents, pair by pair and term by term."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return divergences(docs.select("text", "lang", "source"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
w AS (SELECT id, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
c AS (SELECT w.lang, source, w.term, count(*)::HUGEINT AS n FROM w JOIN kept k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL),
kinds AS (SELECT lang, count(*)::HUGEINT AS v, sum(total)::HUGEINT AS words FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS own FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
p AS (
  SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (gn.own + kinds.v) AS p,
    1 + (1000000000 * (k.total + 1)) // (kinds.words + kinds.v) AS q
  FROM gn JOIN kinds ON kinds.lang = gn.lang JOIN kept k ON k.lang = gn.lang
  LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
WHERE part = 'pair' OR rank <= 200
"""
