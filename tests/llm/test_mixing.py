"""Pareto order sampling: every document's copies recomputed in plain Python."""

import pytest
from pyspark.sql import functions as F

from barlake.llm import mix_sources

SF_DIR = "/root/testdata/sf0.01"


def scale_of(sizes, wanted, favour):
    """c with sum(min(1, c * s ** favour) * s) == wanted, by bisection."""
    low, high = 0.0, 2.0
    for _ in range(200):
        c = (low + high) / 2
        low, high = (c, high) if sum(min(1, c * s**favour) * s for s in sizes) < wanted else (low, c)
    return high


def expected_copies(rows, favour):
    """(source, size, u) -> copies, one document at a time."""
    totals = {}
    for s, n, _ in rows:
        totals[s] = totals.get(s, 0) + n
    wanted, copies = mix_sources.targets(list(totals.items())), [0] * len(rows)
    for source, words in totals.items():
        mine = [i for i, r in enumerate(rows) if r[0] == source and r[1] > 0]
        whole = int(wanted[source] // words) if words else 0
        for i in mine:
            copies[i] = whole
        if not mine or wanted[source] <= whole * words:
            continue
        c = scale_of([rows[i][1] for i in mine], wanted[source] - whole * words, favour)
        p = {i: min(1.0, c * rows[i][1] ** favour) for i in mine}
        p = {i: 1.0 if x > 1 - 1e-9 else x for i, x in p.items()}
        for i in mine:
            copies[i] += p[i] == 1
        carry = 0.0
        borders = [float("inf"), *mix_sources.CLASSES, 1]
        for high, low in zip(borders, borders[1:]):
            group = [i for i in mine if low <= rows[i][1] < high and p[i] < 1]
            group.sort(key=lambda i: rows[i][2] / (1 - rows[i][2]) / (p[i] / (1 - p[i])))
            if not group:
                continue
            carry += sum(p[i] * rows[i][1] for i in group)
            share, got = max(carry, 0.0), 0
            for i in group:
                if got + rows[i][1] / 2 > share:
                    break
                got += rows[i][1]
                copies[i] += 1
            carry -= got
    return copies


@pytest.mark.parametrize("favour", [0.25, 1.0])
def test_every_document_is_recomputed(spark, favour):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = mix_sources.mixed(docs, favour=favour).withColumn("u", mix_sources._uniform()).collect()
    copies = expected_copies([(r.source, r["size"], r.u) for r in got], favour)
    assert [r.copies for r in got] == copies
    assert {r.copies for r in got if r["size"]} >= {0, 1, 2}


def test_longer_documents_are_likelier(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('w ', IF(id % 2 = 0, 20, 60)) AS text", "'a' AS source")
    near = lambda favour: {
        r["size"]: r.share
        for r in mix_sources.mixed(docs, epochs=0.4, favour=favour).groupBy("size").agg(F.avg("copies").alias("share")).collect()
    }
    # p = c * s ** favour with 20 * p(20) + 60 * p(60) = 0.4 * 80.
    flat, even = near(0.0), near(1.0)
    assert flat == {20: pytest.approx(0.4, abs=0.03), 60: pytest.approx(0.4, abs=0.03)}
    assert even == {20: pytest.approx(0.16, abs=0.03), 60: pytest.approx(0.48, abs=0.03)}


def test_certain_documents_are_taken(spark):
    # Odds by size would exceed 1 for the long documents: they are certain, the short ones share the rest.
    rows = [(i, "w " * 1000, "a") for i in range(3)] + [(100 + i, "w " * 10, "a") for i in range(400)]
    got = mix_sources.mixed(spark.createDataFrame(rows, "doc_id long, text string, source string"), epochs=0.6, favour=1.0).collect()
    assert all(r.copies == 1 for r in got if r["size"] == 1000)
    assert abs(sum(r.taken for r in got) - 0.6 * 7000) <= 5


def test_any_extra_column_is_kept(spark):
    names = ("ps", "es", "_cut", "_u", "_class", "p", "u", "bin", "place", "class", "whole", "scale", "doc", "plan_source", "end_bin", "a.b")
    docs = spark.createDataFrame([(i, "one two three", "s") for i in range(20)], "doc_id long, text string, source string")
    got = mix_sources.mixed(docs.withColumns({c: F.lit(c) for c in names}))
    assert got.columns == ["doc_id", "text", "source", *names, *mix_sources.ADDED]
    assert all(r[c] == c for r in got.collect() for c in names)
