"""Source divergence, MinHash join and dual-tree search against brute force, and their odd inputs."""

import math
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import dual_tree_search, minhash_join, source_divergence

DOCS = "doc_id long, text string, lang string, source string"
LONG = " ".join(f"w{i}" for i in range(60000))
CLASHES = ("rid", "node", "n", "pair", "c", "p", "v", "k", "i", "block", "term", "item", "rank", "score", "value", "part", "total", "first")


def with_clashes(df):
    return df.withColumns({c: F.lit("x") for c in CLASHES})


def texts(rng, count, words=40, longest=30):
    """Texts over a few words, some of them frequent, with non-ASCII and mixed case."""
    names = [f"{'ÄßéA'[i % 4]}w{i}{'x' * (i % 3)}" for i in range(words)]
    odds = 1 / np.arange(1, words + 1)
    return [" ".join(rng.choice(names, int(rng.integers(0, longest)), p=odds / odds.sum())) for _ in range(count)]


# --- divergence -------------------------------------------------------------------------------

LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def divergences(rows, least=3, top=200):
    docs = [(lang or "", source or "", LETTERS.findall(lower(text))) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for _, _, ts in mine for t in set(ts))
        kept = [t for t in held if held[t] >= least]
        sources = {s for _, s, _ in mine}
        count = {s: Counter(t for _, x, ts in mine if x == s for t in ts if held[t] >= least) for s in sources}
        whole = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (c.total() + len(kept)) for t in kept}
        p, q = {s: share(count[s]) for s in sources}, share(whole)
        f = lambda a, b: (a - b) ** 2 // b
        for a in sources:
            pairs = sorted((-sum(f(p[a][t], p[b][t]) for t in kept), b.encode()) for b in sources if b != a)
            terms = sorted((-f(p[a][t], q[t]), t.encode()) for t in kept if count[a][t] and p[a][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, a, part, x.decode(), -v, i) for i, (v, x) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("sources,terms,most", [(16, 4096, 400_000), (2, 5, 10)])
def test_divergences_against_plain_python(spark, sources, terms, most):
    rng = np.random.default_rng(1)
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{int(rng.integers(0, 7))}") for i, t in enumerate(texts(rng, 120))]
    rows += [(200, "A1b2,Äw0x A-b", "en", None), (201, None, "en", "empty"), (202, "alone", "xx", "one"), (203, "", None, "none"), (203, "", None, "none")]
    got = source_divergence.divergences(with_clashes(spark.createDataFrame(rows, DOCS)), 3, 5, sources, terms, most)
    assert sorted(map(tuple, got.collect())) == divergences(rows, 3, 5)


def test_divergences_of_nothing_and_of_large_counts(spark):
    assert source_divergence.divergences(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(i, LONG + " common" * 50000 * (i % 2), "en", f"s{i % 2}") for i in range(4)]
    got = source_divergence.divergences(spark.createDataFrame(rows, DOCS), 3)
    assert sorted(map(tuple, got.collect())) == divergences(rows)
    big = spark.createDataFrame([(700_000_000_000, 15_000_000_000_000, 9)], "n long, total long, kinds long")
    exact = 1 + 10**9 * 700_000_000_001 // 15_000_000_000_009
    assert big.select(source_divergence._share("n", "total", "kinds")).first()[0] == exact


# --- near duplicates --------------------------------------------------------------------------


def classes(rows, width=2, percent=80):
    sets = []
    for _, text in rows:
        ws = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append({tuple(ws[i : i + width]) for i in range(max(len(ws) - width, 0) + 1)} if ws else set())
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 100 * len(x & sets[j]) >= percent * len(x | sets[j]):
                group[top(i)] = top(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(top(i), []).append(i)
    least = {g: min((rows[i][0] for i in m if rows[i][0] is not None), default=None) for g, m in members.items()}
    return sorted(((rows[i][0], len(x), least[top(i)]) for i, x in enumerate(sets)), key=repr)


def check(spark, rows, **how):
    found = minhash_join.near_duplicates(with_clashes(spark.createDataFrame(rows, "doc_id long, text string")), **how).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == classes(rows)
    return found


def near_copies(rng, base, count):
    for _ in range(count):
        own = list(base)
        for at in rng.integers(0, len(base), rng.integers(0, 4)):
            own[at] = f"y{rng.integers(10**6)}"
        yield own


@pytest.mark.parametrize("how", [{}, {"block": 5, "family": 100}])
def test_near_duplicates_against_all_pairs(spark, how):
    rng = np.random.default_rng(5)
    rows = []
    for g in range(10):
        base = [f"g{g}x{i}" for i in range(30)] + "a passage that many of the documents share word by word".split() * int(g % 2)
        rows += near_copies(rng, base, 9)
    # Drifting copies: neighbours link, the ends do not.
    chain = [f"c{i}" for i in range(60)]
    rows += [[f"d{k}" if i < 3 * k else w for i, w in enumerate(chain)] for k in range(12)]
    rows = [(int(i), " ".join(ws)) for i, ws in zip(rng.permutation(len(rows)), rows)]
    check(spark, rows, **how)


def test_groups_give_out_no_pairs(spark, monkeypatch):
    """Unlinked texts that recombine passages meet in every list, but what leaves a task is at most a link per node."""
    rng = np.random.default_rng(6)
    passages = [" ".join(f"p{p}w{i}" for i in range(25)) for p in range(30)]
    rows = [(i, " ".join(passages[p] for p in rng.choice(30, 6, replace=False))) for i in range(200)]
    base = [f"b{i}" for i in range(80)]
    rows += [(1000 + i, " ".join(ws)) for i, ws in enumerate(near_copies(rng, base, 150))]
    given = []
    connected = minhash_join.components
    monkeypatch.setattr(minhash_join, "components", lambda links: (given.append(links.distinct().count()), connected(links))[1])
    check(spark, rows)
    assert given[1] < 150 and given[0] < 31 * 150


def connected(count, pairs):
    group, pairs = list(range(count)), list(pairs)
    for _ in range(count):
        for x, y in pairs:
            group[x] = group[y] = min(group[x], group[y])
    return group


def test_reached_connects_what_is_near():
    rng = np.random.default_rng(9)
    near = rng.random((60, 60)) < 0.02
    near |= near.T
    links = minhash_join.reached(60, lambda x, rest: near[x][rest])
    assert connected(60, links) == connected(60, zip(*np.nonzero(near))) and len(links) < 60
    assert minhash_join.reached(0, None) == minhash_join.reached(1, None) == []


def test_near_duplicates_of_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE"), (5, "ONE"), (6, "one two"), (None, "one two"), (None, "alone here"),
        (7, LONG), (8, LONG + " more"), (7, LONG), (9, "été été"), (10, "a b c"),
    ]
    found = check(spark, rows)
    assert {r.component for r in found if r.n_shingles == 0} == {None}
    assert minhash_join.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- ranked search ----------------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k=20):
    terms = [(key, WORDS.findall(lower(text))) for key, text in docs]
    terms = [(key, ts) for key, ts in terms if ts]
    n, words = len(terms), sum(len(ts) for _, ts in terms)
    df = Counter(t for _, ts in terms for t in set(ts))
    out = []
    for item, text in items:
        scores = []
        for key, ts in terms:
            m, tf, score = 75 + (25 * len(ts) * n) // words, Counter(ts), 0
            for t in WORDS.findall(lower(text)):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0 and key is not None:
                scores.append((-score, key))
        out += [(item, i, key, -s) for i, (s, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"block": 200_000, "cells": 100, "sample": 20}, {"sample": 10**6}])
def test_search_against_plain_python(spark, how):
    rng = np.random.default_rng(7)
    docs = list(enumerate(texts(rng, 300, words=200)))
    docs += [(500, docs[3][1]), (500, docs[3][1]), (501, None), (502, ""), (None, docs[4][1]), (503, LONG), (504, "A-1b,Äw0x")]
    items = list(enumerate(texts(rng, 25, words=200))) + [(70, None), (71, "not in any of them"), (72, docs[3][1] + " " + docs[3][1]), (73, LONG)]
    got = dual_tree_search.search(
        with_clashes(spark.createDataFrame(docs, "doc_id long, text string")),
        with_clashes(spark.createDataFrame(items + [items[0], (None, "w0")], "item_id long, text string")), 7, **how,
    )
    assert sorted(map(tuple, got.collect())) == ranked(docs, items, 7)


def test_search_of_nothing(spark):
    none, one = spark.createDataFrame([], "item_id long, doc_id long, text string"), spark.createDataFrame([(1, 1, "a")], "item_id long, doc_id long, text string")
    for docs, items in permutations((none, one)):
        assert dual_tree_search.search(docs, items).count() == 0
    assert [tuple(r) for r in dual_tree_search.search(one, one).collect()] == ranked([(1, "a")], [(1, "a")])


@pytest.mark.parametrize("kind", [np.float64, np.int64])
def test_descent_keeps_what_it_must_and_prunes(kind):
    rng = np.random.default_rng(8)
    topic = rng.integers(0, 12, 600)
    docs = (rng.random((600, 120)) < 0.03) * rng.integers(1, 50, (600, 120)) + (np.arange(120)[None, :] // 10 == topic[:, None]) * 400
    items = np.zeros((37, 120), int)
    for i in range(37):
        items[i, rng.choice(10, 5, replace=False) + 10 * int(rng.integers(0, 12))] = rng.integers(1, 9, 5)
    docs, items = docs.astype(kind), items.astype(kind)
    docs, items = docs[dual_tree_search.arranged(docs)], items[dual_tree_search.arranged(items)]
    scores = items @ docs.T
    kth = np.sort(scores, 1)[:, -20].astype(np.int64)
    i, d, s = dual_tree_search.surviving(dual_tree_search.hierarchy(items), dual_tree_search.hierarchy(docs), kth)
    assert set(zip(i, d)) == set(zip(*np.nonzero((scores >= kth[:, None]) & (scores > 0))))
    assert (s == scores[i, d]).all()
    below = [dual_tree_search.hierarchy(x)[1] for x in (items, docs)]
    assert ((below[0] @ below[1].T) < dual_tree_search._least(kth, 2)[1][:, None]).mean() > 0.5
