"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barlake.llm import (
    chat_format, decontaminate, jaccard_join, kneser_ney, license_scan, mix_sources, pii, toxicity, voronoi_knn, wrapper_induction,
)
from barlake.llm.components import components, stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(60000))
ROWS = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n ", "en", "a", 4), (4, "One two", "en", "b", 7),
    (4, "One two", "en", "b", 7), (None, "one two three four five six", "en", None, 27), (5, "one TWO three four five six", "en", "a", 27),
    (6, LONG, "en", "b", len(LONG)), (7, LONG + " more", "en", "b", len(LONG) + 5), (8, "one two", "de", "c", 7), (9, "été " * 9, "fr", "c", 36),
]
CLASHES = ("rid", "node", "n", "w", "h", "score", "size", "taken", "copies", "row", "body", "known", "base", "evidence", "licence")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).withColumns({c: F.lit("x") for c in CLASHES})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_components_of_chains_stars_and_nothing(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(201, 200), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_join(docs, nothing):
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard_join.link_documents(docs).collect())
    assert got == [
        (0, 2, 5), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (5, 2, 5), (6, 59996, 6), (7, 59997, 6), (8, 1, 4), (9, 1, 9),
    ]
    assert jaccard_join.link_documents(nothing).count() == 0


def test_jaccard_join_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    texts = []
    for g in range(12):
        base = [f"g{g}x{i}" for i in range(60)]
        for _ in range(8):
            own = list(base)
            for at in rng.integers(0, 60, rng.integers(0, 4)):
                own[at] = f"y{rng.integers(10**6)}"
            texts.append(own + ["shared", "tail", "of", "seven", "common", "words", "here"] * int(rng.integers(0, 2)))
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    least = list(range(len(texts)))
    for _ in texts:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if 100 * len(x & y) >= 75 * len(x | y):
                    least[i] = min(least[i], least[j])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for options in ({}, {"hot": 3, "bucket_tokens": 50}):
        got = {r.doc_id: r.component_id for r in jaccard_join.link_documents(docs, **options).collect()}
        assert got == dict(enumerate(least))


def test_kneser_ney(docs, nothing, spark):
    slim = docs.select("doc_id", "text")
    model = kneser_ney.train(slim, kneser_ney.model_folder(spark))
    got = kneser_ney.score(slim, model, "doc_id long").collect()
    assert len(got) == len(ROWS) and all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1}
    assert len({(r.score, r.n_known) for r in got if r.doc_id == 4}) == 1
    empty = kneser_ney.train(nothing, kneser_ney.model_folder(spark))
    assert {r.score for r in kneser_ney.score(slim, empty, "doc_id long").collect()} == {0.0}
    assert kneser_ney.score(nothing, empty, "doc_id long").count() == 0


def test_pii(docs, nothing):  # the long texts hold tens of thousands of numbers that are no cards
    assert all(r.spans == [] for r in pii.find_spans(docs).collect())
    assert pii.find_spans(nothing).count() == 0


def test_chat_format_round_trip(spark):
    rows = [
        (1, 0, "user", "a&b <s>[HEAD user][/HEAD]"), (1, 1, "user", None), (1, 2, None, "x"), (1, 2, None, "x"), (1, 3, "as]si&", "[AND]"),
        (1, 4, "assistant", "&lt;&amp;"), (None, None, "assistant", LONG), (None, 0, "assistant", ""),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"loss": F.lit(1), "formatted": F.lit(2)})
    chats = chat_format.format_conversations(table)
    back = chats.select("conv_id", chat_format.read_back(F.col("formatted")).alias("t"), chat_format.masked_texts(F.col("formatted"), F.col("loss")).alias("m"))
    got = {r.conv_id: r for r in back.collect()}
    assert [tuple(t) for t in got[1].t] == [(r or "", t or "") for c, _, r, t in rows[:6]]
    assert got[1].m == ["&lt;&amp;"] and got[None].m == [LONG, ""]
    assert chat_format.format_conversations(table.where("false")).count() == 0


def test_knn_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4).round(1)]) for i in range(300)]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(120)]
    odd = [(None, [1.0] * 4), (2000, None), (2050, [1.0, None, 1.0, 1.0]), (2100, [float("nan")] * 4), (2150, []), (2200, [1.0])]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumns({"cell": F.lit(1), "v": F.lit(2)})
    rows.append((2200, [1.0, 0.0, 0.0, 0.0]))  # a shorter vector goes on with zeros
    ids = np.array([i for i, _ in rows])
    x = np.floor(256 * np.array([v for _, v in rows], np.float32).astype(float))
    want = []
    for q in np.flatnonzero(ids % 50 == 0):
        found = sorted((-s, i) for s, i in zip((x @ x[q]).astype(int), ids) if i != ids[q])[:5]
        want += [(ids[q], r + 1, i, -s) for r, (s, i) in enumerate(found)]
    for options in ({}, {"pivots": 9, "block": 16}):
        got = voronoi_knn.top_k(table, F.col("vec_id") % 50 == 0, **options).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    few = voronoi_knn.top_k(table.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 50 == 0).collect()
    assert [r["rank"] for r in few] == [1, 2]
    assert voronoi_knn.top_k(table.where("false"), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("pivots", [8, 64])
def test_knn_of_negative_scores_with_ties(spark, pivots):
    """All scores lie far below zero and most are equal: the smaller ids must come from other cells too."""
    rng = np.random.default_rng(11)
    rows = [(50 * i, [100.0, float(rng.integers(0, 3))]) for i in range(80)]
    rows += [(50 * i + 1 + int(j), [-300.0, 0.0] if j % 2 else [-300.0 - 100 * float(rng.integers(0, 3)), float(rng.integers(-2, 1))]) for i in range(80) for j in range(5)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = F.col("vec_id") % 50 == 0
    far = [r for r in rows if r[0] % 50]
    got = {}
    for r in voronoi_knn.top_k(spark.createDataFrame(far + rows[:1], table.schema), asked, scale=1, pivots=pivots, block=32).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    best = sorted((-int(np.dot(v, rows[0][1])), i) for i, v in far)[:5]
    assert got == {0: [(i, -s) for s, i in best]} and best[0][0] > 1000
    got = sorted(map(tuple, voronoi_knn.top_k(table, asked, scale=1, pivots=pivots, block=32).collect()))
    want = []
    for q, v in rows[:80]:
        found = sorted((-int(np.dot(v, x)), i) for i, x in rows if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    assert got == sorted(want)


def test_pivots_keep_the_order_of_the_sample():
    x = np.array([[9.0, 1.0], [3.0, 2.0], [9.0, 1.0], [1.0, 5.0], [2.0, 2.0]])
    assert voronoi_knn._first_distinct(x, 3).tolist() == [[9, 1], [3, 2], [1, 5]]


def test_knn_of_repeated_queries(spark):
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [0.0, 1.0])]
    rows += [(i, [float(i), 0.0]) for i in range(1, 8)] + [(9, [6.5, 0.0])] * 2 + [(10, [0.0, 6.0]), (11, [7.0, 7.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, voronoi_knn.top_k(table, F.col("vec_id") % 50 == 0, scale=2, block=4).collect()))
    # A repeated query asks once, repeated candidates are two; two vectors of an id share one answer.
    want = [(7, 28), (11, 28), (9, 26), (9, 26), (6, 24)]
    assert got == [(q, r + 1, i, s) for q in (50, 100) for r, (i, s) in enumerate(want)]


def test_mixing(docs, nothing):
    got = mix_sources.mixed(docs)
    assert got.columns.count("size") == 1 and got.columns.count("taken") == 1
    rows = got.collect()
    assert len(rows) == len(ROWS) and all(r.taken in (0, r["size"], 2 * r["size"]) for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert mix_sources.mixed(nothing).count() == 0


def test_toxicity(docs, nothing, spark):
    labels = spark.createDataFrame([(None, 1, 1), (4, 1, None)], "doc_id long, quality int, toxic int")
    for table, size in ((docs, len(ROWS)), (nothing, 0)):
        got = toxicity.score(table, toxicity.train(table, labels), "doc_id").collect()
        assert len(got) == size and all(r.score == 0 and r.evidence == [] for r in got)


def test_toxicity_gives_the_text_back(docs, spark):
    labels = spark.createDataFrame([(4, 1, 1), (6, 1, 0), (7, 1, 0), (8, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    with_text = toxicity.score(docs, model, "doc_id", "rid", text_as="body").select("doc_id", "rid", "body", "score", "evidence")
    without = toxicity.score(docs.withColumn("body", F.col("text")), model, "doc_id", "rid", "body").select(with_text.columns)
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(with_text) == rows(without) and model["curve"] is not None


def test_toxicity_keeps_rare_words(spark):
    # A word is in a few texts of its kind only, and nothing else tells the texts apart.
    bad = [(i, f"some plain words {chr(97 + i % 20)}xq here") for i in range(200)]
    fine = [(1000 + i, f"some plain words {chr(97 + i % 20)}ok here") for i in range(200)]
    table = spark.createDataFrame(bad + fine, "doc_id long, text string")
    labels = table.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("toxic"))
    model = toxicity.train(table, labels, sample=60)
    held = {i: t for i, t in bad + fine if i in set(model["index"].ids.tolist())}
    assert all(w.encode() in model["chosen"] for t in held.values() for w in t.split())
    some = [(1, "axq plain"), (2, None), (3, "unknown vocabulary")]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(some, "doc_id long, text string"), model, "doc_id").collect()}
    assert len(got[1].evidence) == 16 and got[2].evidence == got[3].evidence == []
    near = {r.doc_id: r.evidence for r in toxicity.score(table, model, "doc_id").collect()}
    for i, text in list(held.items())[:20]:
        word = text.split()[3]
        same = [j for j, other in held.items() if word in other.split()]
        assert set(near[i][: len(same)]) == set(same)


def test_block_max_index_is_exact():
    rng = np.random.default_rng(7)
    vectors = []
    for _ in range(500):
        v = {int(t): float(w) for t, w in zip(rng.choice(30, 5, replace=False), rng.random(5).round(1) + 0.1)}
        norm = math.sqrt(sum(w * w for w in v.values()))
        vectors.append({t: w / norm for t, w in v.items()})
    index = toxicity.BlockMaxIndex(list(range(500)), [0] * 500, vectors, 30, block=16)
    for q in vectors[:60]:
        scores = [(-round(sum(w * v.get(t, 0) for t, w in q.items()), 9), i) for i, v in enumerate(vectors)]
        want = [i for s, i in sorted(scores) if s < 0][:16]
        near = index.nearest(q, 16)
        assert sorted(-round(s, 9) for s, _ in near) == sorted(scores[i][0] for i in want)
        assert {int(index.ids[at]) for s, at in near if -round(s, 9) < scores[want[-1]][0]} <= set(want)


def test_licence_scan(spark, nothing):
    files = spark.createDataFrame(
        [
            (1, "a/b/LICENSE", "The MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software"),
            (2, "a/b/c/d.py", None), (3, "a/x.py", "# Licensed under the Apache License, Version 2.0"), (4, None, "x"), (5, "a/bc/y", ""), (1, "a/b/e", "x"),
        ], "id int, path string, text string",
    ).withColumns({"score": F.lit(0), "dir": F.lit("q")})
    got = {(r.id, r.path): (r.own_licence, r.licence, r.inherited_from) for r in license_scan.scan(files.union(files)).collect()}
    assert got == {
        (1, "a/b/LICENSE"): ("MIT", "MIT", None), (2, "a/b/c/d.py"): (None, "MIT", "a/b"), (3, "a/x.py"): ("Apache-2.0", "Apache-2.0", None),
        (4, None): (None, None, None), (5, "a/bc/y"): (None, None, None), (1, "a/b/e"): (None, "MIT", "a/b"),
    }
    assert license_scan.scan(files.union(files)).count() == 12 and license_scan.scan(files.where("false")).count() == 0


def test_decontamination(docs, nothing, spark):
    items = [(1, "One, two!"), (2, "one two three four five six"), (None, "été été"), (3, None), (4, "..."), (5, LONG[:400]), (6, "one two")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"broadcast_windows": 0}):
        got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate.find_windows(docs, bench, **options).collect()}
        assert got[1] == got[2] == got[3] == (0, 0, [], False)
        assert got[4] == got[8] == (2, 2, ["1", "6"], True) and got[5] == (6, 6, ["1", "2", "6"], True)
        assert got[9] == (9, 9, [], True) and got[6][2] == ["5"] and not got[6][3]
    assert decontaminate.find_windows(docs, bench.where("false")).where("n_hit > 0").count() == 0
    assert decontaminate.find_windows(nothing, bench).count() == 0


def test_wrapper_induction(spark):
    page = "<html><body><ul class=menu><li>Home</ul><div id=top>Our site</div><div class=text>{}</div><div class='comments'>nice</div>{}</body>"
    pages = [
        (1, "http://h/1", page.format("<p>A &amp; b<br>c<p>d  e", "<div>Contact us</div>")), (2, "http://h/2", page.format("Other &#233;", "<div>Contact us</div>")),
        (3, "http://h/3", page.format("Third<table><tr><td>x<td>y</table>", "<div>Contact us</div>")), (4, None, None), (5, "", ""), (6, "http://x", "plain"),
        (7, "http://x", "<article><h1>T</h1><p>same<p>same<aside>no</aside></article><footer>f"), (7, "http://x", "<b>" * 5000 + "deep"),
        (8, "not a url [", "<p>" + "long " * 50000),
    ]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"text": F.lit("z"), "n_chars": F.lit(1)})
    got = sorted((r.page_id, r.text) for r in wrapper_induction.extract(table).collect())
    assert got[:3] == [(1, "A & b c\nd e"), (2, "Other é"), (3, "Third\nx\ny")]
    assert got[3:6] == [(4, ""), (5, ""), (6, "plain")] and got[6:8] == [(7, "T\nsame\nsame"), (7, "deep")]
    assert len(got[8][1]) == 249999
    assert wrapper_induction.extract(table.where("false")).count() == 0


def test_templates_are_counted_over_all_pages_of_a_host(spark):
    page = "<title>{}</title><body class=no-{}><div id=top>Our site</div><div class=text>Story {}</div>{}"
    shop, few = "<div class=shop>Open<br>all day</div>", "<div class=few>Only some have it</div>"
    pages = [(i, f"http://u:p@H:80/{i}", page.format(i, i, i, shop * (i % 4 != 0) + few * (i % 4 < 2))) for i in range(400)]
    pages += [(1000 + i, f"http://c/{i}", f"<title>{i}</title><div>copied</div>") for i in range(9)]  # copies make no template
    pages += [(2000 + i, f"http://t/{i}", f"<div>same</div><div>{i}</div>") for i in range(2)] + [(3000, "http://o/", "<div>alone</div>")]
    pages += [(4000 + i, f"//[::{i}]/", f"<div>same</div><div>{i}</div>") for i in range(2)]  # two hosts
    expected = {i: "\n".join([f"Story {i}"] + ["Only some have it"] * (i % 4 < 2)) for i in range(400)}
    expected |= {1000 + i: "copied" for i in range(9)} | {2000: "0", 2001: "1", 3000: "alone", 4000: "same\n0", 4001: "same\n1"}
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    for rows in (table.repartition(1), table.repartition(7), table.union(table)):
        got = wrapper_induction.extract(rows).collect()
        assert len(got) == rows.count() and {r.page_id: r.text for r in got} == expected
        assert len({(r.page_id, r.text) for r in got}) == len(expected)


def test_articles_keep_headings_with_ordinary_words():
    page = (
        "<div class=related><article>other</article></div><article><div class='article-header'><h1>T</h1></div>"
        "<h2 id='related-work'>Related</h2><section id='legal-framework'><p>law</section></article><article><p>second</article><div id=share>s</div>"
    )
    assert wrapper_induction.main_text(wrapper_induction.parse(page), set()) == "T\nRelated\nlaw\nsecond"


def test_near_duplicates_by_component(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, one), (1, two), (2, one + " more"), (3, two + " more"), (None, "x " + one.replace("a", "c")), (None, one.replace("a", "c"))]
    rows = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, rows, "").collect()]
    assert len(got) == 3 and {(1, one), (1, two)} < set(got) and [d for d, t in got if "c1" in t] == [None]


def test_pipeline(docs, nothing, spark, tmp_path):
    spark.createDataFrame([(4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing like it")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for table, left in ((docs, 7), (nothing, 0)):
        rows = table
        for name, stage in corpus_pipeline.STAGES[:-1]:
            rows = stored(stage(spark, rows, str(tmp_path)), name)
            assert rows.columns == table.columns
        assert rows.count() == left
        corpus_pipeline.mix(spark, rows, str(tmp_path)).collect()
