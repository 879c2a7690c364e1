"""The registered queries against SQL, or against plain Python where SQL cannot say them."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import corpus_pipeline
from barlake.llm import kneser_ney, mix_sources, pii
from barlake.llm.catalog import ORACLE, QUERIES
from oracle_compare import connect, difference

SF_DIR = "/root/testdata/sf0.01"


def table(name, columns="*"):
    return duckdb.sql(f"SELECT {columns} FROM '{SF_DIR}/{name}.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    assert difference(spark, connect(SF_DIR), QUERIES[name], ORACLE[name], SF_DIR) is None


def test_main_text_is_the_article(spark):
    import html

    got = {r.page_id: r for r in QUERIES["op1_wrapper_induction"](spark, SF_DIR).collect()}
    for key, url, page in table("pages"):
        body = page[page.index("<article>") : page.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1|article)>", body)]
        text = "\n".join(b for b in blocks if b)
        assert (got[key].url, got[key].text, got[key].n_chars) == (url, text, len(text))


def test_scores_are_those_of_the_model(spark):
    got = {r.doc_id: r for r in QUERIES["op2_kneser_ney_scoring"](spark, SF_DIR).collect()}
    words = {k: [*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None] for k, t in table("documents", "doc_id, text")}
    train = [w for k, w in words.items() if zlib.crc32(str(k).encode()) % 7 != 2]
    count = Counter(w for ws in train for w in ws)
    tokens, known = sum(count.values()), len(count)
    pair = Counter(p for ws in train for p in zip([None, *ws[:-1]], ws))
    left, total, kinds = Counter(w for _, w in pair), Counter(), defaultdict(lambda: [0, 0, 0])
    for (v, w), n in pair.items():
        total[v] += n
        kinds[v][min(n, 3) - 1] += 1
    upper, lower = (kneser_ney.discounts([sum(n == k for n in c.values()) for k in (1, 2, 3, 4)]) for c in (pair, left))
    rest = sum(lower[min(n, 3) - 1] for n in left.values()) / len(pair) / (known + 1)

    def cut(n, d):
        return max(n - d[min(n, 3) - 1], 0) if n else 0

    def p(v, w):
        low = cut(left[w], lower) / len(pair) + rest
        if not total[v]:
            return low
        return cut(pair[v, w], upper) / total[v] + sum(a * b for a, b in zip(upper, kinds[v])) / total[v] * low

    assert math.isclose(sum(p(None, w) for w in count) + p(None, b"never seen"), 1)
    for k, ws in words.items():
        r = got[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(count[w] > 0 for w in ws), tokens)
        assert r.held_out == (zlib.crc32(str(k).encode()) % 7 == 2)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (tokens + known + 1)) for w in ws), rel_tol=1e-9)
        assert math.isclose(r.score, sum(math.log10(p(v, w)) for v, w in zip([None, *ws[:-1]], ws)), rel_tol=1e-9)


# The patterns of the contract.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def good(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(x) <= 255 for x in value.split("."))
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def test_base_spans_match_the_patterns(spark):
    got = {r.doc_id: r for r in QUERIES["op3_weakly_supervised_pii"](spark, SF_DIR).collect()}
    for k, text in table("documents", "doc_id, text"):
        spans = base_spans(text)
        assert got[k].base_sha256 == hashlib.sha256(",".join("%s:%d:%d" % s for s in spans).encode()).hexdigest()
        assert [got[k][f"n_{kind}"] for kind in PATTERNS] == [sum(s[0] == kind for s in spans) for kind in PATTERNS]
        assert {"%s:%d:%d" % s for s in spans} <= set(got[k].spans.split(","))


def test_odd_texts_have_the_same_base_spans(spark):
    texts = [
        "a@b.com_d@e.fr", "x 1.2.3.4.5.6.7.8 999.1.1.1 +1 (555) 123-4567", "4111 1111 1111 1111 4111-1111-1111-1112",
        "a@b a@b.c a.b@c.d.e@f.g", "1 1 1 1 " * 20000, "+1" * 500, "a@" + "b." * 20000 + "c", "Ωé " * 5 + "me@x.org", None, "",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' AS base", "'y' AS spans")
    for r in pii.find_spans(docs).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == base_spans(texts[r.doc_id])


def test_loose_spans_are_added_and_redacted(spark):
    text = "write: joe [at] mail [dot] org or call (555) 123-4567."
    docs = spark.createDataFrame([(1, text), (2, "call me: +1 (555) 123-4567, mail a@b.org")], "doc_id long, text string")
    found = pii.find_spans(docs)
    got = {r.doc_id: r for r in found.select("doc_id", "spans", pii.redacted(found.text, found.spans).alias("clean")).collect()}
    assert got[1].clean == "write: [EMAIL] or call [PHONE]."
    assert got[2].clean == "call me: [PHONE], mail [EMAIL]"


def test_mix_meets_its_targets(spark):
    rows = {k: (s, len((t or "").encode().split())) for k, t, s in table("documents", "doc_id, text, source")}
    got = QUERIES["op7_pareto_mixing"](spark, SF_DIR).collect()
    words, taken, target = Counter(), Counter(), {}
    for r in got:
        source, size = rows[r.doc_id]
        assert r["size"] == size and r.taken in (0, size, 2 * size)
        words[source] += size
        taken[source] += r.taken
        target[source] = r.target
    assert len(got) == len(rows)
    assert target == pytest.approx(mix_sources.targets(list(words.items())))
    assert sum(target.values()) == pytest.approx(1.5 * sum(words.values()))
    assert all(abs(taken[s] - target[s]) <= 0.01 * words[s] + 20 for s in words)
    again = QUERIES["op7_pareto_mixing"](spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_targets_fill_up_to_the_cap():
    assert mix_sources.targets([("b", 100), ("a", 100), (None, 100)], (5, 2, 1)) == {"a": 200.0, "b": pytest.approx(500 / 3), None: pytest.approx(250 / 3)}
    assert mix_sources.targets([]) == {} and mix_sources.targets([("a", 0)]) == {"a": 0.0}


def test_toxicity_on_held_out_labels(spark):
    got = {r.doc_id: r for r in QUERIES["op8_toxicity_nearest_examples"](spark, "/root/testdata/sf0.1").collect()}
    labels = duckdb.sql("SELECT doc_id, toxic FROM '/root/testdata/sf0.1/labels.parquet'").fetchall()
    held = [(y, got[k].predicted) for k, y in labels if got[k].held_out]
    right = sum(y and p for y, p in held)
    assert right / sum(y for y, _ in held) > 0.8 and right / sum(p for _, p in held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())


def test_licences_and_inheritance(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_license_scan"](spark, SF_DIR).collect()}
    said = {
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "MIT": "Released under the MIT License.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "Proprietary": "All rights reserved.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    }
    own, places = {}, {}
    for k, text in table("documents", "doc_id, text"):
        lines = (text or "").split("\n")
        own[k] = sorted(n for n, line in said.items() if line in lines)
        if own[k] and rows[k].path.endswith("/LICENSE"):
            places.setdefault(rows[k].path.rpartition("/")[0], []).append(own[k][0])
    for k, r in rows.items():
        assert (r.own_licences or "").split(",") == (own[k] or [""])
        above = [p for p in places if r.path.startswith(p + "/")]
        if not own[k]:
            assert r.inherited_from == (max(above, key=len) if above else None)
            assert (r.licence is not None) == bool(above)


def test_pipeline_stages_do_their_work(spark):
    before = {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    after = corpus_pipeline.run(spark, SF_DIR).collect()
    kept = {r.doc_id for r in after}
    links = defaultdict(set)
    for r in QUERIES["op6_ngram_jaccard_join"](spark, SF_DIR).collect():
        links[r.component_id].add(r.doc_id)
    hit = {r.doc_id for r in QUERIES["op10_decontaminate"](spark, SF_DIR).collect() if r.contaminated}
    toxic = {r.doc_id for r in QUERIES["op8_toxicity_nearest_examples"](spark, SF_DIR).collect() if r.predicted}
    assert len(kept) == len(after) and not kept & hit and not kept & toxic
    assert all(len(kept & group) <= 1 for group in links.values())
    for r in after:
        clean = before[r.doc_id].text
        for _, start, end in sorted(base_spans(clean), key=lambda s: -s[1]):
            assert before[r.doc_id].text[start:end] not in r.text
        assert r.n_chars == len(r.text) and r.taken in (r["size"], 2 * r["size"])
    # Nothing but rejected, repeated and unsampled documents is missing.
    wanted = {min(g - toxic) for g in links.values() if g - toxic} - hit
    assert kept <= wanted and len(kept) > 0.85 * len(wanted)
