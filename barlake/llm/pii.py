"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates are the strict spans (e-mail addresses, IPv4 addresses, payment cards, phone
numbers in international form), which always stay, and loose ones: spelled-out addresses
(``name [at] host [dot] org``), IPv6 addresses, 15-digit cards and national phone numbers.
Five labelers vote yes, no or nothing on each candidate: shape, checksum or range, gazetteer
(known domain endings; reserved addresses), the words before it, and the characters around.

How often each combination of votes occurs is counted over the whole corpus; that table has
at most 4 kinds * 3**5 rows, whatever the corpus.  Expectation-maximisation on it estimates
each labeler's reliability without labels, and a logistic classifier is trained on the
resulting probabilities.  It decides about the loose candidates.

Everything that touches a text is a built-in expression.  Null and empty texts have no
spans; repeated rows get the same spans; extra columns are kept, but for base, spans, near and
loose, which are replaced; offsets are code points,
the end exclusive.  Quantifiers are possessive where nothing could be given back, so a very
long text costs linear time and no deep recursion.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")

STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]++ ?[\[({]at[\])}] ?[A-Z0-9-]++(?: ?(?:[\[({]dot[\])}]|\.) ?[A-Z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9-])3[47][0-9]{2}([\x20-]?)[0-9]{6}\1[0-9]{5}(?![0-9-])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)[\x20-]?|[0-9]{3}[.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
# A text without this holds no candidate of the kind.
NEEDS = {"email": r"@|[aA][tT][\])}]", "ip": r"[0-9]\.[0-9]|:[0-9A-Fa-f]{1,4}:", "card": "[0-9]", "phone": r"\+[0-9]|[0-9][.\x20-][0-9]{4}"}

# Endings of common domains, words that announce personal data, words that announce other numbers.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu", "us", "ca", "au", "jp", "in", "br", "nl")
ANNOUNCE = r"(?i)(?:mail|contact|write|reach|phone|tel|call|fax|mobile|card|visa|credit|address|host|server|login|ip)\W{0,3}\S{0,12}\W{0,3}$"
OTHER = r"(?i)(?:version|release|isbn|issn|order|invoice|page|section|chapter|ref|no|nr|id|time|date)\W{0,3}$"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
RESERVED = r"^(?:0|10|127|169\.254|192\.168|192\.0\.2|198\.51\.100|203\.0\.113|255)\."

SPAN = "struct<kind:string,start:int,end:int,value:string,base:boolean>"
LABELERS = ("shape", "checksum", "gazetteer", "context", "edges")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    each = F.transform(
        F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)),
        lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
            x.cast("int") * 2 - F.when(x.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))
        ),
    )
    return F.aggregate(each, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    size = F.length(_digits(value))
    if kind == "card":
        return size.between(16, 19) & F.when(size.between(16, 19), luhn(_digits(value))).otherwise(F.lit(False))
    return size.between(8, 15)


def _matches(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Spans of a pattern's good matches, from the lengths of what lies between matches.

    A strict match that fails its check is passed over at once, so a text full of numbers
    costs linear time; the spans kept are copied for each further one.
    """
    value, gap = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.zip_with(value, F.slice(gap, F.lit(1), F.size(value)), lambda v, g: F.struct(v.alias("v"), F.length(g).alias("g")))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc, x):
        start = acc["at"] + x["g"]
        end = start + F.length(x["v"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["v"].alias("value"), F.lit(base).alias("base"))
        longer = F.concat(acc["out"], F.array(span))
        kept = F.when(_valid(kind, x["v"]), longer).otherwise(acc["out"]) if base else longer
        return F.struct(end.alias("at"), kept.alias("out"))

    return F.aggregate(pairs, empty, step, lambda acc: acc["out"])


def _overlap(a, b):
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def with_candidates(docs: DataFrame) -> DataFrame:
    """Adds ``base`` and ``loose``: spans by kind as listed, then start."""
    none = F.array().cast(f"array<{SPAN}>")
    text = F.coalesce(F.col("text"), F.lit(""))
    some = {k: text.rlike(NEEDS[k]) for k in KINDS}

    def found(patterns, base):
        return F.concat(*[F.when(some[k], _matches(text, k, patterns[k], base)).otherwise(none) for k in KINDS])

    rows = docs.withColumn("base", found(STRICT, True)).withColumn("near", found(LOOSE, False))
    loose = F.filter("near", lambda s: ~F.exists("base", lambda b: _overlap(s, b)))
    return rows.withColumn("loose", F.when(F.size("near") > 0, loose).otherwise(none)).drop("near")


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(text: Column, span: Column) -> Column:
    """The labelers' votes on a span: 1, -1 or 0 in the order of LABELERS."""
    value, kind = span["value"], span["kind"]
    start = F.greatest(span["start"] - 40, F.lit(0))
    before = F.substring(text, start + 1, span["start"] - start)
    around = F.concat(F.substring(before, -1, 1), F.lit("|"), F.substring(text, span["end"] + 1, F.lit(1)))
    digits = _digits(value)
    ending = F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1))
    checked = F.when(kind == "card", _vote(luhn(digits), F.lit(True)))
    checked = checked.when(kind == "ip", _vote(value.contains(":") | value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), F.lit(True)))
    known = F.when(kind == "email", _vote(ending.isin(*ENDINGS), F.length(ending) < 2))
    known = known.when(kind == "ip", _vote(F.lit(False), value.rlike(RESERVED)))
    known = known.when(kind == "card", _vote(digits.rlike("^(?:4|5[1-5]|3[47]|6)"), F.lit(True)))
    known = known.when(kind == "phone", _vote(digits.rlike("^(?:1|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9)"), digits.rlike("^0{3}")))
    return F.array(
        _vote(span["base"], F.lit(False)),
        checked.otherwise(0),
        known.otherwise(0),
        _vote(before.rlike(ANNOUNCE), before.rlike(OTHER)),
        _vote(around.rlike(r"^[\s\"'(<,;:]?\|[\s\"')>,;:.!?]?$"), around.rlike(r"[A-Za-z0-9]\||\|[A-Za-z0-9]")),
    )


def reliabilities(table: list[tuple[str, tuple[int, ...], int]], rounds: int = 60):
    """EM on (kind, votes, count): probability per row that the candidate is personal data."""
    width = len(LABELERS)
    odds = [1 / (1 + math.exp(-sum(v))) for _, v, _ in table]
    for _ in range(rounds):
        mass = [sum(c * p for (_, _, c), p in zip(table, odds)), sum(c * (1 - p) for (_, _, c), p in zip(table, odds))]
        share = [[[1.0] * 3 for _ in range(width)] for _ in (0, 1)]
        for (_, v, c), p in zip(table, odds):
            for j in range(width):
                share[0][j][v[j]] += c * p
                share[1][j][v[j]] += c * (1 - p)
        # A labeler that says yes is right more often than not: keeps the two classes from swapping.
        for j in range(width):
            rates = [[x / (m + 3) for x in row[j]] for row, m in zip(share, mass)]
            if rates[0][1] < rates[1][1]:
                rates[0][1] = rates[1][1] = (rates[0][1] + rates[1][1]) / 2
            share[0][j], share[1][j] = rates
        prior = (mass[0] + 1) / (sum(mass) + 2)
        for i, (_, v, _) in enumerate(table):
            logit = math.log(prior / (1 - prior)) + sum(math.log(share[0][j][v[j]] / share[1][j][v[j]]) for j in range(width))
            odds[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
    return odds


def train_classifier(table, odds, rounds: int = 400, rate: float = 0.5, decay: float = 1e-3) -> list[float]:
    """Logistic weights: the constant, then one per (kind) and per (labeler, yes or no)."""
    rows = [(_features(k, v), c, p) for (k, v, c), p in zip(table, odds)]
    total, weights = sum(c for _, c, _ in rows) or 1, [0.0] * (1 + len(KINDS) + 2 * len(LABELERS))
    for _ in range(rounds):
        slope = [decay * w for w in weights]
        for x, c, p in rows:
            miss = (1 / (1 + math.exp(-sum(weights[i] for i in x))) - p) * c / total
            for i in x:
                slope[i] += miss
        weights = [w - rate * s for w, s in zip(weights, slope)]
    return weights


def _features(kind: str, vote: tuple[int, ...]) -> list[int]:
    first = 1 + len(KINDS)
    return [0, 1 + KINDS.index(kind)] + [first + 2 * j + (v < 0) for j, v in enumerate(vote) if v]


def train(docs: DataFrame) -> list[float]:
    """Weights from the votes on all candidates of the corpus."""
    spans = with_candidates(docs.select("text")).where((F.size("base") > 0) | (F.size("loose") > 0))
    each = F.transform(F.concat("base", "loose"), lambda s: F.struct(s["kind"].alias("kind"), votes(F.col("text"), s).alias("votes")))
    counted = spans.select(F.explode(each).alias("x")).groupBy("x.kind", "x.votes").count().collect()
    table = sorted((r["kind"], tuple(r["votes"]), r["count"]) for r in counted)
    return train_classifier(table, reliabilities(table))


def _score(text: Column, span: Column, weights: list[float]) -> Column:
    first, cast = votes(text, span), weights[1 + len(KINDS) :]
    total = F.lit(weights[0])
    for i, k in enumerate(KINDS):
        total += F.when(span["kind"] == k, weights[1 + i]).otherwise(0.0)
    for j in range(len(LABELERS)):
        total += F.when(F.get(first, F.lit(j)) > 0, cast[2 * j]).when(F.get(first, F.lit(j)) < 0, cast[2 * j + 1]).otherwise(0.0)
    return total


def find_spans(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """Adds ``base`` (strict spans) and ``spans`` (those and the accepted loose ones)."""
    weights = train(docs) if weights is None else weights
    rows = with_candidates(docs)
    good = F.filter("loose", lambda s: _score(F.col("text"), s, weights) > 0)
    everything = F.array_sort(F.concat("base", good), _by_kind)
    return rows.withColumn("spans", F.when(F.size("loose") > 0, everything).otherwise(F.col("base"))).drop("loose")


def _by_kind(a, b):
    rank = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]) * F.lit(2**40) + s["start"].cast("long") * 2 + 1 - s["base"].cast("int")
    return F.signum(rank(a) - rank(b)).cast("int")


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        fresh = F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when((s["start"] >= acc["at"]), F.concat(acc["out"], fresh)).otherwise(acc["out"]).alias("out"),
        )

    whole = F.aggregate(order, first, step, lambda acc: F.concat(F.concat_ws("", acc["out"]), F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def op3_weakly_supervised_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_spans(docs)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *map(count, KINDS), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )
