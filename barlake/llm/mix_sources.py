"""Mix sources to target weights by Pareto order sampling.

Targets: sources in order of code point, a null source last, weigh ``weights`` in turn and
share ``epochs`` times all words.  A target stops at ``cap`` times its source's words; the
excess is shared again by weight until none is above (water filling).

Certain copies come first: each source is taken whole as often as its target allows.  The rest
of the target, as a share f of the source's words, is a sample without repeats.  A document of
s words is included with p = min(1, c * s ** favour): longer documents are likelier, and c is
such that the expected words, the sum of p * s over the source, are f times the source's.
Documents with p = 1 are certain and taken; the others are ranked by their random odds
u / (1 - u) divided by their inclusion odds p / (1 - p), and those of least rank are taken
until the sample's fixed size, in words, is reached.  u is a hash of id and text: reruns
agree.  ``favour=0`` makes all odds of a source equal.

One border document may be larger than all the rest of a small target, so the draw is
stratified: size classes are drawn one after another, the largest first, and what the whole
documents of a class leave open or take too much is carried to the next.  A source ends within
half a document of the smallest class it has enough of.

A class is never sorted as a whole.  Its words are summed in ``bins`` of the rank r, taken as
r / (1 + r); running sums over the bins find the one in which the sample ends, and only that
bin's documents are ranked one by one.

Null and empty texts have size 0 and take nothing; a null source is a source of its own;
rows that repeat id and text are taken together; extra columns of any name are kept, but for
those named like the added ones, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.llm.components import stored

WEIGHTS = (5, 2, 1)
CLASSES = (4096, 1024, 256, 64, 16)
ADDED = ("size", "source_size", "target", "copies", "taken")


def size_of(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, epochs: float = 1.5, cap: float = 2.0):
    """Source -> words wanted, from every source's words."""
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    open_, left, out = dict(order), epochs * sum(n for _, n in order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s, n in open_.items() if unit * weight[s] > cap * n]
        if not full:
            return out | {s: unit * weight[s] for s in open_}
        for s in full:
            out[s] = cap * open_.pop(s)
            left -= out[s]
    return out


def odds_scale(sizes: DataFrame, wanted: DataFrame, favour: float) -> DataFrame:
    """(source, scale): c such that min(1, c * size ** favour) gives the wanted words of each source.

    ``sizes`` holds (source, size, words), the words of all documents of a size; ``wanted`` holds
    (s, open), the words to sample of a source.  If the largest sizes are certain, the others share what
    these leave; the first size that is not certain then says what c is.  A source has as many
    sizes as its documents have different lengths, so a window over them is small.
    """
    down = Window.partitionBy("source").orderBy(F.desc("size"))
    above = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weighted").over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = sizes.join(F.broadcast(wanted), F.col("source").eqNullSafe(F.col("s")))
    rows = rows.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(float(favour))))
    rows = rows.withColumn("weighted", F.col("weight") * F.col("words"))
    rows = rows.withColumn("scale", (F.col("open") - above) / rest)
    fits = F.col("scale") * F.col("weight") <= 1
    return rows.groupBy("source").agg(F.max_by("scale", F.when(fits, F.col("size"))).alias("scale"))


def mixed(
    docs: DataFrame,
    weights=WEIGHTS,
    epochs: float = 1.5,
    cap: float = 2.0,
    classes=CLASSES,
    bins: int = 4096,
    favour: float = 0.25,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies (times taken) and taken (words).

    One row per source passes through the driver: a mixture has as many sources as someone
    has weighed.  Everything per document stays in Spark.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    # The given columns wait in a struct, so none of them can clash with those below.
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"),
        "source",
        size_of(F.col("text")).alias("size"),
        _uniform().alias("u"),
    )
    slim = stored(rows.select("source", "size", "u"), "sizes")
    by_size = stored(slim.groupBy("source", "size").agg(F.sum("size").alias("words")), "by-size")
    sizes = [(r["source"], r["w"]) for r in by_size.groupBy("source").agg(F.sum("words").alias("w")).collect()]
    wanted = targets(sizes, weights, epochs, cap)
    whole = {s: int(wanted[s] // n) if n else 0 for s, n in sizes}
    open_ = [(s, float(wanted[s] - whole[s] * n)) for s, n in sizes if n and wanted[s] > whole[s] * n]
    scales = odds_scale(by_size.where("size > 0"), spark.createDataFrame(open_, "s string, open double"), favour)
    scale = {r["source"]: r["scale"] for r in scales.collect()}
    plan = spark.createDataFrame(
        [(s, n, float(wanted[s]), whole[s], scale.get(s)) for s, n in sizes],
        "plan_source string, source_size long, target double, whole int, scale double",
    )

    def ranked(table: DataFrame) -> DataFrame:
        """With what the plan says of the source, the class, p, and the rank's place in 0 to 1."""
        table = table.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("plan_source")))
        p = F.least(F.lit(1.0), F.col("scale") * F.pow(F.col("size").cast("double"), F.lit(float(favour))))
        p = F.when(F.col("scale").isNotNull() & (F.col("size") > 0), p).otherwise(0.0)
        cls = F.lit(0)
        for i, least in enumerate(classes):
            cls = F.when(F.col("size") < least, i + 1).otherwise(cls)
        table = table.withColumns({"class": cls, "p": p})
        # r / (1 + r) of the rank r = u / (1 - u) / (p / (1 - p)).
        against, chosen = F.col("u") * (1 - F.col("p")), F.col("p") * (1 - F.col("u"))
        table = table.withColumn("place", F.when((F.col("p") > 0) & (F.col("p") < 1), against / (against + chosen)))
        return table.withColumn("bin", F.least(F.floor(F.col("place") * bins), F.lit(bins - 1)).cast("int"))

    drawn = stored(ranked(slim).where("place IS NOT NULL").select("source", "class", "size", "p", "place", "bin"), "ranked")
    # Expected words are summed as decimals: the sums, and so reruns, agree whatever the order of addition.
    expected = F.sum((F.col("p") * F.col("size")).cast("decimal(28,6)")).alias("expected")
    binned = stored(drawn.groupBy("source", "class", "bin").agg(F.sum("size").alias("words"), expected), "bins")
    carry, cuts = {s: 0.0 for s in scale}, []
    for k in range(len(classes) + 1):
        state = spark.createDataFrame(list(carry.items()), "s string, carry double")
        for r in _ends(drawn.where(F.col("class") == k), binned.where(F.col("class") == k), bins, state).collect():
            carry[r["source"]] = r["open"] - r["words"]
            cuts.append((r["source"], k, r["bin"], r["cut"]))
    ends = spark.createDataFrame(cuts, "end_source string, end_class int, end_bin int, cut double")
    # Both tables hold a row per source (and class), as collected above: small enough to broadcast.
    out = ranked(rows).join(
        F.broadcast(ends), F.col("source").eqNullSafe(F.col("end_source")) & (F.col("class") == F.col("end_class")), "left"
    )
    before = (F.col("bin") < F.col("end_bin")) | ((F.col("bin") == F.col("end_bin")) & (F.col("place") <= F.col("cut")))
    sampled = (F.col("p") >= 1) | F.coalesce(before, F.lit(False))
    copies = F.when(F.col("size") > 0, F.col("whole") + sampled.cast("int")).otherwise(0)
    given = [F.col(f"doc.`{c}`").alias(c) for c in kept]
    return out.select(*given, "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def _uniform() -> Column:
    """A number in (0, 1) that depends on id and text only."""
    return (F.pmod(F.xxhash64(F.lit(17), "doc_id", "text"), F.lit(1 << 48)) + 0.5) / float(1 << 48)


def _ends(drawn: DataFrame, binned: DataFrame, bins: int, state: DataFrame) -> DataFrame:
    """(source, open, words, bin, cut): where each source's sample ends in a class.

    The sample is the bins before ``bin`` and, of that one, the places up to ``cut`` (none
    if null); ``open`` words were wanted, ``words`` are in it.
    """
    table = binned.join(F.broadcast(state), F.col("source").eqNullSafe(F.col("s")))
    over = Window.partitionBy("source")
    running = over.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = table.withColumn("open", F.sum("expected").over(over).cast("double") + F.col("carry"))
    table = table.withColumns({"upto": F.sum("words").over(running), "share": F.greatest(F.col("open"), F.lit(0.0))})
    ends = table.groupBy("source", "open", "share").agg(
        F.coalesce(F.min(F.when(F.col("upto") > F.col("share"), F.col("bin"))), F.lit(bins)).alias("bin"),
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("share"), F.col("upto"))), F.lit(0)).alias("before"),
    )
    border = drawn.select("source", "size", "place", F.col("bin").alias("own")).join(
        F.broadcast(ends.select(F.col("source").alias("s"), "share", "before", "bin")),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("own") == F.col("bin")),
    )
    by_rank = Window.partitionBy("s").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    nearer = F.col("before") + F.col("upto") - F.col("size") / 2 <= F.col("share")
    last = border.withColumn("upto", F.sum("size").over(by_rank)).where(nearer).groupBy("s").agg(
        F.max("place").alias("cut"), F.max("upto").alias("more")
    )
    return ends.join(last, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "open", (F.col("before") + F.coalesce("more", F.lit(0))).alias("words"), "bin", "cut"
    )


def op7_pareto_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")
