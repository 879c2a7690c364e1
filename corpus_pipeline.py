"""Corpus pipeline: every stage reads what the one before it kept.

toxicity (rejected documents go), near duplicates (one document of each group stays),
benchmark decontamination (contaminated documents go), personal data (replaced by its kind),
mixing (documents with the words the mix takes of them).

Documents are told apart by the hash of id and text, so repeated ids and null ids do no harm;
rows that repeat both are one document to the near-duplicate stage.  Null and empty texts
pass the filters, and the mix takes nothing of them.  Stages but the last return the
columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barlake.llm import decontaminate, jaccard_join, mix_sources, pii, toxicity
from barlake.llm.components import stored
from barlake.sources.scratch import scratch_path

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = docs.select("text", *[F.col(c).alias(f"kept_{c}") for c in docs.columns if c != "text"])
    scored = toxicity.score(held, model, *held.columns[1:], text_as="kept_text").where(F.col("score") < TOXIC_FROM)
    return scored.select(*[F.col(f"kept_{c}").alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near copies, and all without words."""
    linked = jaccard_join.link_documents(docs).where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "rid"))
    kept = stored(linked.groupBy("component").agg(first.alias("f")).select(F.col("f.rid").alias("_kept")), "kept")
    worded = F.coalesce(F.length(F.btrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))) > 0, F.lit(False))
    rows = docs.withColumn("_rid", F.xxhash64("doc_id", "text"))
    chosen = rows.where(worded).join(kept, F.col("_rid") == F.col("_kept"), "left_semi").dropDuplicates(["_rid"])
    return chosen.select(*docs.columns).unionByName(docs.where(~worded))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is benchmark text."""
    found = decontaminate.find_windows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = stored(found.where("contaminated").select(F.col("rid").alias("_bad")).distinct(), "contaminated")
    rows = docs.withColumn("_rid", F.xxhash64("doc_id", "text"))
    return rows.join(bad, F.col("_rid") == F.col("_bad"), "left_anti").select(*docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, n_chars counted again."""
    text = pii.redacted(F.col("text"), F.col("spans"))
    rows = pii.find_spans(docs.select("text", *[F.col(c).alias(f"kept_{c}") for c in docs.columns if c != "text"]))
    rows = rows.select(text.alias("text"), *[F.col(f"kept_{c}").alias(c) for c in docs.columns if c != "text"])
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    return rows.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, with copies and words taken."""
    return mix_sources.mixed(docs).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("mixing", mix),
]

# The first stage's scores come from a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
