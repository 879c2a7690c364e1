"""Licences of files: sparse TF-IDF cosine to templates, then nearest-ancestor inheritance.

A licence file (named LICENSE, COPYING, ...) is compared whole; of every file each line that
speaks of licences or rights is compared too, wherever in the text it stands.  Vectors are
sparse rows (unit, term, weight) with weight tf * idf; idf is taken over the templates, and a
term that no template has gets the greatest idf, so foreign words lower the cosine.  A unit
has the licence of its best template if the cosine reaches ``least``.

A directory has the licence of its licence files (the best match, ties by name).  A file
without a licence of its own inherits from the nearest directory above it that has one:
directories are joined with all their prefixes, then files with their directory.  Prefixes
are taken of distinct directories only, so a directory with most of the files is one row there.

All joins and sums are DataFrame operations.  What is broadcast is the table of templates.
Null texts and paths: a file without text has no licence of its own; a file without a path
lies in the root; repeated rows get equal results; extra columns are kept, but for those named
like the added ones, which are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.llm.components import stored

# How licences are named in headers and licence files.
TEMPLATES = {
    "Apache-2.0": ("licensed under the apache license, version 2.0", "you may not use this file except in compliance with the license", "apache license version 2.0"),
    "MIT": ("released under the mit license", "the mit license", "permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "GPL-3.0": ("this work is licensed under the gnu general public license, version 3", "gnu general public license version 3"),
    "GPL-2.0": ("this work is licensed under the gnu general public license, version 2", "gnu general public license version 2"),
    "LGPL-3.0": ("licensed under the gnu lesser general public license, version 3",),
    "AGPL-3.0": ("licensed under the gnu affero general public license, version 3",),
    "BSD-3-Clause": ("licensed under the bsd 3-clause license", "redistribution and use in source and binary forms, with or without modification, are permitted"),
    "MPL-2.0": ("this source code form is subject to the terms of the mozilla public license, v. 2.0",),
    "CC-BY-4.0": ("licensed under cc by 4.0", "licensed under the creative commons attribution 4.0 international license"),
    "CC-BY-SA-4.0": ("licensed under cc by-sa 4.0", "licensed under the creative commons attribution-sharealike 4.0 international license"),
    "CC-BY-NC-4.0": ("licensed under cc by-nc 4.0", "licensed under the creative commons attribution-noncommercial 4.0 international license"),
    "CC0-1.0": ("dedicated to the public domain under cc0 1.0", "cc0 1.0 universal public domain dedication"),
    "Unlicense": ("this is free and unencumbered software released into the public domain",),
    "Proprietary": ("all rights reserved", "copyright all rights reserved"),
}
SPEAKS = r"(?i)licen[cs]e|copyright|all rights reserved|spdx|public domain|creative commons|free of charge|redistribution|mozilla public|\bcc0\b|\bcc by"
LICENCE_FILE = r"(?i)^(?:licen[cs]e|copying|unlicense|notice)(?:[._-].*)?$"
ADDED = ("own_licence", "score", "own_licences", "licence", "inherited_from")
TOKEN_BREAK = r"[^a-z0-9.]+|\.(?![0-9])|(?<![0-9])\."


def terms(text: Column) -> Column:
    """Lower-case words and numbers; a version such as 2.0 is one term."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


def template_weights(spark) -> tuple[DataFrame, DataFrame, float]:
    """(licence, template, term, weight of unit length), (term, idf) and the idf of unknown terms."""
    rows = [(name, f"{name}#{i}", text) for name, texts in TEMPLATES.items() for i, text in enumerate(texts)]
    table = spark.createDataFrame(rows, "licence string, template string, body string")
    split = table.select("licence", "template", F.explode(terms(F.col("body"))).alias("term")).groupBy("licence", "template", "term").agg(F.count("*").alias("tf"))
    idf = split.groupBy("term").agg((F.log(F.lit(float(len(rows) + 1)) / (F.count("*") + 1)) + 1).alias("idf"))
    weighed = split.join(idf, "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("template")))
    return weighed.select("licence", "template", "term", (F.col("w") / norm).alias("weight")), idf, math.log(len(rows) + 1) + 1


def _units(files: DataFrame) -> DataFrame:
    """(rid, unit) of what is compared: licence files whole, and the speaking lines of every file."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(SPEAKS))
    unit = F.when(F.col("is_licence"), F.array_union(F.array("text"), lines)).otherwise(lines)
    speaking = files.where(F.col("text").rlike(SPEAKS))
    return speaking.select("rid", F.explode(unit).alias("unit")).distinct()


def own_licences(files: DataFrame, least: float = 0.6) -> DataFrame:
    """(rid, licence, score, all): the best licence of each file that has one, and all of them."""
    spark = files.sparkSession
    weights, idf, unknown = template_weights(spark)
    counted = (
        stored(_units(files), "units").select("rid", F.xxhash64("unit").alias("u"), F.explode(terms(F.col("unit"))).alias("term"))
        .groupBy("rid", "u", "term").agg(F.count("*").alias("tf"))
    )
    weighed = counted.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(unknown)))
    norms = weighed.groupBy("rid", "u").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = weighed.join(F.broadcast(weights), "term").groupBy("rid", "u", "licence", "template").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = dots.join(norms, ["rid", "u"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).where(F.col("score") >= least)
    per_unit = scored.groupBy("rid", "u").agg(F.min(F.struct((-F.col("score")).alias("s"), "licence")).alias("b"))
    return per_unit.groupBy("rid").agg(
        F.min("b").alias("b"), F.array_sort(F.collect_set("b.licence")).alias("all")
    ).select("rid", F.col("b.licence").alias("licence"), (-F.col("b.s")).alias("score"), "all")


def scan(files: DataFrame, least: float = 0.6) -> DataFrame:
    """``files`` (path, text, and what else) with own_licence, score, own_licences, licence and inherited_from."""
    path = F.coalesce(F.col("path"), F.lit(""))
    name = F.substring_index(path, "/", -1)
    place = F.when(F.instr(path, "/") > 0, F.expr("substring(coalesce(path, ''), 1, length(coalesce(path, '')) - length(substring_index(coalesce(path, ''), '/', -1)) - 1)")).otherwise("")
    keyed = files.withColumns({"_rid": F.xxhash64("path", "text"), "_dir": place, "_licence_file": name.rlike(LICENCE_FILE)})
    own = own_licences(keyed.select(F.col("_rid").alias("rid"), "text", F.col("_licence_file").alias("is_licence")), least)
    own = own.select(F.col("rid").alias("_rid"), F.col("licence").alias("own_licence"), "score", F.col("all").alias("own_licences"))
    kept = [c for c in files.columns if c not in ADDED]
    slim = keyed.select(*kept, "_rid", "_dir", "_licence_file").drop("text").join(own, "_rid", "left")
    held = slim.where("_licence_file and own_licence is not null").groupBy("_dir").agg(F.min(F.struct(-F.col("score"), "own_licence")).alias("b"))
    held = held.select(F.col("_dir").alias("_above"), F.col("b.own_licence").alias("_given"))
    parts = F.split("_dir", "/")
    depth = F.when(F.col("_dir") == "", 0).otherwise(F.size(parts))
    above = F.transform(F.sequence(F.lit(0), depth), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("_above")))
    prefixes = slim.select("_dir").distinct().select("_dir", F.explode(above).alias("x")).select("_dir", "x.*")
    nearest = prefixes.join(held, "_above").groupBy("_dir").agg(F.max(F.struct("depth", "_above", "_given")).alias("n"))
    nearest = nearest.select("_dir", F.col("n._above").alias("_above"), F.col("n._given").alias("_given"))
    return slim.join(nearest, "_dir", "left").select(
        *[c for c in kept if c != "text"],
        "own_licence",
        "score",
        "own_licences",
        F.coalesce("own_licence", "_given").alias("licence"),
        F.when(F.col("own_licence").isNull(), F.col("_above")).alias("inherited_from"),
    )


def op9_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence of every document, laid out as a tree of directories.

    Documents have no paths; they lie in source/doc_id div 100/doc_id div 10, and every tenth
    document is the licence file of its directory.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = F.when(F.col("doc_id") % 100 == 0, F.concat_ws("/", "source", F.expr("doc_id div 100"), F.lit("LICENSE")))
    name = name.when(F.col("doc_id") % 10 == 0, F.concat_ws("/", "source", F.expr("doc_id div 100"), F.expr("doc_id div 10"), F.lit("LICENSE")))
    name = name.otherwise(F.concat_ws("/", "source", F.expr("doc_id div 100"), F.expr("doc_id div 10"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    found = scan(docs.select("doc_id", name.alias("path"), "text"))
    return found.select("doc_id", "path", "own_licence", F.array_join("own_licences", ",").alias("own_licences"), "licence", "inherited_from")


def _sql_terms(text: str) -> str:
    """The terms of a text in DuckDB's SQL, whose patterns cannot look ahead or behind."""
    spaced = f"regexp_replace(regexp_replace(lower({text}), '[^a-z0-9.]+', ' ', 'g'), '[.][.]+', ' ', 'g')"
    before = f"regexp_replace(' ' || {spaced} || ' ', '([^0-9])[.]', '\\1 ', 'g')"
    return f"list_filter(string_split(regexp_replace({before}, '[.]([^0-9])', ' \\1', 'g'), ' '), lambda t: t <> '')"


def _sql(least: float = 0.6) -> str:
    rows = [(name, f"{name}#{i}", text) for name, texts in TEMPLATES.items() for i, text in enumerate(texts)]
    values = ", ".join("('{}', '{}', '{}')".format(*row) for row in rows)
    return f"""WITH templates(licence, template, body) AS (VALUES {values}),
split AS (
  SELECT licence, template, term, count(*) AS tf
  FROM (SELECT licence, template, unnest({_sql_terms("body")}) AS term FROM templates) GROUP BY ALL
), idf AS (
  SELECT term, ln(CAST({len(rows) + 1} AS DOUBLE) / (count(*) + 1)) + 1 AS idf FROM split GROUP BY term
), weights AS (
  SELECT licence, template, term, w / sqrt(sum(w * w) OVER (PARTITION BY template)) AS weight
  FROM (SELECT *, tf * idf AS w FROM split JOIN idf USING (term))
), files AS (
  SELECT doc_id, text, doc_id % 10 = 0 AS is_licence,
    CASE WHEN doc_id % 100 = 0 THEN concat_ws('/', source, doc_id // 100)
         ELSE concat_ws('/', source, doc_id // 100, doc_id // 10) END AS dir,
    CASE WHEN doc_id % 10 = 0 THEN 'LICENSE' ELSE doc_id || '.txt' END AS name
  FROM documents
), speaking AS (
  SELECT doc_id, text, is_licence, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{SPEAKS}')) AS lines
  FROM files WHERE regexp_matches(text, '{SPEAKS}')
), units AS (
  SELECT DISTINCT doc_id, unit
  FROM (SELECT doc_id, unnest(CASE WHEN is_licence THEN list_concat([text], lines) ELSE lines END) AS unit FROM speaking)
), weighed AS (
  SELECT doc_id, unit, term, tf * coalesce(idf, ln({len(rows) + 1}) + 1) AS w
  FROM (SELECT doc_id, unit, term, count(*) AS tf
        FROM (SELECT doc_id, unit, unnest({_sql_terms("unit")}) AS term FROM units) GROUP BY ALL)
  LEFT JOIN idf USING (term)
), norms AS (
  SELECT doc_id, unit, sqrt(sum(w * w)) AS norm FROM weighed GROUP BY ALL
), scored AS (
  SELECT doc_id, unit, licence, round(dot / norm, 9) AS score
  FROM (SELECT doc_id, unit, licence, template, sum(w * weight) AS dot FROM weighed JOIN weights USING (term) GROUP BY ALL)
  JOIN norms USING (doc_id, unit)
), best AS (
  SELECT doc_id, unit, licence, score FROM scored WHERE score >= {least}
  QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY score DESC, licence) = 1
), own AS (
  SELECT doc_id, arg_min(licence, row(-score, licence)) AS own_licence, max(score) AS score,
    array_to_string(list_sort(list(DISTINCT licence)), ',') AS own_licences
  FROM best GROUP BY doc_id
), held AS (
  SELECT dir AS above, arg_min(own_licence, row(-score, own_licence)) AS given
  FROM files JOIN own USING (doc_id) WHERE is_licence GROUP BY dir
), prefixes AS (
  SELECT dir, depth, array_to_string(list_slice(string_split(dir, '/'), 1, depth), '/') AS above
  FROM (SELECT dir, unnest(range(len(string_split(dir, '/')) + 1)) AS depth FROM (SELECT DISTINCT dir FROM files))
), nearest AS (
  SELECT dir, arg_max(above, depth) AS above, arg_max(given, depth) AS given
  FROM prefixes JOIN held USING (above) GROUP BY dir
)
SELECT doc_id, dir || '/' || name AS path, own_licence, own_licences, coalesce(own_licence, given) AS licence,
  CASE WHEN own_licence IS NULL THEN above END AS inherited_from
FROM files LEFT JOIN own USING (doc_id) LEFT JOIN nearest USING (dir)"""


ORACLE_SQL = _sql()
