"""Chat formatting with relational operators and string expressions only.

The turns of a conversation are collected as structs and sorted; neighbouring turns of one
role become one block; the blocks are concatenated.  The template is

    <s>[HEAD role]text[/HEAD]            one block of one turn
    <s>[HEAD role]text[AND]text[/HEAD]   one block of two turns of the same role
    ...</s>                              the end of the conversation

Inside roles and texts ``&``, ``<``, ``[`` and ``]`` are written as ``&amp;``, ``&lt;``, ``&#91;`` and
``&#93;``, so no control string can appear in them and every turn can be read back.  ``loss`` lists the
start and length, in code points of the formatted text, of what is trained on: the texts of
the ``learn`` roles, without marks.

A null text or role is empty; turns are ordered by turn, role, text, nulls first, so
repeated turn numbers and repeated rows have a fixed place; null conversation ids are one
conversation; extra columns are ignored; an empty table gives an empty one.  A conversation
is one row of the result, so it must fit one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END, HEAD, HEAD_END, AND, CLOSE = "<s>", "</s>", "[HEAD ", "]", "[AND]", "[/HEAD]"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    out = F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit("["), F.lit("&#91;"))
    return F.replace(out, F.lit("]"), F.lit("&#93;"))


def unescape(text: Column) -> Column:
    """Every ``&`` of an escaped text begins one of four marks, so the order below is safe."""
    out = F.replace(F.replace(text, F.lit("&#91;"), F.lit("[")), F.lit("&#93;"), F.lit("]"))
    out = F.replace(out, F.lit("&lt;"), F.lit("<"))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def format_conversations(conversations: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, formatted, loss) with one row per conversation."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    # The piece before each text: what closes the last block and opens the next, or the mark between merged turns.
    role, last = (lambda i: F.get(F.col("turns"), i)["role"]), (lambda i: F.get(F.col("turns"), i - 1)["role"])

    def mark(i):
        head = F.concat(F.lit(HEAD), escape(role(i)), F.lit(HEAD_END))
        return F.when(i == 0, F.concat(F.lit(START), head)).when(role(i) == last(i), F.lit(AND)).otherwise(F.concat(F.lit(CLOSE), head))

    pieces = F.transform("turns", lambda t, i: F.struct(mark(i).alias("mark"), escape(t["text"]).alias("body"), t["role"].isin(*learn).alias("learn")))
    chats = chats.select("conv_id", pieces.alias("pieces"))
    body = F.concat_ws("", F.transform("pieces", lambda p: F.concat(p["mark"], p["body"])))
    sizes = F.transform("pieces", lambda p: F.struct(F.length(p["mark"]).alias("m"), F.length(p["body"]).alias("b"), p["learn"].alias("learn")))
    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out"))

    def step(acc, p):
        start = acc["at"] + p["m"]
        span = F.array(F.struct(start.alias("start"), p["b"].alias("length")))
        return F.struct((start + p["b"]).alias("at"), F.when(p["learn"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return chats.select(
        "conv_id",
        F.concat(body, F.lit(CLOSE + END)).alias("formatted"),
        F.aggregate(sizes, none, step, lambda acc: acc["out"]).alias("loss"),
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    inside = F.substring(formatted, F.lit(len(START) + len(HEAD) + 1), F.length(formatted) - len(START + HEAD + CLOSE + END))
    blocks = F.split(inside, r"\Q" + CLOSE + HEAD + r"\E", -1)

    def turns(block):
        at = F.instr(block, HEAD_END)
        role, texts = F.substring(block, F.lit(1), at - 1), F.substring(block, at + 1, F.length(block))
        return F.transform(F.split(texts, r"\Q" + AND + r"\E", -1), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_texts(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))


def op4_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one that says control strings, read back from the format."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    chats = format_conversations(rows.unionByName(probe))
    turns = read_back(F.col("formatted"))
    masked = F.concat_ws("", masked_texts(F.col("formatted"), F.col("loss")))
    chats = chats.select("conv_id", F.length("formatted").cast("long").alias("formatted_chars"), turns.alias("turns"), masked.alias("masked"))
    listed = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2(F.col("masked"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), ']', '&#93;') AS r,
    replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), ']', '&#93;') AS x,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(x) + CASE WHEN before = role THEN 5 ELSE length('[HEAD ]') + length(r)
    + CASE WHEN before IS NULL THEN 3 ELSE 7 END END) + 11 AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
