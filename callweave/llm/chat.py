"""Operator 10: chat formatting by prefix-target expansion.

A turn is written `### role: text</turn>` and a line end. In texts and roles the characters of the marks are written as two-character escapes,
so no text can open or close a turn and every text can be read back exactly. Each assistant turn becomes an example of its own: all turns up
to it, of which only that reply may be trained on (`loss_start`, `loss_end`, code points). Turns after the last reply end in one
further example that trains on nothing, so that the output holds every turn.

Turns are ordered by (turn, role, text), nulls first; repeated rows stay separate turns. Null texts and roles are empty; a null conv_id is a
conversation; an empty table gives no examples. Other columns are ignored. An example is one row, so a conversation has to fit in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm import common

OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"
#: Written form of each character that a mark needs; the escape character itself comes first.
ESCAPES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))


def escape(text: Column, table: tuple = ESCAPES) -> Column:
    for raw, written in table:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column, table: tuple = ESCAPES) -> Column:
    for raw, written in reversed(table):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end (0-based, end exclusive; both 0 where nothing is trained on)."""
    rows = turns.select("conv_id", F.col("turn").alias("n"), common.whole(F.col("role")).alias("role"), common.whole(F.col("text")).alias("text"))
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("n", "role", "text"))).alias("turns"))
    shown = talks.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == "assistant").alias("reply"),
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"], ROLE_ESCAPES), F.lit(SEP), escape(t["text"]), F.lit(CLOSE))).alias("turns"),
    )
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (i == F.size("turns")) | F.element_at("reply", i))
    each = shown.select("conv_id", "reply", "turns", F.posexplode(ends).alias("example", "last"))
    head = F.char_length(F.lit(OPEN + "assistant" + SEP))
    text = F.array_join(F.slice("turns", F.lit(1), F.col("last")), "")
    length, final = F.char_length("text"), F.char_length(F.element_at("turns", F.col("last")))
    trained = F.element_at("reply", F.col("last"))
    return each.withColumn("text", text).select(
        "conv_id", "example", "text",
        F.when(trained, length - final + head).otherwise(0).alias("loss_start"),
        F.when(trained, length - len(CLOSE)).otherwise(0).alias("loss_end"),
    )


def read_turns(text: Column) -> Column:
    """array<struct<role, text>> of a formatted text."""
    parts = F.split(text, CLOSE, -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def turn(part: Column) -> Column:
        colon = F.instr(part, SEP)
        role = F.substring(part, F.lit(len(OPEN) + 1), colon - len(OPEN) - 1)
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(F.substring(part, colon + len(SEP), F.char_length(part))).alias("text"))

    return F.transform(parts, turn)


def read_loss(row: DataFrame) -> Column:
    """The text under an example's loss mask."""
    return unescape(F.substring(row["text"], row["loss_start"] + 1, row["loss_end"] - row["loss_start"]))


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation, what reading all its examples back gives."""
    out = examples(turns)
    marked = out.select("conv_id", "example", "text", read_loss(out).alias("loss"), F.char_length("text").cast("long").alias("chars"))
    # The last example holds all turns; of the others only the trained text goes on.
    per = marked.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    read = per.withColumn("turns", read_turns(F.col("text")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: The conversation that the query adds: both turns say what the marks of another template look like.
ADDED = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    talks = common.table(spark, folder, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return digests(talks.unionByName(spark.createDataFrame(ADDED, "conv_id long, turn long, role string, text string")))


ORACLE = {"op10_chat": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
  length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), ':', ''))
  + length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', '')) + 14 AS chars FROM t),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM p GROUP BY conv_id"""}

QUERIES = {"op10_chat": op10_chat}
