"""Quotation linking for conversations, in DataFrame operations only.

1. Lines that begin with ``>`` are quotations; the number of marks is their level.  Up to
   three blanks may stand before a mark; a line that is indented further is no quotation.
2. The other lines are the message's own text.  Its paragraphs, lines and sentences,
   normalised (lower case, white space folded) and hashed, are what others can quote.
3. Quoted lines of one level in a row are a passage, hashed in the same way by
   paragraph, line and sentence, and joined on conversation and hash to the first message
   that holds it as its own text.  So a quotation may be trimmed to whole sentences, and
   be wrapped in other places.
4. A message replies to the source of a quotation of its lowest linked level, of the
   longest passage there, and of the earliest of equal ones.
5. Pointer doubling gives the root and depth of each message.

Rows ordered by ``conv_id, root_turn, depth, turn`` are the conversation in reply order.
Sources are aggregated to their first turn before the join, so a passage that a third
of all messages share gives each of them one row, not a pair with every other.

Cases: a message without a linked quotation is a root; a quotation of the message
itself or of a later one links nothing; null and empty texts stay as empty messages;
rows that share conversation and turn are one message for linking, equal ones count
once, and all stay rows; rows without conversation or turn are roots of depth 0.  An
empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import written

MARKS = r"^(?: {0,3}>)+"
#: Where a sentence of a normalised paragraph ends.
SENTENCE_END = r"(?<=[.!?]) |(?<=[。！？]) ?"


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n")


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normalised(passage: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(passage, r"\s+", " ")))


def _hashes(passage: Column) -> Column:
    """``hash, size`` of the paragraphs, lines and sentences of a passage."""
    paragraphs = F.transform(F.split(passage, r"\n[ \t]*\n"), normalised)
    sentences = F.flatten(F.transform(paragraphs, lambda p: F.split(p, SENTENCE_END)))
    lines = F.transform(F.split(passage, r"\n"), normalised)
    filled = F.filter(F.concat(paragraphs, sentences, lines), lambda p: F.length(p) > 0)
    return F.transform(
        F.array_distinct(filled), lambda p: F.struct(F.sha2(p, 256).alias("hash"), F.length(p).alias("size"))
    )


def own_text(text: Column) -> Column:
    """The text without quotations; where they were, a paragraph ends."""
    kept = F.transform(_lines(text), lambda x: F.when(x.rlike(MARKS), F.lit("")).otherwise(x))
    folded = F.regexp_replace(F.array_join(kept, "\n"), r"\n[ \t]*\n(?:[ \t]*\n)*", "\n\n")
    return F.when(F.coalesce(text, F.lit("")).rlike("(?m)" + MARKS), F.trim(folded, F.lit(" \t\n"))).otherwise(
        F.coalesce(text, F.lit(""))
    )


def quoted_passages(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, level, passage``: quoted lines of one level in a row, without their marks."""
    quoting = messages.where(F.col("text").rlike("(?m)" + MARKS)).distinct().select(
        "conv_id", "turn", F.xxhash64("text").alias("copy"), F.posexplode(_lines(F.col("text"))).alias("n", "line")
    )
    message = Window.partitionBy("conv_id", "turn", "copy").orderBy("n")
    levelled = quoting.withColumn("level", level(F.col("line")))
    change = F.coalesce((F.col("level") != F.lag("level").over(message)).cast("int"), F.lit(0))
    runs = levelled.withColumn("change", change).withColumn("run", F.sum("change").over(message))
    body = F.regexp_replace("line", MARKS + "[ \t]?", "")
    return (
        runs.where("level > 0")
        .groupBy("conv_id", "turn", "copy", "run", "level")
        .agg(F.array_sort(F.collect_list(F.struct("n", body.alias("body")))).alias("lines"))
        .select("conv_id", "turn", "level", F.array_join(F.col("lines.body"), "\n").alias("passage"))
    )


def reply_links(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, parent_turn, quotations`` for the messages that quote an earlier one."""
    known = messages.where("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", "text")
    quoted = quoted_passages(known).select(
        "conv_id", "turn", "level", F.explode(_hashes(F.col("passage"))).alias("part")
    ).select("conv_id", "turn", "level", "part.hash", "part.size")
    quoted = written(quoted, "quoted")
    wanted = quoted.select("conv_id", "hash").distinct()
    sources = (
        known.select("conv_id", "turn", F.explode(_hashes(own_text(F.col("text")))).alias("part"))
        .select("conv_id", "turn", "part.hash")
        .groupBy("conv_id", "hash")
        .agg(F.min("turn").alias("source"))
        .join(wanted, ["conv_id", "hash"], "left_semi")
    )
    best = F.struct(F.col("level"), (-F.col("size")).alias("size"), F.col("source"))
    return (
        quoted.join(sources, ["conv_id", "hash"])
        .where("source < turn")
        .groupBy("conv_id", "turn")
        .agg(F.min(best).alias("best"), F.count("*").alias("quotations"))
        .select("conv_id", "turn", F.col("best.source").alias("parent_turn"), "quotations")
    )


def threads(links: DataFrame) -> DataFrame:
    """``conv_id, turn, root_turn, depth`` of the messages that reply, by pointer doubling."""
    one = F.lit(1).cast("long").alias("depth")
    at = written(links.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), one), "threads")
    while True:
        up = at.toDF("conv_id", "root_turn", "above", "more")
        doubled = at.join(up, ["conv_id", "root_turn"], "left")
        moved = written(
            doubled.select(
                "conv_id",
                "turn",
                F.coalesce("above", "root_turn").alias("root_turn"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                F.col("above").isNotNull().alias("moved"),
            ),
            "threads",
        )
        if moved.where("moved").isEmpty():
            return at
        at = moved.drop("moved")


def linked_conversations(messages: DataFrame) -> DataFrame:
    """``messages`` with their own text, whom they reply to, and their place in reply order."""
    links = written(reply_links(messages), "links")
    placed = links.join(threads(links), ["conv_id", "turn"])
    return messages.select("conv_id", "turn", "role", "text").join(placed, ["conv_id", "turn"], "left").select(
        "conv_id",
        "turn",
        "role",
        "parent_turn",
        F.coalesce("root_turn", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("quotations", F.lit(0)).alias("quotations"),
        own_text(F.col("text")).alias("own_text"),
    )


def op7_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    return linked_conversations(spark.read.parquet(f"{folder.rstrip('/')}/conversations.parquet"))


#: The tables hold no quotations; the SQL tells which lines are quoted, links none and keeps the turns.
ORACLE = r"""
WITH lines AS (
  SELECT conv_id, turn, role, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM conversations
), quoting AS (
  SELECT conv_id, turn, bool_or(regexp_matches(line, '^( {0,3}>)+')) AS quotes FROM lines GROUP BY conv_id, turn
)
SELECT conv_id, turn, role, CAST(NULL AS BIGINT) AS parent_turn, turn AS root_turn, 0::BIGINT AS depth,
       0::BIGINT AS quotations, coalesce(text, '') AS own_text
FROM conversations JOIN quoting USING (conv_id, turn) WHERE NOT quotes
"""
