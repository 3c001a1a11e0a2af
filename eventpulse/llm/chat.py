"""Chat formatting: every assistant turn becomes an example with the turns before it as context.

Only DataFrame functions are used. A conversation is formatted once, in blocks of
neighbouring turns, so neither a block nor a task grows with a conversation that
holds a third of all turns. An example names its context as the first
``context_chars`` characters of the formatted conversation, which are exactly its
earlier turns, and carries its own reply; so examples together are as long as the
conversations, not as their squares. ``example_texts`` writes contexts out.

The template of a turn is ``### role: text </turn>`` and a line feed. Inside texts and
roles ``\\``, ``<`` and ``#`` (in roles also ``:``) become ``\\\\``, ``\\l``, ``\\h``
and ``\\c``, so no text can hold a mark of the template, and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_or_empty

# Turn numbers of a block span at most this much.
BLOCK_TURNS = 256
TURN = r"### ([^:#<]*): ([^#<]*) </turn>\n"
_ROLE, _TEXT = 1, 2


def escape(text: Column, in_role: bool = False) -> Column:
    for raw, name in (("\\", "\\\\"), ("<", "\\l"), ("#", "\\h"), *([(":", "\\c")] if in_role else [])):
        text = F.replace(text, F.lit(raw), F.lit(name))
    return text


def unescape(text: Column) -> Column:
    """The inverse of ``escape``. Marks that escaped text never holds stand in for characters until the last step."""
    for name, stand_in in (("\\\\", "<"), ("\\l", "#"), ("\\c", ":"), ("\\h", "\\")):
        text = F.replace(text, F.lit(name), F.lit(stand_in))
    return F.translate(text, "<#\\", "\\<#")


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("### "), role, F.lit(": "), text, F.lit(" </turn>\n"))


def format_blocks(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The formatted conversations in blocks: conv_id, block, start, text, replies.

    ``start`` is the number of characters of the conversation before the block.
    ``replies`` lists the assistant turns of the block in order: their turn number and
    the place of their text within the block, which is the loss mask. Turns are ordered
    by number, null first; of equal numbers by role and text. Null roles and texts are
    empty; null conversation ids are one conversation; an assistant is any role that
    reads ``assistant``. Repeated rows are repeated turns. Other columns are ignored.
    """
    rows = conversations.select(
        F.col(conv_col).cast("bigint").alias("conv_id"),
        F.col(turn_col).cast("bigint").alias("turn"),
        text_or_empty(F.col(role_col).cast("string")).alias("role"),
        text_or_empty(F.col(text_col).cast("string")).alias("text"),
    )
    turns = (
        rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(2**62))))
        .groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            t["turn"].alias("turn"), (t["role"] == "assistant").alias("loss"),
            escape(t["role"], in_role=True).alias("role"), escape(t["text"]).alias("text"),
        ),
    )
    formatted = turns.select("conv_id", "block", pieces.alias("pieces")).withColumn(
        "text", F.concat_ws("", F.transform("pieces", lambda p: _turn(p["role"], p["text"])))
    )
    n_chars = F.char_length("text").cast("bigint")
    before = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return formatted.withColumn("start", F.coalesce(F.sum(n_chars).over(before), F.lit(0))).select(
        "conv_id", "block", "start", "text", "pieces"
    )


def examples(blocks: DataFrame) -> DataFrame:
    """One example per assistant turn, from the blocks: conv_id, turn, block, context_chars, target, loss_start, loss_end.

    ``target`` is the formatted reply; the loss mask covers its characters from
    ``loss_start`` up to ``loss_end``, which is the text alone.
    """
    spread = blocks.select("conv_id", "block", "start", F.posexplode("pieces").alias("place", "piece"))
    piece = F.col("piece")
    text = _turn(piece["role"], piece["text"])
    order = W.partitionBy("conv_id", "block").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    loss_start = F.char_length(piece["role"]) + len("### : ")
    return (
        spread.withColumn("before", F.coalesce(F.sum(F.char_length(text)).over(order), F.lit(0)))
        .where(piece["loss"])
        .select(
            "conv_id", piece["turn"].alias("turn"), "block", "place",
            (F.col("start") + F.col("before")).alias("context_chars"), text.alias("target"),
            loss_start.alias("loss_start"), (loss_start + F.char_length(piece["text"])).alias("loss_end"),
        )
    )


def example_texts(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """Adds ``context``, written out, to the examples. As long as the examples' contexts together are."""
    parts = blocks.select(F.col("conv_id").alias("of"), "start", "text")
    reached = found.withColumn("key", F.xxhash64("conv_id", "block", "place")).join(
        parts, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("start") < F.col("context_chars")), "left"
    )
    cut_off = F.expr("struct(start, substring(text, 1, int(context_chars - start)) AS text)")
    return (
        reached.groupBy(*found.columns)
        .agg(F.sort_array(F.collect_list(F.when(F.col("start").isNotNull(), cut_off))).alias("parts"))
        .withColumn("context", F.concat_ws("", F.col("parts.text")))
        .drop("parts")
    )


def read_turns(blocks: DataFrame) -> DataFrame:
    """The turns, read back from the formatted text alone: conv_id, block, turns (role and text, in order)."""
    roles = F.regexp_extract_all("text", F.lit(TURN), F.lit(_ROLE))
    texts = F.regexp_extract_all("text", F.lit(TURN), F.lit(_TEXT))
    return blocks.select(
        "conv_id", "block", F.char_length("text").cast("bigint").alias("n_chars"),
        F.transform(
            F.arrays_zip(roles.alias("role"), texts.alias("text")),
            lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")),
        ).alias("turns"),
    )


def read_losses(found: DataFrame, blocks: DataFrame) -> DataFrame:
    """The text under each example's loss mask: conv_id, block, place, loss_text.

    It is read from the formatted conversation, right after the example's context, so a
    context that ends elsewhere than at its reply gives another text.
    """
    told = blocks.select(F.col("conv_id").alias("of"), F.col("block").alias("told_block"), "start", F.col("text").alias("told"))
    there = found.join(told, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("told_block")))
    masked = F.expr("substring(told, int(context_chars - start) + loss_start + 1, loss_end - loss_start)")
    return there.select("conv_id", "block", "place", unescape(masked).alias("loss_text"))
