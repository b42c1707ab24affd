"""Chat formatting in Spark expressions only.

A conversation's turns are collected as structs and sorted by turn, role and text. Neighbouring
turns of one role share one block; the parts of a block stay apart, so that the turns can be read
back. The template is

    <turn>ROLE<text>TEXT<part>TEXT...</turn>

In roles and texts ``&`` becomes ``&amp;`` and ``<`` becomes ``&lt;``, so a control string, which
always begins with ``<``, never occurs inside one, and the change can be undone. The loss mask is
kept as segments, in order, whose pieces concatenate to the formatted text: those of assistant
texts are under the mask.

Defined cases: a null text or role is empty; null turns come first; repeated rows are turns of
their own; rows without a conv_id form one conversation; a table without rows gives none. One
conversation is one string, so its rows have to meet; maps collect what they hold beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, PART, END = "<turn>", "<text>", "<part>", "</turn>"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def joined(strings: Column) -> Column:
    return F.array_join(strings, "")


def formatted(conversations: DataFrame) -> DataFrame:
    """``conv_id, formatted, segments (piece, loss)`` of ``conversations (conv_id, turn, role, text)``."""
    row = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))
    # Used twice, so that the sorted array stays a column.
    turns = turns.select("conv_id", "turns", F.size("turns").alias("n"))

    def segment(turn: Column, i: Column) -> Column:
        role, last, next_ = turn["role"], F.get("turns", i - 1)["role"], F.get("turns", i + 1)["role"]
        opening = F.when(role.eqNullSafe(last), PART).otherwise(F.concat(F.lit(TURN), escaped(role), F.lit(TEXT)))
        closing = F.when(role.eqNullSafe(next_), "").otherwise(END)
        return F.array(
            F.struct(opening.alias("piece"), F.lit(False).alias("loss")),
            F.struct(escaped(turn["text"]).alias("piece"), (role == ASSISTANT).alias("loss")),
            F.struct(closing.alias("piece"), F.lit(False).alias("loss")),
        )

    pieces = turns.select("conv_id", F.flatten(F.transform("turns", segment)).alias("segments"), "n")
    return pieces.select("conv_id", joined(F.transform("segments", lambda s: s["piece"])).alias("formatted"), "segments")


def read_back(chats: DataFrame) -> DataFrame:
    """``conv_id, turns (role, text), loss_text, formatted`` from ``formatted`` and ``segments``."""

    def block_turns(block: Column) -> Column:
        sides = F.split(F.substring(block, len(TURN) + 1, 2147483647), TEXT)
        return F.transform(
            F.split(sides[1], PART),
            lambda part: F.struct(unescaped(sides[0]).alias("role"), unescaped(part).alias("text")),
        )

    blocks = F.filter(F.split("formatted", END), lambda block: block != "")
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["piece"]))
    return chats.select(
        "conv_id", "formatted", F.flatten(F.transform(blocks, block_turns)).alias("turns"), joined(loss).alias("loss_text")
    )
