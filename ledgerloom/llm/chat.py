"""Conversations as marked-up text, in Spark expressions only.

A conversation's rows are collected as structs and sorted; adjacent turns of one role are
merged into a block by an array aggregation; blocks are joined to one string:

    <turn>role<says/>text<next/>text</turn>

All control strings begin with ``<`` and are escaped in roles and texts, so that whatever a
text holds, the output splits at true marks only and gives every turn back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SAYS, NEXT, CLOSE = "<turn>", "<says/>", "<next/>", "</turn>"
_MARKS = "turn>|says/>|next/>|/turn>"
TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    """Backslashes doubled, and one put after the ``<`` of each control string."""
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), f"<({_MARKS})", r"<\\$1")


def unescaped(text: Column) -> Column:
    """The inverse of :func:`escaped`: an escaped text has lone backslashes after ``<`` only."""
    return F.regexp_replace(F.regexp_replace(text, rf"<\\({_MARKS})", "<$1"), r"\\\\", r"\\")


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``formatted`` and ``segments``, its parts in order.

    ``segments`` are structs of ``text`` and ``loss``; joined they are ``formatted``, and loss
    is true for what the model is trained on: the texts of assistant turns, without marks.
    Rows are ordered by ``turn``, then role and text, nulls first, so that ties and repeated
    rows have one order. A null text or role is empty; rows with a null ``conv_id`` are one
    conversation. Other columns are ignored; no rows give none.
    """
    turns = (
        rows.select(
            "conv_id",
            F.struct(
                F.col("turn").cast("long").alias("turn"),
                F.coalesce("role", F.lit("")).alias("role"),
                F.coalesce("text", F.lit("")).alias("text"),
            ).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("t")).alias("turns"))
    )
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    mark = lambda text: segment(text, F.lit(False))

    def parts(t: Column, i: Column) -> Column:
        """A turn's segments: what ends the block before it, what begins its own, its text."""
        before = F.when(i > 0, F.element_at(F.col("turns"), i))  # element_at counts from 1
        same = F.coalesce(before["role"] == t["role"], F.lit(False))
        header = F.concat(F.when(i > 0, CLOSE).otherwise(""), F.lit(OPEN), escaped(t["role"]), F.lit(SAYS))
        return F.array(
            mark(F.when(same, F.lit(NEXT)).otherwise(header)), segment(escaped(t["text"]), t["role"] == TRAINED_ROLE)
        )

    segments = F.concat(F.flatten(F.transform("turns", parts)), F.array(mark(F.lit(CLOSE))))
    return turns.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.col("segments")["text"], "").alias("formatted"), "segments"
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of structs (role, text)."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turns(block: Column) -> Column:
        halves = F.split(F.substring(block, len(OPEN) + 1, 2_147_483_647), SAYS, 2)
        return F.transform(
            F.split(halves[1], NEXT, -1),
            lambda text: F.struct(unescaped(halves[0]).alias("role"), unescaped(text).alias("text")),
        )

    return F.flatten(F.transform(blocks, turns))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text holds, read back from it and from its loss mask."""
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    trained = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
    return (
        formatted.select(
            "conv_id",
            read_back(F.col("formatted")).alias("turns"),
            trained.alias("trained"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("trained").cast("long").alias("loss_chars"),
            F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
