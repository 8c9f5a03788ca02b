"""Conversations: turns with their neighbours, and whole chats as text.

A turn is identified by ``(conv_id, turn)``.  Nothing here brings a whole conversation to one task, since one may hold
a large part of all turns: it is handled in stretches of turn numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tunemill.functions.templates import OPEN_TAG, chat_turn
from tunemill.functions.values import whole_div

# Turns that are looked at together, and rendered into one row of a chat.
PART_TURNS = 1_000


def with_neighbours(turns: DataFrame, part_turns: int = PART_TURNS, over_gaps: bool = False) -> DataFrame:
    """Add the role and text of the turn before (``prev_``) and after (``next_``).

    Where numbers are missing, what was said there is unknown: the turns beside
    the gap have no neighbour on that side, unless ``over_gaps`` asks for the
    next turn there is.  Turns are compared within a stretch; its first and last take theirs from a
    table with the ends of each stretch.  NULL is a conversation like others.
    """
    said = F.struct("turn", "role", "text")
    stretched = turns.withColumn("_part", whole_div("turn", part_turns)).withColumn("_conv", F.struct("conv_id"))
    ends = stretched.groupBy("_conv", "_part").agg(F.min(said).alias("_first"), F.max(said).alias("_last"))
    stretches = Window.partitionBy("_conv").orderBy("_part")
    beside = ends.select(
        "_conv",
        "_part",
        F.lag("_last").over(stretches).alias("_before"),
        F.lead("_first").over(stretches).alias("_after"),
    )
    order = Window.partitionBy("_conv", "_part").orderBy("turn")
    seen = stretched.withColumn("_prev", F.lag(said).over(order)).withColumn("_next", F.lead(said).over(order))
    joined = seen.join(beside, ["_conv", "_part"], "left")

    def neighbour(side: str, end: str, field: str) -> Column:
        other = F.coalesce(F.col(f"_{side}"), F.col(f"_{end}"))
        adjacent = F.lit(over_gaps) | (F.abs(other["turn"] - F.col("turn")) == 1)
        return F.when(adjacent, other[field]).alias(f"{side}_{field}")

    return joined.select(
        *turns.columns,
        neighbour("prev", "before", "role"),
        neighbour("prev", "before", "text"),
        neighbour("next", "after", "role"),
        neighbour("next", "after", "text"),
    )


def question_answer_pairs(turns: DataFrame, part_turns: int = PART_TURNS, over_gaps: bool = False) -> DataFrame:
    """Every user turn that the assistant answers next, and what was said before it.

    See :func:`with_neighbours` for turns beside a gap: by default they make no pair.
    """
    answered = (F.col("role") == "user") & (F.col("next_role") == "assistant")
    return (
        with_neighbours(turns, part_turns, over_gaps)
        .filter(answered)
        .select(
            "conv_id",
            "turn",
            F.col("text").alias("question"),
            F.col("next_text").alias("answer"),
            "prev_role",
            "prev_text",
        )
    )


def chat_text(turns: DataFrame, part_turns: int) -> DataFrame:
    """All turns of a conversation in order, with an open assistant tag if one is due.

    Gives ``conv_id, part, n_turns, text``; a row is identified by ``(conv_id,
    part)``.  Part ``p`` holds the turns from ``p * part_turns`` on, as many as
    ``part_turns``, which the caller has to choose: chats of fewer turns are
    part 0, the parts of a longer one, put together in order, are its text, and
    only the last may end with an open tag.
    """
    # The first turn of a part is announced to the part before, which then
    # knows that the chat goes on.
    parts = F.array(whole_div("turn", part_turns), F.expr(f"greatest(turn - 1, 0) div {part_turns}"))
    placed = turns.withColumn("part", F.explode(F.array_distinct(parts)))
    own = F.col("part") == whole_div("turn", part_turns)
    line = chat_turn(F.col("role"), F.col("text")).alias("line")
    gathered = placed.groupBy("conv_id", "part").agg(
        F.count_if(own).alias("n_turns"),
        F.array_sort(F.collect_list(F.when(own, F.struct("turn", line)))).alias("lines"),
        F.max(F.struct("turn", "role", own.alias("own"))).alias("last"),
    )
    due = F.col("last.own") & (F.col("last.role") == "user")
    text = F.concat(
        F.array_join(F.col("lines.line"), ""),
        F.when(due, f"{OPEN_TAG}assistant\n").otherwise(""),
    )
    return gathered.select("conv_id", "part", "n_turns", text.alias("text"))
