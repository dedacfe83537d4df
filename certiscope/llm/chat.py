"""Dialogues seen from each participant: their turns as the assistant's, all others as named users.

Method
    Every speaker of a conversation is taken in turn as the assistant. A conversation of m turns and k
    speakers gives m * k segments, in the order of turns: the speaker's own turns are rendered as assistant
    messages and are the only text to learn from; the others' turns are user messages that carry their name.
    Turns of context roles, like system, are no speaker's; they stay what they are in every rendering.

Scale
    Segments stay rows, so a conversation of any length is never gathered in one place. The speakers are found
    by an aggregate with partial results and meet the turns in a join on the conversation, which Spark splits
    when one conversation is very long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT_ROLES = ("system",)


def rotate(turns: DataFrame, context_roles: tuple[str, ...] = CONTEXT_ROLES, conv_id: str = "conv_id", turn: str = "turn",
           role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation, perspective and turn.

    Columns: conv_id, perspective (the speaker who is the assistant), turn, role and name of the message,
    segment (the rendered text), learn, and mask_start and mask_end, the code points of the segment to learn
    from (both 0 where there is nothing). A null role is a speaker called ``unknown``; a null text is empty. A
    conversation with context roles alone has no perspective and no row. Null conversation ids form one
    conversation. Repeated rows are rendered each; rows of one turn keep no order among each other. Other
    columns are not read.
    """
    said = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
                        F.coalesce(F.col(role).cast("string"), F.lit("unknown")).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    speakers = said.where(~F.col("speaker").isin(*context_roles)).select(
        F.col("conv_id").alias("of_conv"), F.col("speaker").alias("perspective")).distinct()
    seen = said.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_conv")))
    own, context = F.col("speaker") == F.col("perspective"), F.col("speaker").isin(*context_roles)
    role_now = F.when(own, "assistant").when(context, F.col("speaker")).otherwise("user")
    seen = seen.withColumns({"role": role_now, "name": F.when(~own & ~context, F.col("speaker")), "own": own})
    head = F.concat(F.lit("<|"), F.col("role"), F.coalesce(F.concat(F.lit(" name="), "name"), F.lit("")), F.lit("|>\n"))
    learn = F.col("own") & (F.col("text") != "")
    start = F.length(head)
    return seen.select(
        "conv_id", "perspective", "turn", "role", "name", F.concat(head, F.col("text"), F.lit("<|end|>\n")).alias("segment"), learn.alias("learn"),
        F.when(learn, start).otherwise(0).cast("long").alias("mask_start"),
        F.when(learn, start + F.length("text") + F.length(F.lit("<|end|>"))).otherwise(0).cast("long").alias("mask_end"))
