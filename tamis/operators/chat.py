"""Conversations as training text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.sources.staging import stage_table

# The roles that are rendered, the end-of-text token, and the assistant's opening.
ROLES = ("user", "system", "assistant")
EOS = "</s>"
OPENING = "<|assistant|>\n"


def segment(role: Column, text: Column, eos: str = EOS) -> Column:
    """One message; nothing for an unknown role."""
    body = F.concat(
        F.lit("<|"), role, F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit(f"{eos}\n")
    )
    return F.when(role.isin(*ROLES), body).otherwise("")


def chat_render(messages: DataFrame, add_generation_prompt: bool = False, eos: str = EOS) -> DataFrame:
    """``(conv_id, turn, segment)``, one row per message: the conversation's text in order.

    Read by ``turn`` (null first), equal turns by segment, the segments make up the text of a
    conversation, whatever its length; no task holds a whole one. With
    ``add_generation_prompt`` the assistant's opening is appended to the last segment in that
    order (to each of them, if that row is repeated).
    """
    rendered = messages.select("conv_id", "turn", segment(F.col("role"), F.col("text"), eos).alias("segment"))
    if not add_generation_prompt:
        return rendered
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "segment")
    last = rendered.groupBy(F.col("conv_id").alias("_conv")).agg(F.max(place).alias("_last"))
    last = stage_table(last, "last-turns")  # stored, so that the join can split a long conversation
    joined = rendered.join(last, F.col("conv_id").eqNullSafe(F.col("_conv")))
    opened = F.when(place.eqNullSafe(F.col("_last")), F.concat("segment", F.lit(OPENING))).otherwise(F.col("segment"))
    return joined.select("conv_id", "turn", opened.alias("segment"))
