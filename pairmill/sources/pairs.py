"""Pair tables derived from dialogues and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.operators.lookup import ranked

ROWS_PER_DOCUMENT = 10_000_000


def dialogue_pairs(turns: DataFrame) -> DataFrame:
    """User turns with the assistant turn that comes next in the conversation, by turn number.

    Numbers may have gaps. Turns get their place in the order of all, over range partitions, and meet
    the next place by an equi-join, so one endless conversation still spreads evenly. Turns without
    ``conv_id`` are one conversation, and those without a number come last.
    """
    order = [F.col("conv_id").asc(), F.col("turn").asc_nulls_last(), F.desc("role"), F.asc("text")]
    placed = ranked(turns.select("conv_id", "turn", "role", "text"), order, "place")
    asked = placed.where(F.col("role") == "user").select("place", "conv_id", "turn", F.col("text").alias("query"))
    replied = placed.where(F.col("role") == "assistant").select(
        (F.col("place") - 1).alias("place"), F.col("conv_id").alias("_conv"), F.col("text").alias("response"))
    return asked.join(replied, "place").where(F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "turn", (F.col("conv_id") * ROWS_PER_DOCUMENT + F.col("turn")).alias("row_id"),
        "query", "response")


def line_pairs(documents: DataFrame) -> DataFrame:
    """Each line of a text with the next one as its reply; stays inside the row."""
    lines = F.split("text", "\n", -1)
    pair = F.transform(F.sequence(F.lit(0), F.size("lines") - 2), lambda i: F.struct(
        (F.col("doc_id") * ROWS_PER_DOCUMENT + i).alias("row_id"),
        F.get("lines", i).alias("query"), F.get("lines", i + 1).alias("response")))
    pairs = F.when(F.size("lines") >= 2, pair)
    return (documents.select("doc_id", "source", "lang", lines.alias("lines"))
            .select(F.inline(pairs), F.col("source").alias("category"),
                    F.col("lang").alias("intent")))
