"""Queries + candidate replies -> answer table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions import fixed, text
from pairmill.functions.basics import empty_strings
from pairmill.functions.render import render
from pairmill.operators import gate, hypotheses as hyps, slots, vocab as voc
from pairmill.plans.prepare import asked_queries
from pairmill.settings import Settings


def answer_batch(queries: DataFrame, candidates: DataFrame, lexicon, vocab: DataFrame,
                 slot_map: DataFrame | dict[str, str] | None = None, apply_gate: bool = True,
                 strategy: str = "beam", beam_size: int | None = 3, limit: int | None = None,
                 settings: Settings = Settings()) -> DataFrame:
    """``queries`` has (query_id, query); ``candidates`` follows HYPOTHESES.

    Queries without a candidate count as log-probability minus infinity, so the
    gate refuses them. ``slot_map`` is a constant, or a staged slot table (raw, slot, n) of any size,
    by which queries are filled and replies rendered.
    """
    if limit is not None:
        queries = queries.orderBy("query_id").limit(limit)
    best = hyps.best_hypothesis(candidates.where(F.col("strategy") == strategy),
                                settings.length_penalty)
    best = voc.decode(best, "token_ids", vocab, "query_id", out="raw_tokens",
                      settings=settings).select("query_id", "raw_tokens", "avg_logprob")
    asked = asked_queries(queries, slot_map, "query_id", settings)
    joined = asked.join(best, "query_id", "left").withColumn(
        "logprob", F.coalesce("avg_logprob", F.lit(float("-inf")))).drop("avg_logprob")
    gated = gate.scope_gate(joined, lexicon, key="query_id", settings=settings)
    tokens = F.coalesce("raw_tokens", empty_strings())
    if isinstance(slot_map, DataFrame):
        gated = slots.render_df(gated.withColumn("raw_tokens", tokens), {"raw_tokens": "_reply"}, slot_map,
                                "query_id", settings)
    else:
        inverse = {slot: raw for raw, slot in reversed(list((slot_map or {}).items()))
                   if slot != fixed.GENERIC_SLOT}
        gated = gated.withColumn("_reply", render(tokens, inverse))
    reply = gate.substitute_refusal(F.col("_reply"), F.col("in_scope"), apply_gate)
    reply = F.when(F.size("query_tokens") == 0, fixed.REFUSAL).otherwise(reply)
    beam = F.lit(beam_size if strategy == "beam" else None).cast("int")
    return gated.select(
        "query_id", "query", "query_tokens", reply.alias("response"),
        F.when(F.size("query_tokens") > 0, tokens).otherwise(
            F.array().cast("array<string>")).alias("raw_tokens"),
        F.lit(strategy).alias("strategy"), beam.alias("beam_size"), "in_scope", "oov_ratio",
        "n_anchors", "unknown_words", "avg_logprob", "reason")


def batch_summary(answers: DataFrame) -> DataFrame:
    return answers.agg(
        F.count_if(~F.col("in_scope")).alias("out_of_scope"),
        F.floor(F.avg(text.word_count(F.col("response")))).alias("mean_words"))
