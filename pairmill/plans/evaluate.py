"""Held-out evaluation: metrics, perplexity and gate behaviour in one table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.operators import gate, lm, metrics
from pairmill.sources.staging import stage


def top_replies(aligned: DataFrame, top_k: int = 5) -> DataFrame:
    """(strategy, rank, count, response): what each strategy answers most often."""
    return metrics.most_common(aligned, "hyp", top_k, ["strategy"])


def evaluate(aligned: DataFrame, prepared: DataFrame, model: lm.ReplyModel,
             gated: DataFrame | None = None) -> DataFrame:
    """(strategy, metric, value).

    ``aligned`` has strategy, row_id, hyp and ref; ``prepared`` has split and
    response_tokens; ``gated`` has in_domain and in_scope.
    """
    aligned = stage(aligned, "aligned")
    scores = stage(metrics.row_scores(aligned).drop("hyp", "ref"), "scores")
    out = metrics.report(aligned, scores)
    held_out = prepared.where(F.col("split").isin("valid", "test"))
    ppl = lm.corpus_perplexity(held_out, model, ["split"]).select(
        F.lit("all").alias("strategy"), F.concat(F.lit("perplexity_"), "split").alias("metric"),
        F.round("perplexity", 3).alias("value"))
    out = out.unionByName(ppl)
    if gated is not None:
        rates = gate.gate_rates(gated).withColumn("strategy", F.lit("all"))
        out = out.unionByName(metrics.narrow(rates, "strategy"))
    return out
