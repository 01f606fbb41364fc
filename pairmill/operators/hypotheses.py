"""Candidate replies: reranking, cutting at the end mark, mean log-probability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmill.operators.lookup import lookup
from pairmill.settings import EOS, Settings
from pairmill.sources.staging import stage


def best_hypothesis(hypotheses: DataFrame, alpha: float = Settings.length_penalty,
                    by: tuple[str, ...] = ("query_id", "strategy")) -> DataFrame:
    """Per query the best ``logprob_sum / max(len, 1)**alpha``."""
    length = F.greatest("len", F.lit(1))
    score = F.col("logprob_sum") / F.pow(length.cast("double"), F.lit(alpha))
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc("hyp_id"))
    return (hypotheses.withColumn("score", score)
            .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 1)
            .select(*hypotheses.columns, "score",
                    (F.col("logprob_sum") / length).alias("avg_logprob")))


def cut_at_eos(token_logprobs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(query_id, n_tokens, avg_logprob) of per-step rows up to the end mark.

    The mean includes the step that produced the mark; the tokens do not.
    """
    ends = token_logprobs.groupBy("query_id").agg(
        F.min(F.when(F.col("token_id") == EOS, F.col("pos"))).alias("_end"))
    # One row per query; the lookup keeps a query with endless steps spread out.
    ends = stage(ends.where(F.col("_end").isNotNull()), "ends")
    live = (lookup(token_logprobs, ends, "query_id", settings)
            .where(F.col("_end").isNull() | (F.col("pos") <= F.col("_end"))))
    steps = F.greatest(F.count("*"), F.lit(1))
    return live.groupBy("query_id").agg(
        F.count_if(F.col("token_id") != EOS).alias("n_tokens"),
        (F.sum("logprob") / steps).alias("avg_logprob"))


def cut_arrays_at_eos(ids, logprobs):
    """The same for a row that holds its steps as arrays: struct(ids, avg_logprob)."""
    end = F.array_position(ids, F.lit(EOS)).cast("int")
    steps = F.when(end > 0, end).otherwise(F.size(ids))
    total = F.aggregate(F.slice(logprobs, F.lit(1), steps), F.lit(0.0), lambda a, x: a + x)
    kept = F.when(end > 0, F.slice(ids, F.lit(1), end - 1)).otherwise(ids)
    return F.struct(kept.alias("ids"),
                    (total / F.greatest(steps, F.lit(1))).alias("avg_logprob"))
