"""Count-based reply model: interpolated bigrams with add-one unigrams.

A stand-in for a drafter's log-probabilities. Its numbers are not comparable
with those of a neural model, and the gate's log-probability bound has to be set
again from a quantile of validation replies.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.operators.lookup import lookup
from pairmill.settings import Settings
from pairmill.sources.staging import stage


def bigrams(tokens: Column) -> Column:
    """struct(pos, v, w) for <sos> t1 ... tn <eos>."""
    return F.transform(
        F.concat(tokens, F.array(F.lit("<eos>"))),
        lambda w, i: F.struct(i.alias("pos"), F.when(i == 0, "<sos>").otherwise(
            F.get(tokens, i - 1)).alias("v"), w.alias("w")))


def gram_key(v: str = "v", w: str = "w") -> Column:
    return F.concat_ws("\x01", v, w)


@dataclass(frozen=True)
class ReplyModel:
    """Staged count tables plus the two scalars of the unigram term."""

    pairs: DataFrame        # gram, n, n_context
    contexts: DataFrame     # v, n_context
    words: DataFrame        # w, n
    total: int
    types: int
    weight: float


def train_reply_model(train: DataFrame, tokens_col: str = "response_tokens",
                      weight: float = Settings.lm_weight) -> ReplyModel:
    counts = stage(train.select(F.inline(bigrams(F.col(tokens_col))))
                   .groupBy("v", "w").agg(F.count("*").alias("n")), "bigrams")
    contexts = stage(counts.groupBy("v").agg(F.sum("n").alias("n_context")), "contexts")
    words = stage(counts.groupBy("w").agg(F.sum("n").alias("n")), "words")
    size = words.agg(F.sum("n").alias("total"), F.count("*").alias("types")).first()
    return ReplyModel(counts.select(gram_key().alias("gram"), "n"), contexts, words,
                      size["total"] or 0, size["types"] + 1, weight)


def _logprob(model: ReplyModel) -> Column:
    """ln p from n (pair), n_context (v) and n_word (w); nulls mean never seen."""
    unigram = (F.coalesce("n_word", F.lit(0)) + 1) / F.lit(float(model.total + model.types))
    pair = F.coalesce("n_pair", F.lit(0)) / F.col("n_context")
    return F.log(F.when(F.col("n_context").isNull(), unigram)
                 .otherwise(model.weight * pair + (1 - model.weight) * unigram))


def score_bigrams(grams: DataFrame, model: ReplyModel, settings: Settings = Settings(),
                  spread_keys: bool = False) -> DataFrame:
    """Add ``logprob`` to rows with columns v and w."""
    out = lookup(grams.withColumn("gram", gram_key()),
                 model.pairs.withColumnRenamed("n", "n_pair"), "gram", settings, spread_keys)
    out = lookup(out, model.contexts, "v", settings)
    out = lookup(out, model.words.withColumnRenamed("n", "n_word"), "w", settings)
    return out.withColumn("logprob", _logprob(model)).select(*grams.columns, "logprob")


def reply_logprobs(df: DataFrame, model: ReplyModel, tokens_col: str = "response_tokens",
                   key: str = "row_id", settings: Settings = Settings()) -> DataFrame:
    """(key, pos, w, logprob): one row per predicted token, <eos> included."""
    grams = df.select(key, F.inline(bigrams(F.col(tokens_col))))
    return score_bigrams(grams, model, settings).drop("v")


def mean_reply_logprob(df: DataFrame, model: ReplyModel, tokens_col: str = "response_tokens",
                       key: str = "row_id", settings: Settings = Settings()) -> DataFrame:
    return (reply_logprobs(df, model, tokens_col, key, settings)
            .groupBy(key).agg(F.avg("logprob").alias("avg_logprob")))


def perplexity(token_logprobs: DataFrame, by: list[str] | None = None,
               weight: str | None = None) -> DataFrame:
    """exp(-sum(logprob) / tokens); ``weight`` counts pre-aggregated rows."""
    n = F.col(weight) if weight else F.lit(1)
    return token_logprobs.groupBy(*(by or [])).agg(
        F.exp(-F.sum(F.col("logprob") * n) / F.greatest(F.sum(n), F.lit(1))).alias("perplexity"),
        F.sum(n).cast("bigint").alias("n_tokens"))


def corpus_perplexity(df: DataFrame, model: ReplyModel, by: list[str],
                      tokens_col: str = "response_tokens",
                      settings: Settings = Settings()) -> DataFrame:
    """Perplexity per group. Equal bigrams are summed before any lookup, so the
    joins see dictionary-sized tables however large the corpus is."""
    grams = (df.select(*by, F.inline(bigrams(F.col(tokens_col)))).drop("pos")
             .groupBy(*by, "v", "w").agg(F.count("*").alias("times")))
    return perplexity(score_bigrams(grams, model, settings, spread_keys=True), by, "times")
