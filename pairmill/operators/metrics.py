"""Corpus metrics as distributed aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmill.functions import scoring
from pairmill.functions.arrays import ngram_keys
from pairmill.functions.basics import compute_once
from pairmill.functions.text import prefix, trim_space, word_count, words
from pairmill.sources.staging import stage


def align(hypotheses: DataFrame, references: DataFrame,
          key: str | list[str] = "row_id") -> DataFrame:
    return hypotheses.join(references, key)


def row_scores(df: DataFrame, hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """Per-row match counts of every metric.

    Clipped matches are counted inside the row, so n-grams are never shuffled.
    """
    h, r = F.col(hyp), F.col(ref)
    return compute_once(
        df, bleu_lower=scoring.bleu_overlap(h, r, True),
        bleu_cased=scoring.bleu_overlap(h, r, False), chrf=scoring.chrf_overlap(h, r),
        rouge=scoring.rouge_overlap(h, r))


def _summed(struct: str, orders: range) -> list:
    return [F.sum(f"{struct}.{side}{n}").alias(f"{side}{n}")
            for n in orders for side in ("m", "h", "r")]


def corpus_bleu(scores: DataFrame, by: list[str]) -> DataFrame:
    totals = scores.groupBy(*by).agg(F.struct(*_summed("bleu_lower", range(1, 5))).alias("s"))
    p = scoring.bleu_precisions(F.col("s"))
    return totals.select(*by, scoring.bleu(F.col("s"), False).alias("bleu"),
                         *[F.get(p, F.lit(i)).alias(f"p{i + 1}") for i in range(4)])


def corpus_chrf(scores: DataFrame, by: list[str]) -> DataFrame:
    s = F.col("chrf")
    # An order the reference lacks does not count against the hypothesis.
    sums = []
    for n in range(1, 7):
        has_ref = s[f"r{n}"] > 0
        sums += [F.sum(s[f"m{n}"]).alias(f"m{n}"), F.sum(s[f"r{n}"]).alias(f"r{n}"),
                 F.sum(F.when(has_ref, s[f"h{n}"]).otherwise(0)).alias(f"h{n}")]
    return (scores.groupBy(*by).agg(F.struct(*sums).alias("s"))
            .select(*by, scoring.chrf(F.col("s")).alias("chrf")))


def mean_sentence_bleu(scores: DataFrame, by: list[str]) -> DataFrame:
    return scores.groupBy(*by).agg(
        F.avg(scoring.bleu(F.col("bleu_cased"), True)).alias("sentence_bleu"))


def mean_rouge_n(scores: DataFrame, by: list[str]) -> DataFrame:
    s = F.col("rouge")
    return scores.groupBy(*by).agg(*[
        F.avg(scoring.f_measure(s[f"m{n}"], s[f"h{n}"], s[f"r{n}"])).alias(f"rouge{n}")
        for n in (1, 2)])


def rouge_l(df: DataFrame, hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    """Per-row ROUGE-L F1 over whole texts."""
    both = compute_once(df, _h=scoring.tokens_rouge(F.col(hyp)),
                        _r=scoring.tokens_rouge(F.col(ref)))
    lcs = both.withColumn("_l", scoring.lcs_length("_h", "_r"))
    return lcs.withColumn("rougeL", scoring.f_measure(
        F.col("_l"), F.size("_h"), F.size("_r"))).drop("_h", "_r", "_l")


def distinct_n(df: DataFrame, tokens: str, n: int, by: list[str] | None = None) -> DataFrame:
    """Distinct n-grams / n-grams; equal grams are summed before the shuffle."""
    by = by or []
    grams = (df.select(*by, F.explode(ngram_keys(F.col(tokens), n)).alias("gram"))
             .groupBy(*by, "gram").agg(F.count("*").alias("n")))
    share = F.coalesce(F.try_divide(F.count("*"), F.sum("n")), F.lit(0.0))
    return grams.groupBy(*by).agg(share.alias(f"distinct_{n}"))


def reply_counts(df: DataFrame, reply: str, by: list[str] | None = None) -> DataFrame:
    return (df.groupBy(*(by or []), F.lower(trim_space(F.col(reply))).alias("reply"))
            .agg(F.count("*").alias("n")))


def genericity(df: DataFrame, reply: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)) / F.sum("n")
    return reply_counts(df, reply, by).groupBy(*by).agg(
        F.count("*").alias("unique_responses"),
        F.coalesce(F.round(repeated, 4), F.lit(0.0)).alias("repeated_response_rate"))


def most_common(df: DataFrame, reply: str, top_k: int = 5, by: list[str] | None = None) -> DataFrame:
    """The most frequent replies, of each group by ``by`` with their ``rank``. Each task passes on
    ``top_k`` rows a group at most, so a large group is not sorted in one task."""
    shown = [F.col("n").alias("count"), prefix(F.col("reply")).alias("response")]
    if not by:
        return reply_counts(df, reply).orderBy(F.desc("n"), "reply").limit(top_k).select(*shown)
    order = Window.partitionBy(*by).orderBy(F.desc("n"), "reply")
    return (reply_counts(df, reply, by).withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= top_k).select(*by, "rank", *shown))


def mean_lengths(df: DataFrame, by: list[str], hyp: str = "hyp", ref: str = "ref") -> DataFrame:
    return df.groupBy(*by).agg(
        F.avg(word_count(F.col(hyp))).alias("mean_hypothesis_tokens"),
        F.avg(word_count(F.col(ref))).alias("mean_reference_tokens"))


def narrow(df: DataFrame, by: str) -> DataFrame:
    """One row per metric: (by, metric, value)."""
    names = [c for c in df.columns if c != by]
    rows = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
                     for c in names])
    return df.select(by, F.inline(rows))


# digits each reported metric is rounded to
_DIGITS = {"bleu": 3, "p1": 2, "p2": 2, "p3": 2, "p4": 2, "sentence_bleu": 3, "chrf": 3,
           "mean_hypothesis_tokens": 2, "mean_reference_tokens": 2}


def report(df: DataFrame, scores: DataFrame | None = None, by: str = "strategy",
           with_rouge_l: bool = True) -> DataFrame:
    """All metrics per strategy as (strategy, metric, value)."""
    if scores is None:
        scores = stage(row_scores(df), "row-scores")  # four of the parts start from them
    tokens = df.select(by, words(F.col("hyp")).alias("tokens"))
    parts = [corpus_bleu(scores, [by]), mean_sentence_bleu(scores, [by]),
             corpus_chrf(scores, [by]), mean_rouge_n(scores, [by]),
             distinct_n(tokens, "tokens", 1, [by]), distinct_n(tokens, "tokens", 2, [by]),
             genericity(df, "hyp", [by]), mean_lengths(df, [by])]
    if with_rouge_l:
        parts.append(rouge_l(df).groupBy(by).agg(F.avg("rougeL").alias("rougeL")))
    rows = reduce(DataFrame.unionByName, [narrow(p, by) for p in parts])
    value = F.col("value")
    rounded = F.round(value, 4)
    for metric, digits in _DIGITS.items():
        rounded = F.when(F.col("metric") == metric, F.round(value, digits)).otherwise(rounded)
    return rows.select(by, "metric", rounded.alias("value"))
