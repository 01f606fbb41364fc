"""Scope lexicon and the out-of-scope gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmill.functions import fixed
from pairmill.functions.basics import empty_strings
from pairmill.functions.text import content_words
from pairmill.operators.lookup import lookup
from pairmill.operators.quantiles import exact_quantile, sketched_quantile
from pairmill.settings import Settings

EMPTY_REASON = "empty query after cleaning"


def lexicon_from_counts(counts: DataFrame, min_freq: int = Settings.scope_min_freq,
                        top_k: int = Settings.anchor_top_k) -> DataFrame:
    """(token, n, known, anchor_rank) from query-side training counts."""
    content = (F.col("token").rlike(fixed.CONTENT_WORD)
               & ~F.col("token").isin(fixed.STOPWORDS))
    order = [F.desc("n"), F.asc("token")]
    # top_k rows, so the ranking window is a bounded single task.
    anchors = (counts.where(content).orderBy(*order).limit(top_k)
               .select("token", F.row_number().over(Window.orderBy(*order)).alias("anchor_rank")))
    return (counts.join(F.broadcast(anchors), "token", "left")
            .select("token", "n", (F.col("n") >= min_freq).alias("known"), "anchor_rank")
            .where(F.col("known") | F.col("anchor_rank").isNotNull()))


def scope_lexicon(train: DataFrame, tokens_col: str = "query_tokens",
                  min_freq: int = Settings.scope_min_freq,
                  top_k: int = Settings.anchor_top_k) -> DataFrame:
    counts = (train.select(F.explode(tokens_col).alias("token"))
              .groupBy("token").agg(F.count("*").alias("n")))
    return lexicon_from_counts(counts, min_freq, top_k)


@dataclass(frozen=True)
class SmallLexicon:
    """A lexicon small enough to be a constant set inside the plan."""

    known: tuple[str, ...]
    anchors: tuple[str, ...]


def small_lexicon(lexicon: DataFrame, entries: int = 5_000) -> SmallLexicon | None:
    """The alphabetic part of a lexicon as constants, or None when too large."""
    rows = (lexicon.where(F.col("token").rlike(fixed.CONTENT_WORD)
                          & (F.length("token") <= 200))
            .select("token", "known", "anchor_rank").limit(entries + 1).collect())
    oversized = lexicon.where(F.length("token") > 200).limit(1).count()
    if len(rows) > entries or oversized:
        return None
    return SmallLexicon(tuple(sorted(r.token for r in rows if r.known)),
                        tuple(sorted(r.token for r in rows if r.anchor_rank is not None)))


def _filtered(values: tuple[str, ...], keep: bool) -> Column:
    """Words of ``_content`` inside or outside a constant set (a hash lookup).

    Written as text since one Column object per word would be slow to build;
    the words are letters only.
    """
    if not values:
        return F.slice("_content", 1, 0) if keep else F.col("_content")
    words = ", ".join(f"'{v}'" for v in values)
    return F.expr(f"filter(_content, w -> w {'' if keep else 'not '}in ({words}))")


def _ratio(unknown: Column, content: Column, tokens: Column) -> Column:
    has_slot = F.exists(tokens, lambda t: t.startswith("<ph_"))
    return (F.when(content > 0, unknown / content)
            .when(has_slot, 0.0).otherwise(1.0))


def scope_signals(df: DataFrame, lexicon: DataFrame | SmallLexicon,
                  tokens_col: str = "query_tokens", key: str | Sequence[str] = "row_id",
                  settings: Settings = Settings(), always_join: bool = False) -> DataFrame:
    """Add ``unknown`` (in order, repeats kept), ``oov`` and ``n_anchors``. ``key`` is a column, or
    columns, that tell the rows apart.

    A small lexicon becomes a hash set inside the plan: no shuffle at all. A
    large one is joined to the exploded content words.
    """
    small = lexicon if isinstance(lexicon, SmallLexicon) else (
        None if always_join else small_lexicon(lexicon))
    content = content_words(F.col(tokens_col))
    if small is not None:
        df = df.withColumn("_content", content)
        unknown = _filtered(small.known, keep=False)
        anchors = _filtered(small.anchors, keep=True)
        return (df.withColumn("unknown", unknown)
                .withColumn("oov", _ratio(F.size("unknown"), F.size("_content"),
                                          F.col(tokens_col)))
                .withColumn("n_anchors", F.size(anchors)).drop("_content"))

    keys = [key] if isinstance(key, str) else list(key)
    exploded = df.select(*keys, F.posexplode(content).alias("pos", "token"))
    found = lookup(exploded, lexicon.select("token", "known", "anchor_rank"), "token", settings)
    missing = F.when(~F.coalesce("known", F.lit(False)), F.struct("pos", "token"))
    per_row = found.groupBy(*keys).agg(
        F.array_sort(F.collect_list(missing)).alias("_u"), F.count("*").alias("_words"),
        F.count_if(F.col("anchor_rank").isNotNull()).cast("int").alias("_anchors"))
    unknown = F.coalesce(F.col("_u.token"), empty_strings())
    return (df.join(per_row, keys, "left").withColumn("unknown", unknown)
            .withColumn("oov", _ratio(F.size("unknown"), F.coalesce("_words", F.lit(0)),
                                      F.col(tokens_col)))
            .withColumn("n_anchors", F.coalesce("_anchors", F.lit(0)))
            .drop("_u", "_words", "_anchors"))


def in_scope(oov: Column, logprob: Column, settings: Settings = Settings()) -> Column:
    """Both bounds are inclusive."""
    return (oov <= settings.max_oov) & (logprob >= settings.min_logprob)


def logprob_cutoff(replies: DataFrame, share: float = 0.05, column: str = "avg_logprob",
                   exact: bool = False) -> float | None:
    """The gate's lower bound: the mean log-probability that ``share`` of known good replies (of the
    validation split) do not exceed, to six digits. By a sketch, whose rank errs by a hundredth of
    the rows at most, or ``exact``."""
    found = (exact_quantile if exact else sketched_quantile)(replies, column, share)
    return None if found is None else round(found, 6)


def reason_text(oov: Column, logprob: Column, n_anchors: Column, unknown: Column,
                settings: Settings = Settings()) -> Column:
    named = F.array_join(F.slice(unknown, 1, 5), ", ")
    named = F.when(named == "", "none").otherwise(named)
    percent = F.bround(oov * 100, 0).cast("int").cast("string")
    return (F.when(oov > settings.max_oov, F.concat(
                percent, F.lit("% of the meaningful words in this query never appear in "
                               "the support corpus ("), named, F.lit(")")))
            .when(logprob < settings.min_logprob, F.format_string(
                "the decoder is not confident (mean log-probability %.2f)", logprob))
            .otherwise(F.concat(F.lit("in scope ("), n_anchors.cast("string"),
                                F.lit(" known support term"),
                                F.when(n_anchors == 1, "").otherwise("s"), F.lit(")"))))


def verdict(df: DataFrame, logprob: str = "logprob", tokens_col: str = "query_tokens",
            settings: Settings = Settings()) -> DataFrame:
    """Turn the signals into the reported fields, with the empty-query guard."""
    empty = F.size(tokens_col) == 0
    lp = F.col(logprob)
    fields = {
        "in_scope": F.when(empty, False).otherwise(in_scope(F.col("oov"), lp, settings)),
        "oov_ratio": F.when(empty, 1.0).otherwise(F.bround("oov", 3)),
        "n_anchors": F.col("n_anchors"),
        "unknown_words": F.slice("unknown", 1, 8),
        "avg_logprob": F.when(empty, 0.0).otherwise(F.bround(lp, 3)),
        "reason": F.when(empty, EMPTY_REASON).otherwise(
            reason_text(F.col("oov"), lp, F.col("n_anchors"), F.col("unknown"), settings)),
    }
    keep = [c for c in df.columns if c not in ("oov", "unknown", "n_anchors", logprob)]
    return df.select(*keep, *[c.alias(name) for name, c in fields.items()])


def scope_gate(df: DataFrame, lexicon: DataFrame | SmallLexicon, logprob: str = "logprob",
               tokens_col: str = "query_tokens", key: str | Sequence[str] = "row_id",
               settings: Settings = Settings()) -> DataFrame:
    return verdict(scope_signals(df, lexicon, tokens_col, key, settings),
                   logprob, tokens_col, settings)


def substitute_refusal(reply: Column, scoped: Column, gate: bool = True) -> Column:
    return F.when(scoped, reply).otherwise(fixed.REFUSAL) if gate else reply


def gate_rates(answers: DataFrame, domain: str = "in_domain") -> DataFrame:
    """Share of in-domain queries accepted and of others refused."""
    inside, ok = F.col(domain), F.col("in_scope")
    def share(hit: Column, of: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(F.count_if(of & hit), F.count_if(of)),
                                  F.lit(0.0)), 4)
    return answers.agg(share(ok, inside).alias("in_domain_accepted"),
                       share(~ok, ~inside).alias("out_of_domain_rejected"))
