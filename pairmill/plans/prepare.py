"""Raw pairs -> prepared splits, vocabulary, lexicon and statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions import text
from pairmill.functions.basics import compute_once
from pairmill.operators import filters, gate, slots, split, stats, vocab
from pairmill.settings import Settings
from pairmill.sources.staging import stage


def usable_pairs(raw: DataFrame) -> DataFrame:
    return filters.drop_automated(filters.drop_null_pairs(raw))


def clean_pairs(pairs: DataFrame, mapping: DataFrame | dict | None = None,
                settings: Settings = Settings()) -> DataFrame:
    """Add ``query_clean`` and ``response_clean``.

    ``mapping`` is a small constant map or a staged slot table; a table beyond
    the constant's bound goes through a join.
    """
    if isinstance(mapping, DataFrame):
        if not slots.fits_in_plan(mapping, settings):
            work = compute_once(pairs, _q=text.before_slots(F.col("query")),
                                _r=text.before_slots(F.col("response")))
            work = slots.fill_columns(work, ["_q", "_r"], mapping, settings=settings)
            tokens = text.query_tokens(text.after_slots(F.col("_q"), chat=True))
            return compute_once(work, query_clean=F.array_join(tokens, " "),
                                response_clean=text.after_slots(F.col("_r"))).drop("_q", "_r")
        mapping = slots.small_map(mapping, settings)
    tokens = text.prepare_query(F.col("query"), mapping)
    return compute_once(pairs, query_clean=F.array_join(tokens, " "),
                        response_clean=text.clean_text(F.col("response"), mapping))


def asked_queries(queries: DataFrame, mapping: DataFrame | dict | None, key: str | Sequence[str],
                  settings: Settings = Settings()) -> DataFrame:
    """Add ``query_tokens`` to queries alone; ``mapping`` as in ``clean_pairs``."""
    if isinstance(mapping, DataFrame):
        if not slots.fits_in_plan(mapping, settings):
            work = compute_once(queries, _q=text.before_slots(F.col("query")))
            work = slots.fill_columns(work, ["_q"], mapping, key, settings)
            return compute_once(work, query_tokens=text.query_tokens(
                text.after_slots(F.col("_q"), chat=True))).drop("_q")
        mapping = slots.small_map(mapping, settings)
    return compute_once(queries, query_tokens=text.prepare_query(F.col("query"), mapping))


def kept_pairs(cleaned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Length filter, first copies, reply cap.

    Copies share their length verdict, so filtering first keeps the same rows
    and shrinks both shuffles.
    """
    fine = cleaned.where(filters.proper_length(settings=settings))
    return _capped_first_copies(fine, settings)


def _capped_first_copies(fine: DataFrame, settings: Settings) -> DataFrame:
    return filters.cap_replies(filters.drop_repeated_pairs(fine), n=settings.replies_per_query)


def kept_clean_pairs(pairs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``kept_pairs`` of ``clean_pairs`` for pairs without a slot map, with the same rows.

    Most pairs of long texts fall to the length of the query. So queries that are sure to be too long are
    not cleaned at all, and replies only where the query has proper length.
    """
    work = pairs.where(~text.surely_longer(F.col("query"), settings.max_query_words))
    work = compute_once(work, query_clean=F.array_join(text.prepare_query(F.col("query")), " "))
    work = work.where(filters.proper_query_length(settings=settings))
    work = compute_once(work, response_clean=text.clean_text(F.col("response")))
    return _capped_first_copies(work.where(filters.proper_length(settings=settings)), settings)


def tokenised_pairs(kept: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Token arrays, sentence-aware truncation and the split column."""
    full = compute_once(kept, _reply=text.tokenize(F.col("response_clean")))
    return full.select(
        *[c for c in kept.columns if c not in ("query", "response")],
        F.split("query_clean", " ", -1).alias("query_tokens"),
        text.truncate_at_sentence(F.col("_reply"), settings.reply_budget).alias("response_tokens"),
        (F.size("_reply") > settings.reply_budget).alias("truncated"),
        split.split_of(F.col("query_clean"), settings.split_ratios, settings.seed).alias("split"))


@dataclass(frozen=True)
class Prepared:
    pairs: DataFrame
    slot_map: DataFrame
    vocab: DataFrame
    lexicon: DataFrame
    stats: DataFrame


def prepare(raw: DataFrame, settings: Settings = Settings()) -> Prepared:
    """The whole preparation; every barrier is a staged table read many times."""
    usable, source = stats.staged_usable(raw)
    mapping = stage(slots.slot_map(usable, ["query", "response"], settings.slot_min_freq),
                    "slots")
    cleaned = stage(clean_pairs(usable, mapping, settings), "cleaned")
    pairs = stage(tokenised_pairs(kept_pairs(cleaned, settings), settings), "prepared", ["split"])
    counts = stage(vocab.sided_counts(pairs), "counts")

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("token").agg(F.sum("n").alias("n"))
    train = counts.where(F.col("split") == "train")
    words = stage(vocab.vocab_from_counts(summed(train), settings.min_freq), "vocab")
    lexicon = stage(gate.lexicon_from_counts(
        summed(train.where(F.col("side") == "query")), settings.scope_min_freq,
        settings.anchor_top_k), "lexicon")
    summary = stats.one_row(
        source, slots.slot_types(mapping),
        stats.dedupe_counts(cleaned, settings), stats.token_stats(pairs),
        words.agg((F.count("*") + 4).alias("vocab_size")),
        vocab.coverage(summed(counts), words).select(
            F.round("coverage", 4).alias("token_coverage")),
        lexicon.agg(F.count_if("known").alias("scope_query_vocab")))
    return Prepared(pairs, mapping, words, lexicon, summary)
