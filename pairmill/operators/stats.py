"""Corpus statistics as distributed aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pairmill.functions.basics import compute_once
from pairmill.functions.text import word_count
from pairmill.operators.filters import automated_pair, proper_length
from pairmill.settings import Settings
from pairmill.sources.staging import stage


def row_count_check(df: DataFrame, expected: int) -> DataFrame:
    return (df.agg(F.count("*").alias("actual"))
            .select(F.lit(expected).cast("bigint").alias("expected"), "actual",
                    (F.col("actual") == expected).alias("ok")))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    counts = (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count("*").alias("n")).orderBy(F.desc("n"), column))
    return counts.limit(top) if top else counts


def distinct_values(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(f"n_{c}") for c in columns])


def length_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Word-count summary per text column, one scan.

    Exact percentiles keep one counter per distinct length, not per row.
    """
    sides = F.array(*[F.struct(F.lit(c).alias("side"), word_count(F.col(c)).alias("w"))
                      for c in columns])
    def pct(q: float) -> Column:
        return F.round(F.percentile("w", F.lit(q)), 2)
    return (df.select(F.inline(sides)).where(F.col("w") >= 0).groupBy("side").agg(
        F.count("*").alias("count"), F.round(F.avg("w"), 2).alias("mean"),
        F.round(F.stddev_samp("w"), 2).alias("std"),
        F.min("w").cast("double").alias("min"), pct(.25).alias("p25"), pct(.5).alias("p50"),
        pct(.75).alias("p75"), F.max("w").cast("double").alias("max")))


def staged_usable(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The usable pairs of ``raw`` as a staged table, and one row with how many pairs there were and why the
    others went. Reads ``raw`` once: the counts are observed while the table is written."""
    null = F.col("query").isNull() | F.col("response").isNull()
    seen = Observation()
    names = ("raw_pairs", "dropped_null", "dropped_automated")
    tagged = compute_once(raw, _why=F.when(null, "null").when(automated_pair(), "automated")).observe(
        seen, F.count(F.lit(1)).alias(names[0]), F.count_if(F.col("_why") == "null").alias(names[1]),
        F.count_if(F.col("_why") == "automated").alias(names[2]))
    usable = stage(tagged.where("_why is null").drop("_why"), "usable")
    counts = seen.get
    return usable, raw.sparkSession.createDataFrame([tuple(counts[n] for n in names)],
                                                    ", ".join(f"{n} bigint" for n in names))


def dedupe_counts(cleaned: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows lost to repeats, length and the reply cap, without tagging rows.

    Two nested aggregates give all counts; both sum before they shuffle.
    """
    pairs = (cleaned.groupBy("query_clean", "response_clean").agg(F.count("*").alias("n"))
             .withColumn("fine", proper_length(settings=settings)))
    queries = pairs.groupBy("query_clean").agg(
        F.sum(F.col("n") - 1).alias("repeats"), F.count_if(~F.col("fine")).alias("short"),
        F.count_if("fine").alias("fine"))
    cap = settings.replies_per_query
    return queries.agg(
        F.sum("repeats").alias("dropped_duplicate_pairs"),
        F.sum("short").alias("dropped_too_short"),
        F.sum(F.greatest(F.col("fine") - cap, F.lit(0))).alias("dropped_over_represented"),
        F.sum(F.least("fine", F.lit(cap))).alias("pairs_after_cleaning"))


def token_stats(prepared: DataFrame) -> DataFrame:
    def of(split: str) -> Column:
        return F.count_if(F.col("split") == split).alias(f"{split}_size")
    return prepared.agg(
        F.count_if("truncated").alias("truncated_responses"),
        F.round(F.avg(F.size("query_tokens")), 2).alias("mean_query_tokens"),
        F.round(F.avg(F.size("response_tokens")), 2).alias("mean_response_tokens"),
        of("train"), of("valid"), of("test"))


def one_row(*parts: DataFrame) -> DataFrame:
    """Put one-row tables side by side (each has exactly one row)."""
    keyed = [p.withColumn("_one", F.lit(1)) for p in parts]
    return reduce(lambda a, b: a.join(b, "_one"), keyed).drop("_one")
