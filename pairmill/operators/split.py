"""Leakage-free splits by key hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.settings import Settings
from pairmill.sources.staging import stage

_DIGITS = 3          # hex digits per selection step: 4,096 buckets


def key_digest(key: Column, seed: int = Settings.seed) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def key_fraction(key: Column, seed: int = Settings.seed) -> Column:
    """Uniform number in [0, 1) that depends on the key and the seed only."""
    head = F.conv(F.substring(key_digest(key, seed), 1, 8), 16, 10)
    return head.cast("double") / F.lit(float(1 << 32))


def split_of(key: Column, ratios=Settings.split_ratios, seed: int = Settings.seed) -> Column:
    """Stateless split: no shuffle, and stable when rows are added."""
    u = key_fraction(key, seed)
    return (F.when(u < ratios[0], "train").when(u < ratios[0] + ratios[1], "valid")
            .otherwise("test"))


def _nth_digest(digests: DataFrame, n: int) -> str:
    """The n-th smallest digest (from 0), by radix selection.

    Each step counts rows per next three hex digits, so at most 4,096 counts
    reach the driver and no step sorts the table.
    """
    prefix = ""
    while True:
        inside = digests.where(F.col("d").startswith(prefix)) if prefix else digests
        width = len(prefix) + _DIGITS
        counts = (inside.groupBy(F.substring("d", 1, width).alias("head"))
                  .agg(F.count("*").alias("n")).collect())
        for head, count in sorted((r.head, r.n) for r in counts):
            if n < count:
                break
            n -= count
        prefix = head
        if count <= 10_000 or len(prefix) + _DIGITS > 32:
            rows = digests.where(F.col("d").startswith(prefix)).orderBy("d").limit(n + 1).collect()
            return rows[-1].d


def exact_split_of(df: DataFrame, key: str, ratios=Settings.split_ratios,
                   seed: int = Settings.seed) -> Column:
    """Split with exact sizes over the distinct keys.

    Keys are ranked by digest. Only the two digests at the cuts are needed, and
    every row then compares its own digest, so no join back to the rows.
    """
    digests = stage(df.select(F.col(key).alias("k")).groupBy("k").agg(F.lit(1).alias("one"))
                    .select(key_digest(F.col("k"), seed).alias("d")), "digests")
    total = digests.count()
    train_end = int(ratios[0] * total)
    valid_end = train_end + int(ratios[1] * total)
    digest = key_digest(F.col(key), seed)
    out = F.when(F.lit(False), F.lit(""))
    if train_end < total:
        out = out.when(digest < _nth_digest(digests, train_end), "train")
    else:
        out = out.when(F.lit(True), "train")
    if train_end < valid_end < total:
        out = out.when(digest < _nth_digest(digests, valid_end), "valid")
    elif valid_end >= total:
        out = out.when(F.lit(True), "valid")
    return out.otherwise("test")


def group_split(df: DataFrame, key: str = "query_clean", ratios=Settings.split_ratios,
                seed: int = Settings.seed, exact: bool = False) -> DataFrame:
    """Every distinct key goes to exactly one split."""
    rule = exact_split_of(df, key, ratios, seed) if exact else split_of(F.col(key), ratios, seed)
    return df.withColumn("split", rule)


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def shared_keys(left: DataFrame, right: DataFrame, key: str = "query_clean") -> DataFrame:
    """Distinct keys found on both sides; must be 0 for train and test."""
    # Distinct before the join, so that a key with many rows arrives once.
    return (left.select(key).distinct().join(right.select(key).distinct(), key)
            .agg(F.count("*").alias("shared")))
