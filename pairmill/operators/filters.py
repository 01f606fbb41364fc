"""Row filters, first-copy dedupe and the reply cap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmill.functions import text
from pairmill.functions.basics import compute_once
from pairmill.settings import Settings


def first_rows(df: DataFrame, n: int, order: str = "row_id") -> DataFrame:
    return df.orderBy(order).limit(n)


def drop_null_pairs(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["query", "response"])


def automated_pair() -> Column:
    return text.is_automated(F.col("query")) | text.is_automated(F.col("response"))


def drop_automated(df: DataFrame) -> DataFrame:
    # Behind the generator the test stays where it is written, after any spread.
    return compute_once(df, _automated=automated_pair()).where(~F.col("_automated")).drop("_automated")


def _at_most(column: str, n: int) -> Column:
    """Cleaned text holds single spaces only, so the place of the n-th one tells enough."""
    c = F.col(column)
    return c == (F.substring_index(c, " ", n) if n > 0 else "")


def proper_query_length(query: str = "query_clean", settings: Settings = Settings()) -> Column:
    return ~_at_most(query, settings.min_query_words - 1) & _at_most(query, settings.max_query_words)


def proper_length(query: str = "query_clean", reply: str = "response_clean",
                  settings: Settings = Settings()) -> Column:
    return proper_query_length(query, settings) & ~_at_most(reply, settings.min_reply_words - 1)


def _first(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    # row_number() <= n lets Spark keep only n rows per key before the shuffle
    # (WindowGroupLimit), so a hot key sends n rows per map task, not all.
    w = Window.partitionBy(*keys).orderBy(order)
    return (df.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") <= n).drop("_rn"))


def drop_repeated_pairs(df: DataFrame, query: str = "query_clean",
                        reply: str = "response_clean", order: str = "row_id") -> DataFrame:
    """Keep the first of each (query, reply)."""
    return _first(df, [query, reply], order, 1)


def cap_replies(df: DataFrame, query: str = "query_clean", order: str = "row_id",
                n: int = Settings.replies_per_query) -> DataFrame:
    """Keep the first ``n`` pairs of each query."""
    return _first(df, [query], order, n)


def seeded_sample(df: DataFrame, n: int, seed: int = Settings.seed,
                  key: str = "row_id") -> DataFrame:
    """``n`` rows in a seed-dependent order that any engine can repeat."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(order, key).limit(n)
