"""Joins and components that stand hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.sources.staging import stage

HOT_SHARE = 10_000
HOT_LEAST = 100


def attach(rows: DataFrame, facts: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """Left join ``rows`` to ``facts``, which has one row per key and the key's rows in ``size``.

    Keys with a ten-thousandth of the ``n_rows`` rows or more are answered from a broadcast; there
    can't be more than ten thousand of them. The other keys are too small to burden a task and
    are joined by a shuffle. Both tables are read twice: pass staged ones.
    """
    hot_from = max(HOT_LEAST, -(-n_rows // HOT_SHARE))
    values = [c for c in facts.columns if c not in (key, size)]
    hot = facts.where(F.col(size) >= hot_from).drop(size).withColumn("_hot", F.lit(True))
    cold = facts.where(F.col(size) < hot_from).drop(size)
    met = rows.join(F.broadcast(hot), key, "left")
    done = met.where("_hot").select(*rows.columns, *values)
    rest = met.where("_hot is null").select(*rows.columns)
    return done.unionByName(rest.join(cold, key, "left").select(*rows.columns, *values))


def components(links: DataFrame) -> DataFrame:
    """Connected components of links ``a``, ``b`` (longs): each linked ``node`` with the smallest
    node reachable from it, ``root``.

    Alternating large and small stars: every round moves links towards smaller nodes, until all
    of a component hang on its smallest. Each round is written to the shared folder.
    """
    links = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u <> v").distinct(), "links")
    seen = None
    while True:
        n, mark = links.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)")).first()
        if (n, mark) == seen or n == 0:
            return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
                    .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root"))
                                 .distinct()))
        seen = n, mark
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = _star(both, "v > u", 2 * n)
        links = stage(_star(links, None, n), "links")


def _star(near: DataFrame, where: str | None, n: int) -> DataFrame:
    """Hang the neighbours of each ``u`` (those that fulfil ``where``), and ``u`` itself, on the
    smallest of them all."""
    least = stage(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                        F.count("*").alias("n")), "stars")
    moved = attach(near, least, "u", "n", n)
    moved = (moved if where is None else moved.where(where)).select(F.col("v").alias("u"), "m")
    own = least.select("u", "m")
    return (moved.unionByName(own).where("u <> m").distinct()
            .select("u", F.col("m").alias("v")))
