"""Repeated n-grams inside a row: against brute force, and their work on long rows."""

import random
import time

from pyspark.sql import functions as F

from pairmill.functions import arrays


def test_against_brute_force(values):
    rng = random.Random(11)
    rows = [([rng.choice(["a", "b", "c", None]) for _ in range(rng.randint(0, 9))],) for _ in range(150)]
    for n in (1, 2, 3):
        grams = [[tuple(a[i:i + n]) for i in range(len(a) - n + 1)] for a, in rows]
        tails = [tuple(a[len(a) - n + 1:]) if n > 1 else () for a, in rows]
        assert values(lambda a: arrays.has_repeat(a, n), rows, "a array<string>") == [len(set(g)) < len(g) for g in grams]
        assert values(lambda a: arrays.repeat_completions(a, n), rows, "a array<string>") == [
            [x[-1] for x in g if x[:-1] == t] for g, t in zip(grams, tails)]
    assert values(arrays.has_repeat, [(None,)], "a array<string>") == [False]
    assert values(arrays.repeat_completions, [(None,)], "a array<string>") == [[]]


def test_long_rows(spark):
    """Of 20,000 items each: comparing all pairs of n-grams would take minutes."""
    began = time.time()
    rows = spark.range(2).select(F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: (
        F.when(i < 20_000, i).otherwise(F.when(F.col("id") == 1, 3).otherwise(i))).cast("string")).alias("a"))
    twice = rows.select(F.concat("a", F.slice("a", 1, 5)).alias("a"))
    assert [r.v for r in rows.select(arrays.has_repeat(F.col("a"), 3).alias("v")).collect()] == [False, False]
    assert [r.v for r in twice.select(arrays.has_repeat(F.col("a"), 3).alias("v")).collect()] == [True, True]
    assert time.time() - began < 40
