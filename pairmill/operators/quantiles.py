"""Quantiles of a column: by a mergeable sketch, and exact."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sketch of this size errs by less than ``RANK_ERROR`` of the rows in the rank of a quantile.
SKETCH_SIZE, RANK_ERROR = 2048, 0.01
#: Values that the driver sorts at the end of an exact selection.
LAST_ROWS = 10_000


def sketched_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """A value whose rank differs from ``share`` of the rows by ``RANK_ERROR`` of them at most; one pass,
    and a sketch of a few kilobytes per task. Nulls do not count."""
    sketch = F.kll_sketch_agg_double(F.col(column).cast("double"), SKETCH_SIZE)
    row = df.where(F.col(column).isNotNull()).agg(F.count("*").alias("n"), sketch.alias("s")).select(
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(float(share)))).alias("q")).first()
    return row["q"]


def exact_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The least value that ``share`` of the rows do not exceed; null without rows.

    Sketches bracket it, counts tell on which side it lies, and each pass leaves about a fiftieth of the
    rows, until few enough remain to be sorted. Pass a staged table: it is read several times.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null")
    n = values.count()
    if not n:
        return None
    rank = max(1, math.ceil(share * n))
    while n > LAST_ROWS:
        at = [min(1.0, max(0.0, (rank - 0.5) / n + d)) for d in (-RANK_ERROR, RANK_ERROR)]
        sketch = values.agg(F.kll_sketch_agg_double("v", SKETCH_SIZE).alias("s"))
        low, high = sketch.select(*[F.kll_sketch_get_quantile_double("s", F.lit(x)) for x in at]).first()
        below, inside = values.agg(F.count_if(F.col("v") < low), F.count_if(F.col("v").between(low, high))).first()
        if rank <= below:
            values, n = values.where(F.col("v") < low), below
        elif rank <= below + inside:
            if low == high:
                return low
            if inside == n:  # nothing but the ends is left out: two values at most lie apart
                low_rows = values.where(F.col("v") == low).count()
                if rank <= low_rows:
                    return low
                values, rank, n = values.where(F.col("v") > low), rank - low_rows, n - low_rows
                continue
            values, rank, n = values.where(F.col("v").between(low, high)), rank - below, inside
        else:
            values, rank, n = values.where(F.col("v") > high), rank - below - inside, n - below - inside
    return values.orderBy("v").limit(rank).agg(F.max("v")).first()[0]
