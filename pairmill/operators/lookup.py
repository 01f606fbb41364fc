"""Dictionary joins and global ranks that hold up under skew."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pairmill.settings import Settings
from pairmill.sources.staging import stage


def _row_bytes(df: DataFrame) -> Column:
    return sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))


def fits(dictionary: DataFrame, rows: int, nbytes: int) -> bool:
    """Whether a (staged) dictionary is small enough, by rows and the bytes of all its columns."""
    size = dictionary.agg(F.count("*").alias("rows"), F.sum(_row_bytes(dictionary)).alias("bytes")).first()
    return size["rows"] <= rows and (size["bytes"] or 0) <= nbytes


#: Keys that the sketch of frequent keys tracks, and most copies of a dictionary row.
SKETCH_KEYS, MOST_COPIES = 10_000, 1_000


def staged_with_hot_keys(df: DataFrame, key: str, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """``df`` written once, and its frequent keys as (``_hash``, ``_copies``): ``hot_keys`` rows at most.

    A sketch of the keys' hashes is filled while the rows are written, so ``df`` runs once. Its counts are
    estimates; they decide where rows go, never what they meet.
    """
    seen = Observation("hot-keys")
    top = F.expr(f"approx_top_k(xxhash64(`{key}`), {settings.hot_keys}, {max(SKETCH_KEYS, settings.hot_keys)})")
    rows = stage(df.observe(seen, top.alias("top")), "lookup")
    hot = [(r["item"], min(MOST_COPIES, 1 + r["count"] // settings.hot_min_rows)) for r in seen.get["top"] or ()
           if r["count"] >= settings.hot_min_rows]
    return rows, df.sparkSession.createDataFrame(hot, "_hash bigint, _copies int")


def lookup(df: DataFrame, dictionary: DataFrame, key: str, settings: Settings = Settings(),
           spread_keys: bool = False) -> DataFrame:
    """Left join ``df`` to a dictionary with one row per ``key``.

    A dictionary of checked size is broadcast. For a larger one ``df`` is written once, and its
    frequent keys, known to the dictionary or not, are told by a sketch in the same pass. The rows of such a key
    get numbers by turns, its dictionary row is copied for each number, and key and number are joined
    together: no key's rows meet in one task, and both sides are read once. ``spread_keys`` says that
    ``df`` repeats no key often, for instance after an aggregation by it, and skips all that.
    """
    if fits(dictionary, settings.broadcast_rows, settings.broadcast_bytes):
        return df.join(F.broadcast(dictionary), key, "left")
    if spread_keys:
        return df.join(dictionary, key, "left")
    rows, hot = staged_with_hot_keys(df, key, settings)
    if hot.isEmpty():
        return rows.join(dictionary, key, "left")

    def marked(side: DataFrame) -> DataFrame:
        return (side.withColumn("_hash", F.xxhash64(key)).join(F.broadcast(hot), "_hash", "left")
                .withColumn("_copies", F.coalesce("_copies", F.lit(1))))

    turn = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_copies")).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    values = [c for c in dictionary.columns if c != key]
    return (marked(rows).withColumn("_turn", turn)
            .join(marked(dictionary).withColumn("_turn", copies).drop("_hash", "_copies"), [key, "_turn"], "left")
            .select(key, *[c for c in df.columns if c != key], *values))


def _dictionary_call(keys: pa.Array, values: pa.Array, kind: str):
    """An Arrow function that looks the items of arrays up in a small dictionary; null where it lacks them."""
    @F.arrow_udf(f"array<{kind}>")
    def looked_up(lists: pa.Array) -> pa.Array:
        lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
        found = values.take(pc.index_in(lists.flatten(), value_set=keys))
        return pa.ListArray.from_arrays(pa.array(ends), found)
    return looked_up


def in_rows(dictionary: DataFrame, key: str, value: str, kind: str, settings: Settings):
    """``_dictionary_call`` for a dictionary of broadcast size, or None: arrays then stay whole in their rows."""
    if not fits(dictionary, settings.broadcast_rows, settings.broadcast_bytes):
        return None
    small = dictionary.select(key, value).toArrow().combine_chunks()
    columns = [small[c].combine_chunks() for c in (key, value)]
    return _dictionary_call(*[c.chunk(0) if isinstance(c, pa.ChunkedArray) and c.num_chunks else c for c in columns], kind)


def ranked(df: DataFrame, order: list[Column], name: str = "rank",
           first: int = 1) -> DataFrame:
    """Global row number without an unpartitioned window.

    Rows are range partitioned and sorted, written once with their position in
    the partition, and shifted by the row counts of the partitions before. Only
    those counts (one row per partition) meet in one task.
    """
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_place", F.monotonically_increasing_id()))
    placed = stage(placed, "ranked")
    part = F.shiftright("_place", 33)
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0))
                            .alias("_offset"))
    return (placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .select(*df.columns, (F.col("_offset") + inside + first).alias(name)))


def sums_before(df: DataFrame, by: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """The sum of ``value`` over the rows that come before within the same ``by``, however many there are.

    As in ``ranked``, rows are range partitioned and written once; running sums inside a range are shifted
    by the group's sums in the ranges before, one row per group and range. Null is a group of its own.
    """
    placed = df.withColumn("_value", value).repartitionByRange(F.col(by), *order)
    placed = stage(placed.withColumn("_part", F.spark_partition_id()), "sums")
    totals = placed.groupBy(F.col(by).alias("_by"), F.col("_part").alias("_range")).agg(F.sum("_value").alias("_total"))
    earlier = Window.partitionBy("_by").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_by", "_range", F.sum("_total").over(earlier).alias("_shift")).where("_shift is not null")
    inside = Window.partitionBy("_part", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    summed = placed.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), zero))
    return (summed.join(shifts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_range")), "left")
            .select(*df.columns, (F.coalesce("_shift", zero) + F.col("_inside")).alias(name)))
