"""Exact dedup: two passes over a Bloom filter, then a shuffle of possible repeats only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.skew import attach
from pairmill.sources.staging import spread, stage

#: Bits of one bitmap of ``bitmap_construct_agg``.
BITMAP_BITS = 8 * 4096


def repeated_slots(texts: DataFrame, bits: int, hashes: int) -> DataFrame:
    """The filter after the first pass: bitmaps of the slots that more than one text hit.

    Equal slots are summed before the shuffle. The table has ``bits / 32768`` rows of 4 KiB at
    most, whatever the number of texts.
    """
    slots = texts.select(F.explode(F.array(*_slots(bits, hashes))).alias("slot"))
    return (slots.groupBy("slot").agg(F.count("*").alias("n")).where("n > 1")
            .groupBy(F.expr(f"slot div {BITMAP_BITS}").alias("bucket"))
            .agg(F.expr(f"bitmap_construct_agg(slot % {BITMAP_BITS})").alias("bitmap")))


def _slots(bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64("text", F.lit(i)) if i else F.xxhash64("text"), F.lit(bits))
            for i in range(hashes)]


def exact_groups(docs: DataFrame, filter_bits: int = 1 << 27, hashes: int = 2) -> DataFrame:
    """Each document with the row that stays of its equal texts.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. A null text counts as
    empty, empty texts are equal. The row with the largest ``doc_id`` stays; of rows that repeat
    this id too, exactly one (null ids count as smallest). An empty table gives no rows.

    Pass one builds a Bloom filter of slots hit more than once. Pass two tests every document: a
    text with a slot that nothing else hit has no equal and passes straight through. The others
    shuffle as digests: the groups by ``text_sha256`` are counted with partial sums, and hot groups
    are answered from a bounded broadcast. A filter too small for the table lets more rows shuffle
    and changes nothing else; its broadcast has ``filter_bits / 8`` bytes at most.
    """
    docs = spread(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    bitmaps = stage(repeated_slots(docs, filter_bits, hashes), "bloom")
    tested = docs.select("doc_id", F.sha2("text", 256).alias("text_sha256"),
                         *[s.alias(f"slot{i}") for i, s in enumerate(_slots(filter_bits, hashes))])
    maybe = F.lit(True)
    for i in range(hashes):
        own = bitmaps.select(F.col("bucket").alias(f"bucket{i}"), F.col("bitmap").alias(f"map{i}"))
        tested = tested.join(F.broadcast(own),
                             F.expr(f"slot{i} div {BITMAP_BITS} = bucket{i}"), "left")
        byte = f"substring(map{i}, cast(slot{i} % {BITMAP_BITS} div 8 + 1 as int), 1)"
        bit = F.expr(f"getbit(cast(conv(hex({byte}), 16, 10) as bigint), cast(slot{i} % 8 as int))")
        maybe = maybe & (F.coalesce(bit, F.lit(0)) == 1)
    rows = stage(tested.select("doc_id", "text_sha256", maybe.alias("maybe"),
                               F.monotonically_increasing_id().alias("row")), "tested")
    repeats = rows.where("maybe").drop("maybe")
    largest = F.max(F.struct("doc_id", "row"))
    groups = stage(repeats.groupBy("text_sha256").agg(
        largest.alias("stays"), F.count("*").alias("n")).where("n > 1")
        .select("text_sha256", F.col("stays.doc_id").alias("keep_id"),
                F.col("stays.row").alias("keep_row"), F.col("n").alias("group_size"), "n"), "groups")
    grouped = attach(repeats, groups, "text_sha256", "n", rows.count())
    alone = rows.where("not maybe").select("doc_id", "text_sha256", "row", *[
        F.lit(None).cast("long").alias(c) for c in ("keep_id", "keep_row", "group_size")])
    return grouped.unionByName(alone).select(
        "doc_id", F.when(F.col("keep_row").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"), "text_sha256")
