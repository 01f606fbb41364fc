"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.sources.staging import spread, stage

BLOCK_BYTES = 8 << 20
#: Largest table that is broadcast, by the bytes of its rows and of their lists' elements.
BROADCAST_BYTES, ROW_BYTES, ELEMENT_BYTES = 32 << 20, 64, 48
#: Keys of documents that are broadcast (under 90 bytes each).
BROADCAST_KEYS = 2_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a number of its own for each row in ``name``, by ``doc_id`` (null first) and then by
    place. Where every row has an id of its own, that is the id; other tables are written in order once,
    so that the numbers hold for all readers. Rows of one id are dealt to several tasks.
    """
    key, at = F.col("doc_id").cast("long"), f"{name}_at"
    if docs.groupBy(key.alias("id")).agg(F.count("*").alias("n")).where("n > 1 or id is null").isEmpty():
        return docs.withColumn(name, key)
    placed = docs.withColumn(name, key).withColumn(at, F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(name, at).sortWithinPartitions(name, at)
    return stage(ranged.withColumn(name, F.monotonically_increasing_id()).drop(at), "numbered")


def free_name(docs: DataFrame, base: str) -> str:
    """``base``, with as many underscores as no column of ``docs`` has in front of it."""
    taken = {c.lower() for c in docs.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def bounded(table: DataFrame, lists: str | None = None) -> DataFrame:
    """A staged ``table`` for the small side of a join: broadcast where its rows, and the elements of
    the column ``lists``, take ``BROADCAST_BYTES`` at most; else shuffled like any other."""
    rows, elements = table.agg(F.count("*"), F.coalesce(F.sum(F.size(lists)), F.lit(0)) if lists else F.lit(0)).first()
    few = rows * ROW_BYTES + elements * ELEMENT_BYTES <= BROADCAST_BYTES
    return F.broadcast(table) if few else table


def with_found(docs: DataFrame, found: DataFrame, key: str, others: bool = True) -> DataFrame:
    """``docs`` with what a staged table, a row per ``key``, holds of them; the ``others`` too, with nulls. Only
    documents that are found in the table are shuffled, however large or small it is; all are where there are more
    than ``BROADCAST_KEYS``. Reads ``docs`` twice: its keys must be the same each time.
    """
    if found.count() > BROADCAST_KEYS:
        return docs.join(found.hint("merge"), key, "left" if others else "inner")
    keys = F.broadcast(found.select(key))
    met = docs.join(keys, key, "left_semi").join(found.hint("merge"), key)
    if not others:
        return met
    return met.unionByName(docs.join(keys, key, "left_anti"), allowMissingColumns=True)


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` and whole ``text`` (null: empty), in at least one task per core."""
    return spread(docs.select(*more, F.col("doc_id").cast("long").alias("doc_id"),
                              F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))


_remembered: dict[object, object] = {}


def remembered(name: object, make: Callable[[], object]) -> object:
    """What a worker process keeps from task to task, for one operator at a time: asking for another's drops
    it, as workers serve all stages of a job and their memories would add up."""
    if name not in _remembered:
        _remembered.clear()
        _remembered[name] = make()
    return _remembered[name]


def blobs(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def blocks(batches: Iterable[pa.RecordBatch], column: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``limit`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)
