"""Token-id files: ids of many documents end to end, with Elias-Fano coded boundaries.

A table of segments in Parquet. A segment holds whole documents in ascending order: their ids as one
array of 16-bit (or 32-bit) integers, and the ends of the documents in that array as an Elias-Fano
code. Of each end, the low bits stand in a packed array; the high bits count up in a bit string,
where the i-th set bit at place p says that the i-th end has high part p - i. ``select_at`` holds
the place of every 64th set bit, so that one end is found from a few bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairmill.llm.common import blobs, blocks, texts
from pairmill.llm.tokens import encoder, tokenizer_path

SEGMENT_IDS = 1 << 18
STRIDE = 64

SCHEMA = ("part int, base long, n_docs long, n_ids long, id_bytes int, doc_ids array<long>, "
          "ids binary, low_bits int, lows binary, highs binary, select_at binary")


class Boundaries(NamedTuple):
    """Elias-Fano code of a non-decreasing sequence of ``count`` numbers."""

    count: int
    low_bits: int
    lows: bytes
    highs: bytes
    select_at: bytes

    @classmethod
    def of(cls, ends: np.ndarray) -> Boundaries:
        ends = np.asarray(ends, np.int64)
        n = len(ends)
        top = int(ends[-1]) if n else 0
        low = max(0, (top // n).bit_length() - 1) if n else 0
        bits = (ends[:, None] >> np.arange(low)) & 1
        places = (ends >> low) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        return cls(n, low, np.packbits(bits.astype(np.uint8), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(),
                   places[::STRIDE].astype("<u4").tobytes())

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.highs, np.uint8),
                                            bitorder="little"))[:self.count]
        low = np.unpackbits(np.frombuffer(self.lows, np.uint8), bitorder="little",
                            count=self.count * self.low_bits)
        low = low.reshape(self.count, self.low_bits).astype(np.int64)
        return ((ones - np.arange(self.count)) << self.low_bits) + low @ (
            np.int64(1) << np.arange(self.low_bits, dtype=np.int64))

    def end(self, i: int) -> int:
        """The i-th number alone: select on the high bits, then its own low bits."""
        at = int(np.frombuffer(self.select_at, "<u4")[i // STRIDE])
        left = i % STRIDE
        while left:
            at += 1
            left -= self.highs[at >> 3] >> (at & 7) & 1
        first = i * self.low_bits
        word = int.from_bytes(self.lows[first >> 3:(first + self.low_bits + 7) >> 3], "little")
        return (at - i << self.low_bits) + (word >> (first & 7) & (1 << self.low_bits) - 1)

    def span(self, i: int) -> tuple[int, int]:
        return (self.end(i - 1) if i else 0), self.end(i)


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1,
              id_bytes: int = 2) -> None:
    """Write the ids of all documents, in ascending order of ``doc_id``, to ``path``.

    A null text counts as empty: its document is the end id alone. Rows that repeat an id are
    documents of their own, in the order of their texts; null ids come first. An empty table
    writes no segment. Only ``doc_id`` and ``text`` are read. ``id_bytes`` (2 or 4) must hold
    the largest id.
    """
    file = tokenizer or tokenizer_path()
    end = end_id.to_bytes(4, "little")
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()),
             pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def segment(part: int, base: int, keys: list, held: list[bytes]) -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(held), "<u4")
        if len(ids) and int(ids.max()) >> 8 * id_bytes:
            raise ValueError(f"id {int(ids.max())} needs more than {id_bytes} bytes")
        code = Boundaries.of(np.cumsum([len(h) // 4 for h in held]))
        row = (part, base, len(keys), len(ids), id_bytes, keys, ids.astype(kind).tobytes(),
               code.low_bits, code.lows, code.highs, code.select_at)
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, coder = TaskContext.get().partitionId(), encoder(file)
        base, size, keys, held = 0, 0, [], []
        for block in blocks(batches):
            for key, text in zip(block.column("doc_id").to_pylist(), blobs(block.column("text")),
                                 strict=True):
                own = coder.encode(text) + end
                keys.append(key)
                held.append(own)
                size += len(own) // 4
                if size >= SEGMENT_IDS:
                    yield segment(part, base, keys, held)
                    base, size, keys, held = base + size, 0, [], []
        if keys:
            yield segment(part, base, keys, held)

    (texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(path))


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: place, number and checksum of its ids.

    ``start`` counts the ids of all documents before it. ``with_ids`` adds the ids.
    """
    segments = spark.read.schema(SCHEMA).parquet(path)
    # One row per range partition of the writer.
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                code = Boundaries(row["n_docs"], row["low_bits"], row["lows"], row["highs"],
                                  row["select_at"])
                ends = code.all()
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(row["ids"], f"<u{row['id_bytes']}").astype("<u4").tobytes()
                own = [ids[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [pa.array([row["part"]] * len(own), pa.int32()),
                           pa.array(row["doc_ids"], pa.int64()),
                           pa.array(starts + row["base"], pa.int64()),
                           pa.array(ends - starts, pa.int64()),
                           pa.array([zlib.crc32(x) for x in own], pa.int64())]
                if with_ids:
                    columns.append(pa.array(own, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    columns, ["part", "doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)

    found = segments.mapInArrow(run, "part int, doc_id long, start long, n_tokens long, "
                                     "ids_crc32 long" + ", ids binary" * with_ids)
    return (found.join(F.broadcast(offsets), "part")
            .withColumn("start", F.col("start") + F.col("offset")).drop("part", "offset"))
