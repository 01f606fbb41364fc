"""SimHash near-dedup: fingerprints, block joins, verified links, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import blobs, blocks, bounded, free_name, numbered, texts
from pairmill.llm.skew import attach, components
from pairmill.sources.staging import stage

#: Fingerprints of one block value that a task compares at once.
GROUP_ROWS = 1024


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """Bits set in over half the hashes of the text's shingles, repeats included.

    A shingle is ``words`` words joined by spaces; a shorter text is one shingle, and a text
    without words has the fingerprint zero.
    """
    from xxhash import xxh64_intdigest
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(sizes) - 1
    starts = (ends - sizes + 1)[:max(1, len(parts) - words + 1)].tolist()
    ends = ends[min(words, len(parts)) - 1:].tolist()
    hashes = np.fromiter((xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, ends, strict=True)),
                         "<u8", len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at:at + (1 << 14)].view(np.uint8)
        counts += np.unpackbits(part, bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            fps = np.array([fingerprint(t, words, seed) for t in blobs(block.column("text"))],
                           np.uint64)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return texts(docs).mapInArrow(run, "doc_id long, fp long")


def block_count(n: int, distance: int) -> int:
    """Blocks to cut 64 bits into. Close pairs agree on all but ``distance`` of them, and the bits
    of these must tell ``n`` fingerprints apart, so that chance pairs stay in proportion to n."""
    blocks_ = distance + 2
    while 64 * (blocks_ - distance) // blocks_ < max(1, n).bit_length() + 2 and blocks_ < distance + 5:
        blocks_ += 1
    return blocks_


def masks(n_blocks: int, distance: int) -> list[int]:
    """The bits of every choice of all but ``distance`` blocks, as signed longs."""
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    own = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    chosen = (sum(c) for c in combinations(own, n_blocks - distance))
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def links(fps: DataFrame, n: int, distance: int = 4) -> DataFrame:
    """Links ``a``, ``b`` between ``n`` distinct fingerprints (``fp``) at ``distance`` bits or fewer.

    Fingerprints meet by the value of each choice of blocks. A group of equal values gives a
    spanning forest of its close pairs, not all of them: what is reachable stays reachable. Groups
    of over twice ``GROUP_ROWS`` are dealt to several tasks, each pair of parts to one.
    """
    each = F.explode(F.array(*[F.lit(m).cast("long") for m in masks(block_count(n, distance), distance)]))
    keys = fps.select("fp", each.alias("mask")).select(
        "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"))
    keys = stage(keys.withColumn("key", F.xxhash64("mask", "value")).select("fp", "key"), "blocks")
    large = stage(keys.groupBy("key").agg(F.count("*").alias("n"))
                  .where(F.col("n") > 2 * GROUP_ROWS)
                  .withColumn("parts", F.ceil(F.col("n") / GROUP_ROWS).cast("int")), "large")
    if large.isEmpty():
        dealt = keys.select("key", F.lit(0).alias("pair"), "fp")
    else:
        met = attach(keys, large, "key", "n", keys.count())
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        others = F.expr("filter(sequence(0, parts - 1), i -> i <> own)")
        dealt = (met.where("parts is null").select("key", F.lit(0).alias("pair"), "fp")
                 .unionByName(met.where("parts is not null").withColumn("own", own)
                              .withColumn("other", F.explode(others))
                              .select("key", F.expr("least(own, other) * parts + greatest(own, other)")
                                      .cast("int").alias("pair"), "fp")))
    grouped = dealt.repartition("key", "pair").sortWithinPartitions("key", "pair", "fp")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps_, ends in _groups(batches):
            a, b = _close(fps_, ends, distance)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                             ["a", "b"])

    return grouped.mapInArrow(run, "a long, b long")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole groups: fingerprints, and the number of each group's first row."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        rows = [batch.column(c).to_numpy() for c in ("key", "pair", "fp")]
        held = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
        new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
        if len(new):
            cut = int(new[-1])
            yield held[2][:cut].view(np.uint64), np.concatenate([[0], new])
            held = [x[cut:] for x in held]
    if held is not None and len(held[2]):
        yield held[2].view(np.uint64), np.array([0, len(held[2])])


def _close(fps: np.ndarray, ends: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is close in each group."""
    few = 6
    sizes = np.diff(ends)
    left = np.repeat(np.where(sizes <= few, ends[1:], 0), sizes)  # end of one's group, if small
    found = []
    for step in range(1, few):
        at = np.arange(len(fps) - step)
        at = at[at + step < left[:len(at)]]
        at = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= distance]
        found.append((fps[at], fps[at + step]))
    for i in np.flatnonzero(sizes > few):
        rest = np.unique(fps[ends[i]:ends[i + 1]])
        todo: list[np.uint64] = []
        while len(rest):
            if not todo:
                todo, rest = [rest[0]], rest[1:]
            one = todo.pop()
            near = np.bitwise_count(rest ^ one) <= distance
            if near.any():
                new = rest[near]
                found.append((np.full(len(new), one), new))
                rest = rest[~near]
                todo.extend(new)
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


def near_duplicates(docs: DataFrame, words: int = 4, seed: int = 42, distance: int = 4) -> DataFrame:
    """Each document with its ``fingerprint`` (hex) and ``component_id``, the smallest ``doc_id``
    reachable over links of ``distance`` differing bits or fewer.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. A null text counts as
    empty; texts without words share the fingerprint zero and are linked like any other. Rows that
    repeat an id or a text give a row each. An empty table gives no rows. Equal fingerprints are one
    node, so copies cost nothing beyond their own row.
    """
    rows = stage(fingerprints(docs, words, seed), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")),
                  "nodes")
    found = stage(links(nodes.select("fp"), nodes.count(), distance).distinct(), "close")
    roots = components(found).select(F.col("node").alias("fp"), "root")
    member = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    member = stage(member, "members")
    group = stage(member.groupBy("root").agg(F.min("first").alias("component_id"),
                                             F.count("*").alias("size")), "components")
    named = stage(attach(member, group, "root", "size", member.count())
                  .select("fp", "component_id", "n"), "named")
    return attach(rows, named, "fp", "n", rows.count()).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, words: int = 4, seed: int = 42, distance: int = 4) -> DataFrame:
    """``docs``, with all columns, but only the row with the smallest ``doc_id`` of each component of
    ``near_duplicates``; a null id comes first, and of several rows with that id the first of the
    table stays. Texts without words are one component, of which one row stays."""
    name = free_name(docs, "row")
    rows = numbered(docs, name)
    found = near_duplicates(rows.select(F.col(name).alias("doc_id"), "text"), words, seed, distance)
    gone = stage(found.where("doc_id <> component_id").select(F.col("doc_id").alias(name)), "near-copies")
    return rows.join(bounded(gone), name, "left_anti").select(*docs.columns)
