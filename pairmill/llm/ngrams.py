"""N-gram Jaccard join: overlap counts from a blocked sparse product of document by n-gram incidence.

Equal sets are one node. The product is formed where it can reach the threshold only:

1. Nodes with an equal min-hash form blocks. A block's rows are cut where their sizes lie too far apart,
   and its incidence matrix is multiplied with its transpose: columns of few documents as pairs, full
   ones as dense tiles. What is linked there hangs together from then on.
2. For all other pairs, the columns are taken rarest first. A linked pair shares one of the first few
   of both its rows, so the product over these columns gives a partial overlap for each candidate.
   Pairs that cannot reach the bound that follows from their sizes are discarded: before they are counted,
   by the parities of their n-grams, a lower bound of how many only one of them has; and by their
   summed partial overlaps. The rest is counted in full.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import blobs, blocks, bounded, numbered, texts
from pairmill.llm.skew import attach, components
from pairmill.sources.staging import stage

PIECE_BYTES = 1 << 20
SPACE = re.compile(rb"[ \t-\r]")
#: Words whose hash a worker remembers.
HELD_WORDS = 300_000
#: Counters of the sketch that orders columns from rare to frequent, and those in one of its rows.
SKETCH, SKETCH_ROW = 1 << 19, 1 << 13
#: Nodes and n-grams in one block of step 1; rows of one column that a task pairs in step 2.
BLOCK_NODES, BLOCK_GRAMS, GROUP_ROWS = 512, 2_000_000, 1024
#: Columns of up to so many documents are multiplied as pairs, others as dense tiles of so many cells.
FEW, TILE = 16, 1 << 22
#: Words of 64 parity bits of each set.
PARITY_WORDS = 8
#: Pairs a task holds before it passes their overlaps on.
HELD_PAIRS = 500_000
#: Nodes up to which their numbers are broadcast (8 bytes each).
BROADCAST_NODES = 4_000_000


class Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest
        found = xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) > HELD_WORDS:
                self.clear()
            self[word] = found
        return found


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, in lists from pieces of bounded size cut at spaces."""
    at = 0
    while at < len(text):
        space = SPACE.search(text, at + PIECE_BYTES)
        end = space.start() if space else len(text)
        yield text[at:end].lower().split()
        at = end


def shingles(text: bytes, words: int, known: Hashes) -> np.ndarray:
    """Hashes of the distinct shingles, sorted; a shorter text is one shingle, one without words none."""
    last, found = np.zeros(0, np.uint64), []
    n = 0
    for part in word_lists(text):
        own = np.concatenate([last, np.fromiter(map(known.__getitem__, part), np.uint64, len(part))])
        n += len(part)
        if len(own) >= words:
            found.append(_mixed(own, words))
        last = own[-(words - 1):] if words > 1 else own[:0]
    if 0 < n < words:
        found.append(_mixed(last, n))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _mixed(hashes: np.ndarray, words: int) -> np.ndarray:
    m = len(hashes) - words + 1
    h = np.full(m, words, np.uint64)
    for j in range(words):
        h = (h ^ hashes[j:j + m]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def sketch(rows: DataFrame, words: int) -> np.ndarray:
    """How many documents have an n-gram of each of ``SKETCH`` classes, over all ``rows``."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Hashes(), np.zeros(SKETCH, np.int64)
        for block in blocks(batches):
            found = [shingles(t, words, known) for t in blobs(block.column("text"))]
            total += np.bincount((np.concatenate(found) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        own = total.reshape(-1, SKETCH_ROW)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own), dtype=np.int32)),
                                          pa.array([x.tobytes() for x in own], pa.binary())], ["row", "counts"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, data in zip(batch.column("row").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                held[row] = held.get(row, 0) + np.frombuffer(data, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()),
                                          pa.array([x.tobytes() for x in held.values()], pa.binary())], ["row", "counts"])

    parts = rows.select("text").mapInArrow(count, "row int, counts binary").repartition("row").mapInArrow(
        add, "row int, counts binary").collect()  # SKETCH longs, whatever the number of documents
    counts = np.zeros((SKETCH // SKETCH_ROW, SKETCH_ROW), np.int64)
    for r in parts:
        counts[r.row] += np.frombuffer(r.counts, np.int64)
    return counts.ravel()


def least(size: int, percent: int) -> int:
    """Overlap that a set of this size has with any linked one, at least."""
    return -(-percent * size // 100)


def parities(grams: np.ndarray) -> bytes:
    """Whether each class of n-grams has an odd number of these. The bits in which two sets differ are at most
    as many as the n-grams that only one of them has."""
    odd = np.bincount((grams >> np.uint64(40) & np.uint64(64 * PARITY_WORDS - 1)).astype(np.int64),
                      minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def described(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """For each document its size, a 128-bit hash of its set, two min-hashes, ``parity`` bits, and ``prefix``: its
    rarest n-grams, of which each linked document has one among its own rarest."""
    order = rows.sparkSession.sparkContext.broadcast(sketch(rows, words))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        known, counts = Hashes(), order.value
        for block in blocks(batches):
            facts: list[tuple[int, ...]] = []
            prefixes: list[np.ndarray] = []
            bits: list[bytes] = []
            for text in blobs(block.column("text")):
                own = shingles(text, words, known)
                bits.append(parities(own))
                if not len(own):
                    facts.append((0, 0, 0, 0, 0))
                    prefixes.append(own)
                    continue
                a, b = np.frombuffer(xxh3_128_digest(own.tobytes()), np.int64).tolist()
                other = (own ^ own >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
                facts.append((len(own), a, b, int(own[:1].view(np.int64)[0]), int(other.min().view(np.int64))))
                n = len(own) - least(len(own), percent) + 1
                rare = np.lexsort((own, counts[(own % np.uint64(SKETCH)).astype(np.int64)]))[:n]
                prefixes.append(own[rare])
            ends = np.cumsum([0, *map(len, prefixes)])
            prefix = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                np.concatenate(prefixes).view(np.int64) if prefixes else [], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), block.column("doc_id"),
                 *(pa.array([f[i] for f in facts], pa.int64()) for i in range(5)), pa.array(bits, pa.binary()), prefix],
                ["key", "doc_id", "size", "hash_a", "hash_b", "min_a", "min_b", "parity", "prefix"])

    return rows.mapInArrow(run, "key long, doc_id long, size long, hash_a long, hash_b long, min_a long, "
                           "min_b long, parity binary, prefix array<long>")


def sets_of(rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node`` and its n-grams as bytes in ``grams``, for the documents named by ``nodes`` (one row each), with its
    other columns. Texts stay in place for up to ``BROADCAST_NODES``."""
    few = nodes.count() <= BROADCAST_NODES
    wanted = nodes.withColumnRenamed("node", "key")
    more = [f for f in nodes.schema.fields if f.name != "node"]
    met = rows.join(F.broadcast(wanted) if few else wanted, "key").select("key", "text", *(f.name for f in more))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for block in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array([shingles(t, words, known).tobytes() for t in blobs(block.column("text"))],
                                               pa.binary()), *(block.column(f.name) for f in more)],
                ["node", "grams", *(f.name for f in more)])

    return met.mapInArrow(run, ", ".join(["node long, grams binary", *(f"{f.name} {f.dataType.simpleString()}" for f in more)]))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The product of the incidence matrix with its transpose, above the diagonal."""
    k = len(sets)
    doc = np.repeat(np.arange(k), [len(s) for s in sets])
    gram = np.concatenate(sets)
    order = np.argsort(gram, kind="stable")  # documents of a column stay in order
    gram, doc = gram[order], doc[order]
    first = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
    sizes = np.diff(np.append(first, len(gram)))
    counts = np.zeros(k * k, np.int64)
    for size in np.unique(sizes[(sizes > 1) & (sizes <= FEW)]).tolist():
        column = doc[first[sizes == size][:, None] + np.arange(size)]
        for i in range(size - 1):
            pair = column[:, i:i + 1] * k + column[:, i + 1:]
            counts += np.bincount(pair.ravel(), minlength=k * k)
    counts = counts.reshape(k, k)
    full = np.flatnonzero(sizes > FEW)
    step = max(1, TILE // k)
    for at in range(0, len(full), step):
        own = full[at:at + step]
        width = sizes[own]
        where = np.repeat(first[own] - np.cumsum(width) + width, width) + np.arange(width.sum())
        tile = np.zeros((k, len(own)), np.float32)
        tile[doc[where], np.repeat(np.arange(len(own)), width)] = 1
        counts += np.triu((tile @ tile.T).astype(np.int64), 1)
    return counts


def linked(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join what hangs together in a block; not every link of it."""
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    start = 0
    for end in range(1, len(order) + 1):
        if end < len(order) and percent * len(sets[order[end]]) <= 100 * len(sets[order[end - 1]]):
            continue
        part = order[start:end]  # no set beyond this range can reach the threshold with one in it
        start = end
        if len(part) < 2:
            continue
        own = [sets[i] for i in part]
        size = np.array([len(s) for s in own])
        near = (100 + percent) * overlaps(own) >= percent * np.add.outer(size, size)
        near = np.triu(near, 1)
        near |= near.T
        left = np.ones(len(part), bool)
        while left.any():
            root = int(np.argmax(left))
            left[root] = False
            todo = [root]
            while todo:
                new = np.flatnonzero(near[todo].any(0) & left)
                left[new] = False
                todo = new.tolist()
                yield from ((part[root], part[i]) for i in todo)


def block_links(members: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Links ``a``, ``b`` within each block (``block``, ``node``); ``sets`` adds the n-grams to a table of nodes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            nodes = [r[1] for r in held]
            found = list(linked([np.frombuffer(r[2], np.uint64) for r in held], percent))
            return pa.RecordBatch.from_arrays([pa.array([nodes[i] for i, _ in found], pa.int64()),
                                               pa.array([nodes[j] for _, j in found], pa.int64())], ["a", "b"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "node", "grams")), strict=True):
                if held and row[0] != held[0][0]:
                    yield done()
                    held.clear()
                held.append(row)
        if held:
            yield done()

    own = stage(members.groupBy("node").agg(F.collect_list("block").alias("blocks")), "node-blocks")
    met = sets(own).select(F.explode("blocks").alias("block"), "node", "grams")
    return met.repartition("block").sortWithinPartitions("block", "node").mapInArrow(run, "a long, b long")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """``block`` and ``node`` of step 1: nodes share a min-hash. A large block of the one kind is cut by its
    nodes' other min-hash; a large one of the other kind, and what is still large of the first, into parts of
    any nodes, which so tie the first kind's together. All parts get the block's first node. A node
    without company is left out, and of blocks with the same nodes one stays."""
    kinds = F.explode(F.array(
        F.struct(F.xxhash64(F.lit(0), "min_a").alias("block"), F.col("min_b").alias("second")),
        F.struct(F.xxhash64(F.lit(1), "min_b").alias("block"), F.lit(0).cast("long").alias("second"))))
    member = stage(nodes.select("node", "size", kinds.alias("kind")).select("node", "size", "kind.*"), "members")
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")

    def counted(rows: DataFrame) -> DataFrame:
        sizes = rows.groupBy("block").agg(F.count("*").alias("n"), F.sum("size").alias("grams"),
                                          F.min("node").alias("leader")).where("n > 1")
        sizes = stage(sizes.select("block", "n", "leader", parts.alias("parts")), "block-sizes")
        return attach(rows, sizes, "block", "n", rows.count()).where("parts is not null")

    met = counted(member)
    large = stage(met.where("parts > 1").select(F.xxhash64("block", "second").alias("block"), "node", "size"), "large-blocks")
    cut = counted(large)
    own = F.array(F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    all_parts = F.when(F.col("node") == F.col("leader"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(own)
    dealt = cut.select("block", "node", F.explode(all_parts).alias("part"))
    found = stage(met.where("parts = 1").select("block", "node").unionByName(
        dealt.select(F.xxhash64("block", "part").alias("block"), "node")).distinct(), "all-blocks")
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "node")).alias(f"mark_{i}") for i in range(2)]
    one = (found.groupBy("block").agg(F.count("*").alias("n"), *marks)
           .groupBy("n", "mark_0", "mark_1").agg(F.min("block").alias("block")).select("block"))
    return found.join(one, "block", "left_semi")


def partial_overlaps(rows: DataFrame, percent: int) -> DataFrame:
    """``a``, ``b``, their sizes and how many columns they have in common in ``rows`` (``key``, ``node``,
    ``cluster``, ``size``, ``parity``); not for nodes of one cluster, nor for pairs whose sizes and parities
    rule out a link."""
    large = stage(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 2 * GROUP_ROWS)
                  .withColumn("parts", F.ceil(F.col("n") / GROUP_ROWS).cast("int")), "large-columns")
    if large.isEmpty():
        dealt = rows.withColumn("pair", F.lit(0))
    else:
        met = attach(rows, large, "key", "n", rows.count())
        met = met.withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        pair = F.explode(F.expr("transform(filter(sequence(0, parts - 1), i -> i <> own),"
                                " i -> least(own, i) * parts + greatest(own, i))"))
        dealt = (met.where("parts is null").select(*rows.columns, F.lit(0).alias("pair"))
                 .unionByName(met.where("parts is not null").select(*rows.columns, pair.alias("pair"))))
    names = ["key", "pair", "node", "cluster", "size"]

    def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
        bits = np.frombuffer(b"".join(batch.column("parity").to_pylist()), np.uint64).reshape(-1, PARITY_WORDS)
        return [*(batch.column(c).to_numpy() for c in names), bits]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5 + [np.zeros((0, PARITY_WORDS), np.uint64)]
        found: list[np.ndarray] = []
        n = 0
        for batch in batches:
            held = [np.concatenate(x) for x in zip(held, columns(batch), strict=True)]
            new = np.flatnonzero((np.diff(held[0]) != 0) | (np.diff(held[1]) != 0)) + 1
            if len(new):
                cut = int(new[-1])
                found.append(_paired([x[:cut] for x in held], percent))
                held = [x[cut:] for x in held]
                n += found[-1].shape[1]
                if n > HELD_PAIRS:
                    yield _counted(found)
                    found, n = [], 0
        if len(held[0]):
            found.append(_paired(held, percent))
        if found:
            yield _counted(found)

    placed = dealt.select(*names, "parity").repartition("key", "pair").sortWithinPartitions("key", "pair", "node")
    return placed.mapInArrow(run, "a long, b long, size_a long, size_b long, n long")


def _paired(rows: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs of rows of one column, smaller node first: nodes and sizes."""
    key, part, node, cluster, size, bits = rows
    first = np.flatnonzero(np.append(True, (np.diff(key) != 0) | (np.diff(part) != 0)))
    ends = np.append(first[1:], len(key))
    last = np.repeat(ends, ends - first)
    found = []
    for step in range(1, int((ends - first).max())):
        at = np.flatnonzero(np.arange(len(key)) + step < last)
        to = at + step
        low, high = np.minimum(size[at], size[to]), np.maximum(size[at], size[to])
        keep = (cluster[at] != cluster[to]) & (100 * low >= percent * high)
        at, to = at[keep], to[keep]
        both = size[at] + size[to]
        apart = both - 2 * -(-percent * both // (100 + percent))  # n-grams that only one has, at most
        keep = np.bitwise_count(bits[at] ^ bits[to]).sum(1) <= apart
        at, to = at[keep], to[keep]
        found.append(np.stack([node[at], node[to], size[at], size[to]]))
    return np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)


def _counted(found: list[np.ndarray]) -> pa.RecordBatch:
    pairs = np.concatenate(found, axis=1)
    pairs = pairs[:, np.lexsort(pairs[1::-1])]
    new = np.flatnonzero(np.append(True, (np.diff(pairs[:2]) != 0).any(0))) if pairs.shape[1] else np.zeros(0, int)
    n = np.diff(np.append(new, pairs.shape[1]))
    return pa.RecordBatch.from_arrays([*(pa.array(x) for x in pairs[:, new]), pa.array(n, pa.int64())],
                                      ["a", "b", "size_a", "size_b", "n"])


def counted_in_full(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("grams_a").to_pylist(), batch.column("grams_b").to_pylist(), strict=True):
                own, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(own) + len(other) - len(np.union1d(own, other))
                keep.append((100 + percent) * both >= percent * (len(own) + len(other)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = (pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a")), "a")
           .join(sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b")), "b"))
    return met.select("a", "b", "grams_a", "grams_b").mapInArrow(run, "a long, b long")


def near_documents(docs: DataFrame, words: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest ``doc_id`` reachable over links: two
    documents link when their sets of ``words``-word shingles share ``percent`` of their union or more.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Words are separated by ASCII
    white space, A-Z are lower-cased. A text of fewer words is one shingle; a null text and one without words
    have the empty set, linked with nothing. Rows that repeat an id or a text give a row each, and rows
    of one id are not linked for it. The component of null ids only is null. An empty table gives no
    rows. Shingles are told apart by 64 bits of hash, sets by 128.
    """
    rows = texts(numbered(docs.select("doc_id", "text"), "number"), F.col("number").alias("key"))
    facts = stage(described(rows, words, percent), "ngram-rows")
    alike = stage(facts.where("size > 0").groupBy("hash_a", "hash_b").agg(
        F.min("key").alias("node"), F.min("doc_id").alias("first"), F.count("*").alias("n")), "ngram-nodes")
    first = bounded(alike.select(F.col("node").alias("key")))
    nodes = stage(facts.join(first, "key", "left_semi").select(F.col("key").alias("node"), "size", "min_a", "min_b"),
                  "ngram-first")

    member = stage(blocks_of(nodes), "ngram-blocks")
    close = stage(block_links(member, lambda named: sets_of(rows, named, words), percent).distinct(), "block-links")
    joined = components(close).select("node", F.col("root").alias("cluster"))
    cluster = stage(nodes.join(joined, "node", "left").select(
        F.col("node").alias("key"), F.coalesce("cluster", "node").alias("cluster")), "ngram-clusters")
    columns = stage(_met(facts.join(bounded(cluster), "key").select(
        F.explode("prefix").alias("column"), F.col("key").alias("node"), "cluster", "size")
        .withColumnRenamed("column", "key")), "ngram-columns")
    columns = columns.join(facts.select(F.col("key").alias("node"), "parity"), "node")
    bound = F.greatest(*[F.expr(f"({percent} * {s} + 99) div 100 - 1") for s in ("size_a", "size_b")])
    pairs = (partial_overlaps(columns, percent).groupBy("a", "b")
             .agg(F.max("size_a").alias("size_a"), F.max("size_b").alias("size_b"), F.sum("n").alias("n"))
             .where((100 + percent) * (F.col("n") + bound) >= percent * (F.col("size_a") + F.col("size_b"))))
    pairs = stage(pairs.select("a", "b"), "ngram-pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = stage(sets_of(rows, ends, words), "ngram-sets")
    found = stage(counted_in_full(pairs, sets, percent), "pair-links")

    roots = components(close.unionByName(found))
    member = stage(alike.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "ngram-members")
    group = stage(member.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("size")),
                  "ngram-components")
    named = stage(attach(member, group, "root", "size", member.count())
                  .select(F.struct("hash_a", "hash_b").alias("set"), "component_id", "n"), "ngram-named")
    full = facts.where("size > 0").select("doc_id", "size", F.struct("hash_a", "hash_b").alias("set"))
    return attach(full, named, "set", "n", facts.count()).select(
        "doc_id", F.col("size").alias("n_shingles"), "component_id").unionByName(
        facts.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _met(columns: DataFrame) -> DataFrame:
    """Rows of the columns in which two clusters meet, and of those with over ``HELD_PAIRS`` rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passed = [np.zeros(0, np.int64)] * 4, None
        names = ["key", "node", "cluster", "size"]

        def told(rows: list[np.ndarray]) -> pa.RecordBatch:
            first = np.flatnonzero(np.append(True, np.diff(rows[0]) != 0))
            sizes = np.diff(np.append(first, len(rows[0])))
            several = np.minimum.reduceat(rows[2], first) != np.maximum.reduceat(rows[2], first)
            keep = np.repeat(several | (rows[0][first] == passed), sizes)
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in rows], names)

        for batch in batches:
            held = [np.concatenate([x, batch.column(c).to_numpy()]) for x, c in zip(held, names, strict=True)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if cut:
                yield told([x[:cut] for x in held])
                held = [x[cut:] for x in held]
            if len(held[0]) > HELD_PAIRS:  # passed on unseen: nodes of one cluster are not paired later either
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)
                held, passed = [x[:0] for x in held], int(held[0][-1])
            elif len(held[0]) and held[0][0] == passed:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)
                held = [x[:0] for x in held]
        if len(held[0]):
            yield told(held)

    return (columns.repartition("key").sortWithinPartitions("key")
            .mapInArrow(run, "key long, node long, cluster long, size long"))
