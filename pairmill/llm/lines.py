"""Line dedup: a segment-partition edit join over the distinct lines of a corpus.

Of two lines at ``distance`` edits or fewer, the shorter one cut into ``distance + 1`` segments has
one that stands unedited in the longer one, at nearly the same place. So every line is indexed by its
segments (with length and number), and probes the few substrings that can match a segment of a line
of its own length or up to ``distance`` less. Lines that share a key are verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import blobs, blocks, free_name, numbered, texts, with_found
from pairmill.llm.skew import attach, components
from pairmill.sources.staging import stage

#: Shorter lines are repeats only of equal lines.
LEAST_CHARS = 24
#: Lines of one key that a task compares with each other.
GROUP_ROWS = 512


def segments(length: int, distance: int) -> list[tuple[int, int]]:
    """Start and length of the segments of a line."""
    parts = distance + 1
    cuts = [length * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def probes(length: int, distance: int, least: int) -> list[tuple[int, int, int, int]]:
    """Length and number of the segments to look for, with start and length of the substring.

    Edits left of a segment move it by as many places at most, and those right of it are what
    remains: both bound where the number ``i`` segment can start.
    """
    found = []
    for other in range(max(least, length - distance), length + 1):
        gap = length - other
        for i, (start, size) in enumerate(segments(other, distance)):
            rest = distance - i
            for a in range(max(0, start - i, start + gap - rest),
                           min(length - size, start + i, start + gap + rest) + 1):
                found.append((other, i, a, size))
    return found


def within(a: str, b: str, distance: int) -> bool:
    """Whether the edit distance is at most ``distance``.

    Bit-parallel in a band: bit p of the d-th set says that d edits match the first ``j`` characters
    of ``b`` with the first ``j - distance + p`` of ``a``.
    """
    if abs(len(a) - len(b)) > distance:
        return False
    n = _common(a, b)
    a, b = a[n:], b[n:]
    n = _common(a[::-1], b[::-1])
    a, b = a[:len(a) - n], b[:len(b) - n]
    if not a or not b:
        return True
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i + distance
    band = (1 << 2 * distance + 1) - 1
    sets = [((2 << d) - 1) << distance & band for d in range(distance + 1)]
    for j, c in enumerate(b):
        equal = where.get(c, 0) >> j & band
        before, below = 0, 0
        for d, old in enumerate(sets):
            new = old & equal
            if d:
                new |= (before | before >> 1 | below << 1) & band
            before, below = old, new
            sets[d] = new
        if not below:
            return False
    return bool(sets[distance] >> len(a) - len(b) + distance & 1)


def _common(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _keys(distance: int, least: int):
    """Index and probe keys of the block's distinct lines; the line's lowest bit tells probes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest
        plans: dict[int, list[tuple[int, int, int, int]]] = {}
        for block in blocks(batches):
            lines = set().union(*(t.split(b"\n") for t in blobs(block.column("text"))))
            keys: list[int] = []
            owners: list[int] = []
            for data in lines:
                text = data.decode()
                n = len(text)
                if n < least or not data.split():
                    continue
                plan = plans.get(n)
                if plan is None:
                    if len(plans) > 5_000:
                        plans.clear()
                    plan = plans[n] = [(((n << 5 | i) << 1), a, a + size) for i, (a, size)
                                       in enumerate(segments(n, distance))] + [
                        (((m << 5 | i) << 1 | 1), a, a + size) for m, i, a, size
                        in probes(n, distance, least)]
                line = line_id(data)
                plain = n == len(data)
                for tag, a, b in plan:
                    part = data[a:b] if plain else text[a:b].encode()
                    keys.append(xxh3_64_intdigest(part, tag >> 1))
                    owners.append(line & ~1 | tag & 1)
            for at in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(x[at:at + 100_000], np.uint64).view(np.int64))
                     for x in (keys, owners)], ["key", "line"])
    return run


def line_id(data: bytes) -> int:
    """63 bits of a line's hash; the lowest bit is free."""
    from xxhash import xxh3_64_intdigest
    return xxh3_64_intdigest(data) & ~1


def _lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        keys: list[int] = []
        docs: list[int] = []
        numbers: list[int] = []
        ids: list[int] = []
        for key, doc, text in zip(block.column("key").to_pylist(), block.column("doc_id").to_pylist(),
                                  blobs(block.column("text")), strict=True):
            for i, line in enumerate(text.split(b"\n")):
                if line.split():
                    keys.append(key)
                    docs.append(doc)
                    numbers.append(i)
                    ids.append(line_id(line))
        for at in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x[at:at + 100_000], pa.int64()) for x in (keys, docs, numbers)),
                 pa.array(np.array(ids[at:at + 100_000], np.uint64).view(np.int64))],
                ["key", "doc_id", "line_no", "line"])


def _groups(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[list]:
    """Runs of whole groups, as one list per column; the first two columns name the group."""
    held: list[list] = [[] for _ in columns]
    for batch in batches:
        for x, c in zip(held, columns, strict=True):
            x += batch.column(c).to_pylist()
        n = len(held[0])
        cut = n
        while cut and (held[0][cut - 1], held[1][cut - 1]) == (held[0][-1], held[1][-1]):
            cut -= 1
        if cut:
            yield [x[:cut] for x in held]
            held = [x[cut:] for x in held]
    if held[0]:
        yield held


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, in order of key and line, of keys that an index and a probe of two lines share."""
    held = [np.zeros(0, np.int64)] * 2

    def told(key: np.ndarray, line: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(first, len(key)))
        probing = np.add.reduceat(line & 1, first)
        low, high = np.minimum.reduceat(line >> 1, first), np.maximum.reduceat(line >> 1, first)
        keep = np.repeat((low != high) & (probing > 0) & (probing < sizes), sizes)
        keep &= np.append(True, (key[1:] != key[:-1]) | (line[1:] != line[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(line[keep])], ["key", "line"])

    for batch in batches:
        held = [np.concatenate([x, batch.column(c).to_numpy()])
                for x, c in zip(held, ("key", "line"), strict=True)]
        cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        if cut:
            yield told(*(x[:cut] for x in held))
            held = [x[cut:] for x in held]
    if len(held[0]):
        yield told(*held)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of the lines wanted of each document."""
    for block in blocks(batches):
        ids: list[int] = []
        own: list[str] = []
        for text, places in zip(blobs(block.column("text")), block.column("places").to_pylist(),
                                strict=True):
            if places:
                split = text.split(b"\n")
                for p in places:
                    if p["line_no"] < len(split) and line_id(split[p["line_no"]]) == p["line"] % (1 << 64):
                        ids.append(p["line"])
                        own.append(split[p["line_no"]].decode())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(own, pa.string())],
                                         ["line", "content"])


def _near(role: list[int], text: list[str], distance: int) -> Iterator[tuple[int, int]]:
    """Numbers of an index and a probe of a group that may be close."""
    index = [i for i, r in enumerate(role) if not r]
    bags = _bags([text[i] for i in index]) if len(index) > 4 else None
    for p in (i for i, r in enumerate(role) if r):
        near = index
        if bags is not None:
            apart = np.abs(bags - _bags([text[p]])).sum(1)
            near = [index[k] for k in np.flatnonzero(apart <= 2 * distance).tolist()]
        for i in near:
            yield i, p


def _each(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[Iterator[list[list]]]:
    """The groups of each run of whole groups; the first two columns name the group."""
    def split(held: list[list]) -> Iterator[list[list]]:
        key, pair = held[:2]
        at = 0
        for i in range(1, len(key) + 1):
            if i == len(key) or (key[i], pair[i]) != (key[at], pair[at]):
                yield [x[at:i] for x in held[2:]]
                at = i
    for held in _groups(batches, columns):
        yield split(held)


def _verify(distance: int):
    """Links that join what is close in each group of a key and pair of parts."""
    def group(role: list[int], line: list[int], text: list[str]) -> Iterator[tuple[int, int]]:
        root = {x: x for x in line}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        for i, p in _near(role, text, distance):
            a, b = find(line[i]), find(line[p])
            if a != b and within(text[i], text[p], distance):
                root[max(a, b)] = min(a, b)
                yield line[i], line[p]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _each(batches, ["key", "pair", "role", "line", "content"]):
            found = [x for held in groups for x in group(*held)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64())
                                              for k in (0, 1)], ["a", "b"])
    return run


def _earlier(distance: int):
    """Undecided lines of each group that are close to an earlier one: ``near`` is 1 if one such stays,
    and 0 if all are undecided. One row a line and group at most, however many are close."""
    def group(role: list[int], line: list[int], text: list[str], doc: list[int], number: list[int],
              stays: list[int]) -> dict[int, int]:
        found: dict[int, int] = {}
        if all(stays):
            return found
        for a, b in _near(role, text, distance):
            if (doc[a], number[a]) > (doc[b], number[b]):
                a, b = b, a
            if (not stays[b] and line[a] != line[b] and found.get(line[b], -1) < stays[a]
                    and within(text[a], text[b], distance)):
                found[line[b]] = stays[a]
        return found

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _each(batches, ["key", "pair", "role", "line", "content", "doc", "line_no", "stays"]):
            found = [x for held in groups for x in group(*held).items()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()),
                                              pa.array([f[1] for f in found], pa.int32())], ["line", "near"])
    return run


def _bags(lines: list[str]) -> np.ndarray:
    """Counts of characters in 32 classes: an edit changes at most two counts by one."""
    return np.array([np.bincount(np.frombuffer(x.encode("utf-32-le"), "<u4") & 31, minlength=32)
                     for x in lines], np.int32)


def meetings(docs: DataFrame, firsts: DataFrame, distance: int, least: int) -> tuple[DataFrame, DataFrame]:
    """Groups (``key``, ``pair``) of a ``role`` of each ``line``, in which all close lines meet, and the
    ``content`` of these lines.

    ``docs`` has ``key`` and ``text``, ``firsts`` the first place (``key``, ``line_no``) of each ``line``.
    """
    keys = docs.mapInArrow(_keys(distance, least), "key long, line long")
    hits = stage(keys.repartition("key").sortWithinPartitions("key", "line")
                 .mapInArrow(_shared, "key long, line long"), "shared")
    hits = hits.select("key", F.expr("line & 1").cast("int").alias("role"),
                       F.expr("line & -2").alias("line"))
    places = stage(firsts.join(hits.select("line").distinct(), "line", "left_semi")
                   .groupBy("key").agg(F.collect_list(F.struct("line_no", "line")).alias("places")), "line-places")
    known = stage(with_found(docs, places, "key", others=False)
                  .select("text", "places").mapInArrow(_read, "line long, content string")
                  .dropDuplicates(["line"]), "lines")
    large = stage(hits.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 2 * GROUP_ROWS)
                  .withColumn("parts", F.ceil(F.col("n") / GROUP_ROWS).cast("int")), "large")
    if large.isEmpty():
        dealt = hits.withColumn("pair", F.lit(0))
    else:
        met = attach(hits, large, "key", "n", hits.count()).withColumn(
            "own", F.expr("cast(pmod(xxhash64(line), parts) as int)"))
        others = F.explode(F.expr("filter(sequence(0, parts - 1), i -> i <> own)"))
        dealt = (met.where("parts is null").withColumn("pair", F.lit(0)).drop("parts", "own")
                 .unionByName(met.where("parts is not null").withColumn("other", others)
                              .withColumn("pair", F.expr("least(own, other) * parts + greatest(own, other)")
                                          .cast("int")).drop("parts", "own", "other")))
    return dealt, known


def _grouped(dealt: DataFrame, known: DataFrame) -> DataFrame:
    return dealt.join(known, "line").repartition("key", "pair").sortWithinPartitions("key", "pair", "line")


def close_lines(docs: DataFrame, firsts: DataFrame, distance: int, least: int) -> DataFrame:
    """Links ``a``, ``b`` between distinct lines; what is reachable by close lines stays reachable."""
    return _grouped(*meetings(docs, firsts, distance, least)).mapInArrow(_verify(distance), "a long, b long")


def near_earlier(docs: DataFrame, firsts: DataFrame, distance: int, least: int) -> DataFrame:
    """The ``line`` of those within ``distance`` of an earlier line that is not itself one of them.

    By rounds: what has no close earlier line among the undecided stays, what is close to a line
    that stays after it goes. The earliest undecided line is decided in each, most lines in the first two.
    """
    dealt, known = meetings(docs, firsts, distance, least)
    state = stage(known.select("line").join(firsts, "line").select(
        "line", F.col("key").alias("doc"), "line_no", F.lit(0).alias("near")), "undecided")
    gone = known.select("line").where("false")
    while not state.where("near = 0").isEmpty():
        active = state.where("near is null or near = 0").select(
            "line", "doc", "line_no", F.expr("cast(near is null as int)").alias("stays"))
        told = _grouped(dealt, known.join(active, "line")).mapInArrow(
            _earlier(distance), "line long, near int").groupBy("line").agg(F.max("near").alias("near"))
        state = stage(active.where("stays = 0").drop("stays").join(told, "line", "left"), "undecided")
        gone = gone.unionByName(state.where("near = 1").select("line"))
    return gone


def line_classes(docs: DataFrame, distance: int = 2, least: int = LEAST_CHARS) -> DataFrame:
    """Each line that has a word, with its class and whether it stays.

    Gives ``doc_id``, ``line_no`` (from 0; lines end at ``\\n``), ``class_doc`` and ``class_line`` (the
    earliest line of the class, by ``doc_id`` and number), ``n_equal`` (lines equal to it, itself
    included) and ``kept`` (it is the earliest). Lines of one class are equal, or joined by
    steps of at most ``distance`` edits between lines of ``least`` characters or more.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Null and empty texts and
    blank lines give no row; a null id comes before all others. Rows that repeat an id, or have none,
    are documents of their own, in the order of the table. An empty table gives no rows. Lines are
    told apart by 63 bits of their hash.
    """
    rows = texts(numbered(docs.select("doc_id", "text"), "key"), F.col("key"))
    return line_classes_by_row(rows, distance, least).drop("key")


def _places(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All lines, and of each distinct one the first place and how often it occurs."""
    rows = stage(docs.mapInArrow(_lines, "key long, doc_id long, line_no long, line long"), "places")
    first = F.min(F.struct("key", "line_no", "doc_id")).alias("first")
    return rows, stage(rows.groupBy("line").agg(first, F.count("*").alias("n"))
                       .select("line", "first.key", "first.line_no", "first.doc_id", "n"), "firsts")


def line_classes_by_row(docs: DataFrame, distance: int, least: int) -> DataFrame:
    """``line_classes`` of ``key`` (a number of each row, not null), ``doc_id`` and ``text``; gives the
    ``key`` too, by which it judges what is earliest."""
    rows, firsts = _places(docs)
    first = F.min(F.struct("key", "line_no", "doc_id")).alias("first")
    links = stage(close_lines(docs, firsts, distance, least).distinct(), "close")
    roots = components(links).select(F.col("node").alias("line"), "root")
    member = stage(firsts.join(roots, "line", "left").withColumn("root", F.coalesce("root", "line")),
                   "members")
    classes = stage(member.groupBy("root").agg(first, F.count("*").alias("size"))
                    .select("root", F.col("first.key").alias("class_key"),
                            F.col("first.doc_id").alias("class_doc"),
                            F.col("first.line_no").alias("class_line"), "size"), "classes")
    n_rows = member.count()
    named = stage(attach(member.select("line", "root", "n"), classes, "root", "size", n_rows)
                  .select("line", "class_key", "class_doc", "class_line", "n", F.col("n").alias("n_equal")), "named")
    return attach(rows, named, "line", "n", rows.count()).select(
        "key", "doc_id", "line_no", "class_doc", "class_line", "n_equal",
        F.expr("key = class_key and line_no = class_line").alias("kept"))


def repeated_lines(docs: DataFrame, distance: int, least: int) -> DataFrame:
    """``key`` and ``line_no`` of the lines that ``without_repeated_lines`` removes."""
    rows, firsts = _places(docs)
    gone = near_earlier(docs, firsts, distance, least).withColumn("gone", F.lit(True))
    facts = stage(firsts.join(gone, "line", "left").where("n > 1 or gone").select(
        "line", "n", F.col("key").alias("first_key"), F.col("line_no").alias("first_no"), "gone"), "repeated")
    return attach(rows, facts, "line", "n", rows.count()).where(
        "gone or first_key <> key or first_no <> line_no").select("key", "line_no")


def without_repeated_lines(docs: DataFrame, distance: int = 2, least: int = LEAST_CHARS) -> DataFrame:
    """``docs`` without the lines that equal an earlier one, or are within ``distance`` edits of an
    earlier one that itself stays (both of ``least`` characters or more), and without the documents of
    which nothing is left. What goes is never further than that from what stays. Texts that lose no line stay as they are; all columns stay, and
    ``n_chars``, where there is one, follows the text."""
    name, lost = free_name(docs, "row"), free_name(docs, "gone")
    rows = numbered(docs, name)
    gone = stage(repeated_lines(texts(rows, F.col(name).alias("key")), distance, least)
                 .groupBy(F.col("key").alias(name)).agg(F.collect_set("line_no").alias(lost)), "gone-lines")
    met = with_found(rows, gone, name)
    left = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(lost, i.cast("long")))
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    met = met.withColumn("text", text).where(F.col(lost).isNull() | F.col("text").rlike("\\S"))
    if "n_chars" in docs.columns:
        met = met.withColumn("n_chars", F.when(F.col(lost).isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return met.select(*docs.columns)
