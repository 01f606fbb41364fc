"""Source divergence audit: how far the term frequencies of each source lie from those of the language's
other sources and of the whole language, in exact integers.

Terms are counted per document by a translate-table tokenizer and summed by source within each task.
A pair of sources is then summed only over the terms that both have: what the terms of one of them, or
of neither, give follows from counts of counts, as all absent terms of a source share one frequency.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairmill.llm.common import blobs, blocks
from pairmill.llm.skew import attach
from pairmill.sources.staging import spread, stage

#: Letters A-Z become lower case, bytes of other ASCII characters become spaces, the rest stays.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))
#: Terms a task holds before it passes their counts on, and bytes of a text counted at once.
HELD_TERMS = 300_000
PIECE_BYTES = 1 << 20
#: Pairs of rows summed at once, and pairs of groups a task holds before it passes their sums on.
PAIRS = 1 << 20
HELD_PAIRS = 500_000


def terms(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, in lists from pieces of bounded size cut between terms."""
    at = 0
    while at < len(text):
        piece = text[at:at + PIECE_BYTES].translate(LETTERS)
        if at + PIECE_BYTES < len(text):
            cut = piece.rfind(b" ") + 1
            while not cut:  # a term of over a piece's length
                more = text[at:at + 2 * len(piece)].translate(LETTERS)
                cut = more.rfind(b" ") + 1 if at + len(more) < len(text) else len(more)
                piece = more
            piece = piece[:cut]
        at += len(piece)
        yield piece.split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, occurrences ``n`` and documents ``docs``; a term can have a row
    from each task."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        size = 0
        for block in blocks(batches):
            for lang, source, text in zip(block.column("lang").to_pylist(), block.column("source").to_pylist(),
                                          blobs(block.column("text")), strict=True):
                total, docs_ = held[lang, source]
                one = Counter()
                for part in terms(text):
                    one.update(part)
                size -= len(docs_)
                docs_.update(one.keys())
                size += len(docs_)
                for t, n in one.items():
                    total[t] += n
                if size > HELD_TERMS:
                    yield from _told(held)
                    held.clear()
                    size = 0
        yield from _told(held)

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _told(held) -> Iterator[pa.RecordBatch]:
    for (lang, source), (total, docs) in held.items():
        found = list(total)
        for at in range(0, len(found), 50_000):
            part = found[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part)), pa.array([source] * len(part)),
                 pa.array(part, pa.binary()).cast(pa.string()), pa.array([total[t] for t in part], pa.int64()),
                 pa.array([docs[t] for t in part], pa.int64())], ["lang", "source", "term", "n", "docs"])


def share(count: str, total: str, kept: str, scale: int) -> Column:
    """``1 + floor(scale * (count + 1) / (total + kept))``, exact for counts of any size."""
    wide = (f"cast({scale} as decimal(10,0)) * (cast({count} as decimal(19,0)) + 1)"
            f" div cast({total} + {kept} as decimal(19,0))")
    return F.expr(f"1 + case when {count} < {1 << 33} then {scale}L * ({count} + 1) div ({total} + {kept})"
                  f" else {wide} end")


def distance(p: str, q: str) -> Column:
    """``floor((p - q) ** 2 / q)``."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each two groups, the sums over terms both have, of what the distance is and of what the
    other sums counted for these terms as if one group lacked them. Rows come sorted by term."""
    sums: dict[tuple[int, int], list[int]] = {}

    def add(group: np.ndarray, p: np.ndarray, p0: np.ndarray, sizes: np.ndarray) -> None:
        # Each row meets all rows of its term: as many as there are sources, in parts of bounded size.
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        count = np.repeat(sizes, sizes)
        edges = np.searchsorted(np.cumsum(count), np.arange(PAIRS, int(count.sum()) + PAIRS, PAIRS), "right")
        start = 0
        for end in np.unique(np.append(edges, len(group))):
            own = np.arange(start, end)
            start = int(end)
            if not len(own):
                continue
            a = np.repeat(own, count[own])
            inner = np.arange(len(a)) - np.repeat(np.cumsum(count[own]) - count[own], count[own])
            b = first[a] + inner
            plus = _apart(p[a], p[b]) + _apart(p0[a], p0[b])
            minus = _apart(p[a], p0[b]) + _apart(p0[a], p[b])
            pair = np.stack([group[a], group[b]])
            order = np.lexsort(pair[::-1])
            pair = pair[:, order]
            new = np.flatnonzero(np.append(True, (np.diff(pair) != 0).any(0)))
            totals = [np.add.reduceat(v[order], new).tolist() for v in (plus, minus)]
            for s, t, x, y in zip(*pair[:, new].tolist(), *totals, strict=True):
                if s != t:
                    own_sums = sums.setdefault((s, t), [0, 0])
                    own_sums[0] += x
                    own_sums[1] += y

    held: list = [np.zeros(0, object)] + [np.zeros(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate([x, batch.column(c).to_numpy(zero_copy_only=False)])
                for x, c in zip(held, ("key", "gid", "p", "p0"), strict=True)]
        new = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1
        if len(new):
            cut = int(new[-1])
            add(*(x[:cut] for x in held[1:]), np.diff(np.append(0, new)))
            held = [x[cut:] for x in held]
            if len(sums) > HELD_PAIRS:
                yield from _sums(sums)
                sums.clear()
    if len(held[0]):
        add(*held[1:], np.array([len(held[0])]))
    yield from _sums(sums)


def _sums(sums: dict[tuple[int, int], list[int]]) -> Iterator[pa.RecordBatch]:
    found = list(sums.items())
    for at in range(0, len(found), 50_000):
        part = found[at:at + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k, _ in part], pa.int64()) for i in (0, 1)]
            + [pa.array([Decimal(v[0] - v[1]) for _, v in part], pa.decimal128(38, 0))], ["gid", "other", "value"])


def audited(table: DataFrame, least_docs: int = 3, top_terms: int = 200, scale: int = 1_000_000_000) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for each source of a language, its
    distance to each other source (part ``pair``), and the ``top_terms`` terms it uses more than the
    language does, farthest first (part ``term``).

    ``table`` needs ``text``, ``lang`` and ``source``, of which null counts as empty; other columns
    are not read. Terms are runs of letters A-Z, in lower case, and of characters beyond ASCII. A
    language keeps the terms of at least ``least_docs`` of its documents; a group with none of them
    has equal frequencies for all, and a language without kept terms gives the value 0 to each pair.
    Ties are ordered by the item's bytes. Repeated rows count as often as they occur. An empty table
    gives no rows.
    """
    docs = spread(table.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                                 for c in ("lang", "source", "text")]))
    by_source = term_counts(docs).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    word = Window.partitionBy("lang", "term")
    kept = stage(by_source.select("lang", "source", "term", "n", F.sum("docs").over(word).alias("d"),
                                  F.sum("n").over(word).alias("lang_n"),
                                  (F.row_number().over(word.orderBy("source")) == 1).alias("first"))
                 .where(F.col("d") >= least_docs).drop("d"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"),
                                     F.count_if("first").alias("v"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("rows"))
    groups = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "rows", "lang_total", "v"]).withColumns({
        "gid": F.monotonically_increasing_id(), "none": F.lit(0).cast("long")})
    groups = stage(groups.withColumn("p0", F.when(F.col("v") > 0, share("none", "total", "v", scale)).otherwise(1))
                   .drop("none"), "groups")
    facts = groups.select(F.struct("lang", "source").alias("g"), "gid", "total", "lang_total", "v", "p0", "rows")
    met = attach(kept.withColumn("g", F.struct("lang", "source")), facts, "g", "rows", kept.count())
    met = stage(met.withColumns({"p": share("n", "total", "v", scale), "q": share("lang_n", "lang_total", "v", scale)})
                .select("lang", "source", "term", "gid", "n", "p", "p0", "q"), "shares")

    more = met.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                     distance("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)

    spelt = F.struct("lang", "term").alias("key")
    both = (met.select(F.xxhash64("lang", "term").alias("at"), spelt, "gid", "p", "p0")
            .repartition("at").sortWithinPartitions("at", "key")
            .select(F.concat("key.lang", F.lit("\x00"), "key.term").alias("key"), "gid", "p", "p0")
            .mapInArrow(_shared, "gid long, other long, value decimal(38,0)"))
    # What a group's terms give with another group's frequency of absent terms, both ways round.
    times = met.groupBy("lang", "gid", "p").agg(F.count("*").alias("times"))
    one = groups.select("lang", "gid", "p0", "rows", "v")
    other = one.select("lang", *[F.col(c).alias(f"{c}_b") for c in ("gid", "p0", "rows")])
    alone = times.join(other, "lang").where("gid <> gid_b")

    def summed(count: str, p: str, q: str) -> Column:
        wide = F.expr(f"cast({count} as decimal(19,0))") * distance(p, q).cast("decimal(19,0)")
        return wide.cast("decimal(38,0)").alias("value")

    forth = alone.select("gid", F.col("gid_b").alias("other"), summed("times", "p", "p0_b"))
    back = alone.select(F.col("gid_b").alias("gid"), F.col("gid").alias("other"), summed("times", "p0_b", "p"))
    neither = one.join(other, "lang").where("gid <> gid_b").select(
        "gid", F.col("gid_b").alias("other"), summed("v - rows - rows_b", "p0", "p0_b"))
    value = (both.unionByName(forth).unionByName(back).unionByName(neither)
             .groupBy("gid", "other").agg(F.sum("value").cast("long").alias("value")))
    named = groups.select("gid", "lang", "source")
    pairs = (value.join(named, "gid")
             .join(groups.select(F.col("gid").alias("other"), F.col("source").alias("item")), "other")
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
             .withColumn("rank", F.row_number().over(order)))
    return pairs.unionByName(more)
