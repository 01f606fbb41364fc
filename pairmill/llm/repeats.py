"""Suffix-array dedup: remove bytes of long strings that also start earlier in the corpus.

All windows of ``size`` bytes are suffixes cut at that length. Sorting every one of them would move
each byte a hundred times, so windows are first brought together by an anchor: the k-gram with the
least hash among the window's own. Equal windows have equal anchors. Neighbouring windows mostly
share theirs, and their bytes together, the context, are one row.

1. Each block of documents finds its contexts; a context that repeats within the block is settled.
2. Contexts meet by anchor. Repeats of a whole context are settled. Of an anchor's different contexts
   those are candidates that go on alike to the left or to the right of it; all other rows end here.
3. The suffixes of an anchor's candidates are deep-shallow sorted; equal neighbours are repeats.
   Anchors with too many candidates for a task are resolved window by window with partial sums.
4. The spans found are joined to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import blobs, blocks, free_name, numbered, remembered, texts, with_found
from pairmill.llm.skew import attach
from pairmill.llm.suffixes import sort_suffixes
from pairmill.sources.staging import stage

GRAM = 32
#: Bytes of text whose windows a task hashes at once; about sixty times as much memory.
BLOCK = 2 << 20
#: Candidates of one anchor that a task sorts.
GROUP_ROWS = 20_000
#: A context's ``place``: from its low end, 7 bits of its number of windows, 12 each of the codes of its right and
#: left side, and its start.
RIGHT, LEFT, START, CODE = 7, 19, 31, 4095

_U = np.uint64
_LETTERS = np.random.default_rng(32).integers(0, 1 << 64, 256, _U)
_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of the 32-gram (a power of two) from each place on."""
    h, step = _LETTERS[raw], 1
    while step < GRAM:
        h = h[:-step] * _U(pow(_BASE, step, 1 << 64)) + h[step:]
        step *= 2
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` neighbours from each place on."""
    span = 1
    while 2 * span <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = width - span
    return np.minimum(keys[:len(keys) - rest], keys[rest:]) if rest else keys


def contexts(pieces: list[bytes], size: int) -> tuple[np.ndarray, ...]:
    """Contexts of texts: piece, first window, number of windows, hashes of anchor and context, and the codes
    of both sides as in ``place``.

    Windows that two contexts share reach half of what is beyond the anchor, or more, on its left or on its
    right. So a side has a code, of the bytes up to there, if a window of the context reaches it, else 0.
    """
    from xxhash import xxh3_64_intdigest
    data = b"".join(pieces)
    if len(data) < size:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U, _U, np.int64))
    ends = np.cumsum([len(p) for p in pieces])
    h = _gram_hashes(np.frombuffer(data, np.uint8))
    keys = (h >> _U(32) << _U(32)) | np.arange(len(h), dtype=_U)  # leftmost of equal ones
    least = _least(keys, size - GRAM + 1)
    inside = np.ones(len(data), bool)
    for end in ends.tolist():
        inside[max(0, end - size + 1):end] = False
    at = np.flatnonzero(inside[:len(least)])
    anchor = (least[at] & _U(0xFFFFFFFF)).astype(np.int64)
    if not len(at):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, _U, _U, np.int64))
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    start, stop = at[first], at[np.append(first[1:], len(at)) - 1] + 1
    digest = np.fromiter((xxh3_64_intdigest(data[a:b]) for a, b in
                          zip(start.tolist(), (stop + size - 1).tolist(), strict=True)), _U, len(start))
    piece = np.searchsorted(ends, start, "right")
    begins = np.append(0, ends[:-1])
    at, half = anchor[first], (size - GRAM + 1) // 2
    sides = np.zeros(len(at), np.int64)
    for shift, to, reached in ((LEFT, at - half, at - start >= half),
                               (RIGHT, at + half, stop - 1 + size - GRAM - at >= half)):
        code = h[np.where(reached, to, 0)] % _U(CODE)
        sides |= np.where(reached, 1 + code.astype(np.int64), 0) << shift
    return piece, start - begins[piece], stop - start, h[at], digest, sides


def _find(size: int, block_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("repeats", dict)  # drops what other operators left in the worker
        for block in blocks(batches, limit=block_bytes):
            pieces, keys, offsets = [], [], []
            for key, text in zip(block.column("key").to_pylist(), blobs(block.column("text")),
                                 strict=True):
                for a in range(0, max(1, len(text) - size + 1), block_bytes):
                    pieces.append(text[a:a + block_bytes + size - 1])
                    keys.append(key)
                    offsets.append(a)
            piece, start, n, anchor, digest, sides = contexts(pieces, size)
            key = np.array(keys, np.int64)[piece]
            start = start + np.array(offsets, np.int64)[piece]
            order = np.lexsort((start, key, digest, anchor))
            key, start, n, anchor, digest, sides = (x[order] for x in (key, start, n, anchor, digest, sides))
            new = np.ones(len(key), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])
            first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            later = (key != key[first]) | (start != start[first])
            spans = _merged(key[later], start[later], n[later] + size - 1)
            new = np.flatnonzero(new)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (
                (anchor[new].view(np.int64), (spans[0].view(_U) * _U(_BASE) + spans[1].view(_U)).view(np.int64)),
                (digest[new].view(np.int64), spans[2]), (key[new], spans[0]),
                (start[new] << START | sides[new] | n[new], spans[1] << START))], ["anchor", "digest", "key", "place"])
    return run


def _merged(key: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans that overlap or touch as one; ends must rise with starts within a document."""
    order = np.lexsort((start, key))
    key, start, end = key[order], start[order], (start + size)[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(key))[:len(first)] - 1
    return key[first], start[first], end[last] - start[first]


def _meet(size: int):
    """Rows in order of anchor, digest, key, place: settles repeats of contexts, names candidates."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passed = [np.zeros(0, np.int64)] * 3, None
        for settled, several in _settle(batches, size):
            held = [np.concatenate(x) for x in zip(held, several, strict=True)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            out = [_alike(*(x[:cut] for x in held), passed)]
            held = [x[cut:] for x in held]
            if len(held[0]) > GROUP_ROWS:  # passed on unseen, with what follows of the anchor
                passed = int(held[0][0])
            if len(held[0]) and held[0][0] == passed:
                out.append(held)
                held = [x[:0] for x in held]
            yield _found(settled + [_candidates(*x) for x in out])
        if len(held[0]):
            yield _found([_candidates(*_alike(*held, passed))])
    return run


def _candidates(anchor: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    return key, place >> START, place & 127, anchor


def _alike(anchor: np.ndarray, key: np.ndarray, place: np.ndarray,
           passed: int | None) -> tuple[np.ndarray, ...]:
    """Different contexts in order of their anchor: those with a side like that of another, and all of
    the anchor ``passed``."""
    group = np.cumsum(np.append(True, anchor[1:] != anchor[:-1])[:len(anchor)])
    keep = np.zeros(len(anchor), bool) if passed is None else anchor == passed
    for shift in (LEFT, RIGHT):
        code = place >> shift & CODE
        _, own, n = np.unique(group << 12 | code, return_inverse=True, return_counts=True)
        keep |= (code > 0) & (n[own] > 1)
    return anchor[keep], key[keep], place[keep]


def _settle(batches: Iterable[pa.RecordBatch],
            size: int) -> Iterator[tuple[list[tuple[np.ndarray, ...]], tuple[np.ndarray, ...]]]:
    """What is settled, and the anchors, keys and places of the first rows of contexts, for anchors with several."""
    held = None  # the first row of the last context; the row that waits for a second context
    for batch in batches:
        anchor, digest, key, place = (batch.column(c).to_numpy() for c in
                                      ("anchor", "digest", "key", "place"))
        settled = place & 127 == 0
        out = [(key[settled], place[settled] >> START, digest[settled], np.zeros(0, np.int64))]
        rows = [x[~settled] for x in (anchor, digest, key, place)]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        held_n = 0 if held is None else len(held[0])
        anchor, digest, key, place = rows
        if not len(anchor):
            yield out, (anchor, key, place)
            continue
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        new = new_anchor | np.append(True, digest[1:] != digest[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        later = (key != key[first]) | (place != place[first])
        out.append((key[later], place[later] >> START, (place[later] & 127) + size - 1,
                    np.zeros(0, np.int64)))
        heads = np.flatnonzero(new)
        opens = new_anchor[heads]
        several = ~opens | np.append(~opens[1:], False)
        told = several & (heads >= held_n)
        if held_n:  # of two held rows, the first told of its anchor's others already
            told[0] = several[0] and held_n == 1
        told = heads[told]
        last = heads[-1]
        # Two rows of one anchor are held where it has several contexts, else one.
        keep = [last] if opens[-1] else [heads[len(heads) - 2], last]
        held = [x[keep] for x in rows]
        yield out, (anchor[told], key[told], place[told])


def _found(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [np.concatenate([p[i] for p in parts]) for i in range(3)]
    anchor = pa.concat_arrays([pa.array(p[3]) if len(p[3]) else pa.nulls(len(p[0]), pa.int64())
                               for p in parts])
    return pa.RecordBatch.from_arrays([*map(pa.array, columns), anchor],
                                      ["key", "start", "size", "anchor"])


def _read_candidates(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            out: tuple[list, ...] = ([], [], [], [])
            for key, text, places in zip(block.column("key").to_pylist(), blobs(block.column("text")),
                                         block.column("places").to_pylist(), strict=True):
                for p in places or ():
                    own = text[p["start"]:p["start"] + p["size"] + size - 1]
                    for x, v in zip(out, (p["anchor"], key, p["start"], own), strict=True):
                        x.append(v)
            for a in range(0, len(out[0]), 20_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[a:a + 20_000], t) for x, t in
                     zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    ["anchor", "key", "start", "context"])
    return run


def _sort_groups(size: int):
    """Contexts in order of their anchor: the windows that equal an earlier one."""
    def settle(anchor: np.ndarray, key: np.ndarray, start: np.ndarray,
               held: list[bytes]) -> pa.RecordBatch:
        lengths = np.array([len(c) for c in held])
        n = lengths - size + 1
        owner = np.repeat(np.arange(len(held)), n)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(np.cumsum(lengths) - lengths, n) + step
        order, equal = sort_suffixes(b"".join(held), at, anchor[owner], size)
        cls = np.cumsum(~equal) - 1
        many = np.append(equal[1:], False) | equal
        order, cls = order[many], cls[many]
        own_key, own_start = key[owner[order]], (start[owner] + step)[order]
        by = np.lexsort((own_start, own_key, cls))
        cls, own_key, own_start = cls[by], own_key[by], own_start[by]
        new = np.append(True, cls[1:] != cls[:-1])[:len(cls)]
        first = np.maximum.accumulate(np.where(new, np.arange(len(cls)), 0))
        later = (own_key != own_key[first]) | (own_start != own_start[first])
        spans = _merged(own_key[later], own_start[later], np.full(int(later.sum()), size))
        return pa.RecordBatch.from_arrays([*map(pa.array, spans)], ["key", "start", "size"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = [np.zeros(0, np.int64)] * 3 + [[]]
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("anchor", "key", "start")]
            held = [np.concatenate(x) for x in zip(held, rows)] + [
                held[3] + batch.column("context").to_pylist()]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if cut:
                yield settle(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if len(held[3]):
            yield settle(*held)
    return run


def _windows(size: int):
    """Every window of the contexts with a digest of its bytes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                own: list[bytes] = []
                keys: list[int] = []
                starts: list[int] = []
                for key, start, text in zip(part.column("key").to_pylist(), part.column("start").to_pylist(),
                                            part.column("context").to_pylist(), strict=True):
                    n = len(text) - size + 1
                    own += [xxh3_128_digest(text[i:i + size]) for i in range(n)]
                    keys += [key] * n
                    starts += range(start, start + n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own, pa.binary()), pa.array(keys, pa.int64()), pa.array(starts, pa.int64())],
                    ["digest", "key", "start"])
    return run


def repeated_spans(docs: DataFrame, size: int) -> DataFrame:
    """``key``, ``start``, ``size`` of strings that also start earlier; spans may overlap.

    ``docs`` has ``key`` (long, not null) and ``text``.
    """
    rows = docs.mapInArrow(_find(size, BLOCK), "anchor long, digest long, key long, place long")
    met = (rows.repartition("anchor").sortWithinPartitions("anchor", "digest", "key", "place")
           .mapInArrow(_meet(size), "key long, start long, size long, anchor long"))
    met = stage(met, "contexts")
    places = stage(met.where("anchor is not null").groupBy("key").agg(
        F.collect_list(F.struct("start", "size", "anchor")).alias("places")), "places")
    candidates = stage(with_found(docs, places, "key", others=False).mapInArrow(
        _read_candidates(size), "anchor long, key long, start long, context binary"), "candidates")
    large = stage(candidates.groupBy("anchor").agg(F.count("*").alias("n"))
                  .where(F.col("n") > GROUP_ROWS).withColumn("large", F.lit(True)), "large")
    found = [met.where("anchor is null").select("key", "start", "size")]
    if not large.isEmpty():
        candidates = attach(candidates, large, "anchor", "n", candidates.count())
        windows = stage(candidates.where("large").mapInArrow(
            _windows(size), "digest binary, key long, start long"), "windows")
        first = stage(windows.groupBy("digest").agg(F.min(F.struct("key", "start")).alias("first"),
                                                    F.count("*").alias("n")), "firsts")
        found.append(attach(windows, first, "digest", "n", windows.count())
                     .where("first <> struct(key, start)")
                     .select("key", "start", F.lit(size).cast("long").alias("size")))
        candidates = candidates.where("large is null")
    found.append(candidates.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _sort_groups(size), "key long, start long, size long"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        rows = []
        for key, text, spans in zip(block.column("key").to_pylist(), blobs(block.column("text")),
                                    block.column("spans").to_pylist(), strict=True):
            runs = kept_runs(len(text), [(s["start"], s["start"] + s["size"]) for s in spans or ()])
            kept = b"".join([text[a:b] for a, b in runs])
            marks = [0, *(x for r in runs for x in r), len(text)]
            gaps = sum(a < b for a, b in zip(marks[::2], marks[1::2], strict=True))
            rows.append((key, len(text), len(text) - len(kept), gaps, hashlib.sha256(kept).hexdigest(),
                         kept))
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 4 + (pa.string(), pa.binary()),
                                            strict=True)],
            ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).add_column(
                1, "doc_id", block.column("doc_id"))


def kept_runs(n: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans leave of ``n`` bytes."""
    runs, at = [], 0
    for a, b in sorted(spans):
        if a > at:
            runs.append((at, min(a, n)))
        at = max(at, b)
        if at >= n:
            break
    if at < n:
        runs.append((at, n))
    return [r for r in runs if r[1] > r[0]]


def without_repeats(docs: DataFrame, size: int = 100) -> DataFrame:
    """Each document without the bytes of ``size``-byte strings that also start earlier: at a smaller
    ``doc_id``, or in the same document before.

    Texts are judged as UTF-8 bytes of the input; matches do not cross documents. Gives ``doc_id``,
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` and the bytes
    ``kept`` (not always valid UTF-8, as a run may begin within a character). ``docs`` needs
    ``doc_id`` and ``text``; other columns are not read. A null text counts as empty, a null id comes
    before all others. Rows that repeat an id, or have none, are documents of their own, in the order
    of the table. An empty table gives no rows. ``size`` is 64 to
    158.
    """
    return without_repeats_by_row(
        texts(numbered(docs.select("doc_id", "text"), "key"), F.col("key")), size).drop("key")


def without_repeats_by_row(docs: DataFrame, size: int = 100) -> DataFrame:
    """``without_repeats`` of ``key`` (a number of each row, not null), ``doc_id`` and ``text``; gives
    the ``key`` too, by which it judges what is earlier."""
    return with_found(docs, _spans(docs, size), "key").mapInArrow(
        _cut, "key long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
              "kept binary")


def _spans(docs: DataFrame, size: int) -> DataFrame:
    if not 64 <= size <= 158:
        raise ValueError("size must be 64 to 158")
    return stage(repeated_spans(docs, size).groupBy("key").agg(
        F.collect_list(F.struct("start", "size")).alias("spans")), "spans")


def without_passages(docs: DataFrame, size: int = 100) -> DataFrame:
    """``docs``, with all columns, but for the bytes that ``without_repeats`` removes, and for the rows of
    which no word is left by that. A character that lost some of its bytes is left out whole. Texts that lose
    nothing stay as they are, null and empty ones too; ``n_chars``, where there is one, follows the text."""
    name, marked = free_name(docs, "row"), free_name(docs, "spans")
    rows = numbered(docs, name)
    spans = _spans(texts(rows, F.col(name).alias("key")), size)
    met = with_found(rows, spans.select(F.col("key").alias(name), F.col("spans").alias(marked)), name)
    at = {c: i for i, c in enumerate(docs.columns)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = {i: s for i, s in enumerate(batch.column(len(at)).to_pylist()) if s}
            batch = batch.select(range(len(at)))
            if cut:
                new, stays = batch.column(at["text"]).to_pylist(), [True] * batch.num_rows
                for i, found in cut.items():
                    data = new[i].encode()
                    runs = kept_runs(len(data), [(s["start"], s["start"] + s["size"]) for s in found])
                    new[i] = b"".join([data[a:b] for a, b in runs]).decode(errors="ignore")
                    stays[i] = bool(new[i].split())
                columns = {"text": pa.array(new, batch.schema.field(at["text"]).type)}
                if "n_chars" in at:
                    kind = batch.schema.field(at["n_chars"])
                    sizes = batch.column(at["n_chars"]).to_pylist()
                    columns["n_chars"] = pa.array([len(new[i]) if i in cut else n for i, n in enumerate(sizes)], kind.type)
                for c, values in columns.items():
                    batch = batch.set_column(at[c], batch.schema.field(at[c]), values)
                batch = batch.filter(pa.array(stays))
            yield batch

    return met.select(*docs.columns, marked).mapInArrow(run, docs.schema)
