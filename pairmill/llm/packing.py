"""Packing documents into training sequences by minimum bin slack.

Each task packs blocks of the documents it has read, so nothing is shuffled. Whole windows are cut
from long documents; what remains of each document is packed by length: the longest remainder opens
a window, and a subset-sum table held in one integer's bits (bit s: some multiset of remaining
lengths adds up to s) tells which lengths fill the window best. Windows that no multiset fills are
laid end to end and cut anew; the last of a block splits into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pairmill.llm.common import blobs, blocks, texts
from pairmill.llm.tokens import encoder, tokenizer_path

Piece = tuple[int, int, int]  # document in the block, first id, ids

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def fill(counts: Counter, capacity: int) -> Counter:
    """The multiset of lengths, within ``counts``, that comes closest to ``capacity`` from below."""
    reach, steps, mask = 1, [], (1 << capacity + 1) - 1
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, take = min(counts[length], capacity // length), 1
        while left:  # 1, 2, 4, ... copies at once reach every number of copies
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, take = left - take, 2 * take
        if reach >> capacity:
            break
    at, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] += take
            at -= length * take
    return chosen


def pack(lengths: list[int], capacity: int) -> Iterator[list[Piece]]:
    """Sequences of pieces that cover each of the documents once.

    Lengths of zero give no piece. All sequences hold ``capacity`` ids, but for at most one of each
    smaller power of two.
    """
    waiting: dict[int, list[int]] = defaultdict(list)
    for doc, n in enumerate(lengths):
        for start in range(0, n - capacity + 1, capacity):
            yield [(doc, start, capacity)]
        if n % capacity:
            waiting[n % capacity].append(doc)
    counts = Counter({n: len(docs) for n, docs in waiting.items()})
    open_pieces: list[Piece] = []
    while counts:
        first = max(counts)
        _take(counts, first, 1)
        chosen = fill(counts, capacity - first)
        for n, k in chosen.items():
            _take(counts, n, k)
        chosen[first] += 1
        pieces = [(doc, lengths[doc] - n, n) for n, k in chosen.items()
                  for doc in (waiting[n].pop() for _ in range(k))]
        if sum(p[2] for p in pieces) == capacity:
            yield pieces
        else:
            open_pieces += pieces
    yield from _cut(open_pieces, capacity)


def _take(counts: Counter, length: int, k: int) -> None:
    counts[length] -= k
    if not counts[length]:
        del counts[length]


def _cut(pieces: list[Piece], capacity: int) -> Iterator[list[Piece]]:
    left = sum(p[2] for p in pieces)
    todo = pieces[::-1]
    while left:
        room = capacity if left >= capacity else 1 << left.bit_length() - 1
        left -= room
        sequence = []
        while room:
            doc, start, n = todo.pop()
            if n > room:
                todo.append((doc, start + room, n - room))
                n = room
            sequence.append((doc, start, n))
            room -= n
        yield sequence


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = 4096,
           end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences of ``capacity`` ids.

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. A null text counts as empty:
    its document is the end id alone. Each row is a document, so rows that repeat an id or a text
    are packed each for itself; an empty table gives no pieces. ``with_ids`` adds the ids.
    """
    path = tokenizer or tokenizer_path()
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        coder = encoder(path)
        for block in blocks(batches):
            names = block.column("doc_id").to_pylist()
            ids = [coder.encode(t) + end for t in blobs(block.column("text"))]
            rows = []
            for pieces in pack([len(i) // 4 for i in ids], capacity):
                offset = 0
                for doc, start, n in pieces:
                    own = ids[doc][4 * start:4 * (start + n)]
                    rows.append((names[doc], start, n, zlib.crc32(own), len(ids[doc]) // 4,
                                 sequence, offset, own))
                    offset += n
                sequence += 1
            columns = list(zip(*rows, strict=True))
            for at in range(0, len(rows), 4096):
                part = [pa.array(c[at:at + 4096], pa.int64()) for c in columns[:7]]
                if with_ids:
                    part.append(pa.array(columns[7][at:at + 4096], pa.binary()))
                yield pa.RecordBatch.from_arrays(part, fields)

    fields = [f.split()[0] for f in SCHEMA.split(", ")] + ["ids"] * with_ids
    return texts(docs).mapInArrow(run, SCHEMA + ", ids binary" * with_ids)
