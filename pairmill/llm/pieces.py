"""N-best segmentation into the pieces of a SentencePiece model, and decoding.

No piece of the vocabulary goes on after a letter with a blank, so a text's lattice is a chain of
units: blanks with the word behind them. In a unit, forward Viterbi scores are the exact rest costs
of a backward A* search: the best segmentation comes out first, then the second, and so on. Of a
text's N best, each differs from the best only in the N - 1 units with the least loss.

The forward pass runs over all new units of a block at once, place by place. Where a model file ranks its
pieces by merges, it has no probabilities; they are then taken from Zipf's rule, by which the piece of
rank r has a share in proportion to 1 / r. The model's own encoding by merges is given beside the search's.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pairmill.llm.common import BLOCK_BYTES, blobs, blocks, remembered, texts
from pairmill.llm.tokens import tokenizer_path

BLANK = "▁"
UNIT = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
MAX_CACHED_CHARS = 48
#: Longest unit of the common forward pass; units in one pass; units whose N best a worker remembers.
MAX_CHARS, PASS_UNITS, HELD_WAYS = 256, 40_000, 50_000

Path = tuple[float, tuple[int, ...]]


class Pieces:
    """The vocabulary of a model file, and searches over it."""

    def __init__(self, path: str, cached: int = 300_000):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(self.names) if not special[i]}
        given = [sp.get_score(i) for i in range(n)]
        if all(x == round(x) for x in given):  # ranks of merges
            whole = math.log(sum(1 / r for r in range(1, n + 1)))
            given = [-math.log(1 - min(x, 0)) - whole for x in given]
        # Multiples of 2 ** -20, so that sums are exact in any order and equal scores stay equal.
        self.scores = [round(x * (1 << 20)) / (1 << 20) for x in given]
        self.library = sp
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids):
            raise ValueError("a piece goes on after a letter with a blank")
        self.bytes_at = self.names.index("<0x00>")
        self.longest = max(map(len, self.ids))
        self.spelt = [bytes([i - self.bytes_at]) if 0 <= i - self.bytes_at < 256 else p.encode()
                      for i, p in enumerate(self.names)]
        #: Every start of a piece, with the piece's id where it is one itself.
        self.starts = {p[:k]: -1 for p in self.ids for k in range(1, len(p))} | self.ids
        self.unknown = min(self.scores) - 10
        self.cached = cached
        self.neighbours = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.parts: dict[str, tuple[bytes, float, float, int]] = {}
        self.known_ways: dict[str, list[Path]] = {}
        self._trie()
        self.forget()

    def _trie(self) -> None:
        """Starts of pieces as numbers: ``steps`` has number of a start and next letter, sorted, and ``to``
        the longer start; ``piece`` its id, or -1."""
        number = {"": 0} | {x: i for i, x in enumerate(sorted(self.starts), 1)}
        own = sorted((number[x[:-1]] << 21 | ord(x[-1]), number[x]) for x in self.starts)
        self.steps, self.to = (np.array(x, np.int64) for x in zip(*own, strict=True))
        self.piece = np.full(len(number), -1)
        for x, i in self.ids.items():
            self.piece[number[x]] = i
        self.score_of = np.array(self.scores)

    def forget(self) -> None:
        """Row 0 of what is known about units stays free."""
        self.rows: dict[str, int] = {}
        self.held = 0
        self.score, self.loss = np.zeros(1), np.zeros(1)
        #: Ids of the best segmentation, and of the library's, with the place of each unit's first.
        self.best_ids, self.own_ids = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.best_at, self.own_at = np.zeros(2, np.int64), np.zeros(2, np.int64)

    def learn(self, units: set[str]) -> None:
        """Search the units that are new."""
        if len(self.rows) > self.cached or self.held > BLOCK_BYTES:
            self.forget()
        if len(self.parts) > self.cached:
            self.parts.clear()
        new = list(units - self.rows.keys())
        for at in range(0, len(new), PASS_UNITS):
            part = new[at:at + PASS_UNITS]
            part.sort(key=len)  # those beyond the common pass stand last
            self.held += sum(map(len, part))
            cut = next((i for i, u in enumerate(part) if len(u) > MAX_CHARS), len(part))
            found = [self.forward(part[:cut])] if cut else []
            for unit in part[cut:]:
                ids, score, loss, n = self._unit(unit)
                found.append((np.frombuffer(ids, "<u4"), np.array([n]), np.array([score]), np.array([loss])))
            # The library puts a blank before each text; one blank alone would be an empty one.
            own = self.library.encode([u[1:].replace(BLANK, " ") for u in part], num_threads=1)
            own = [ids if u != BLANK else [self.ids[BLANK]] for u, ids in zip(part, own, strict=True)]
            self.rows.update(zip(part, range(len(self.score), len(self.score) + len(part)), strict=True))
            self.score = np.concatenate([self.score, *(f[2] for f in found)])
            self.loss = np.concatenate([self.loss, *(f[3] for f in found)])
            self.best_ids = np.concatenate([self.best_ids, *(f[0] for f in found)])
            sizes = np.concatenate([f[1] for f in found])
            self.best_at = np.append(self.best_at, self.best_at[-1] + np.cumsum(sizes))
            flat = np.fromiter(chain.from_iterable(own), np.uint32)
            self.own_ids = np.concatenate([self.own_ids, flat])
            self.own_at = np.append(self.own_at, self.own_at[-1] + np.cumsum([len(ids) for ids in own]))

    def forward(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each unit the ids of the best segmentation (all in one array), their number, the score and
        the loss of the second best. All units advance together, by places from their starts.

        Forward scores are exact, so the second best way leaves the best one at the place of it where
        the best two ways in lie closest. Of equal scores the longest piece counts, as in ``n_best``.
        """
        letters = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, units), np.int64, len(units))
        unit = np.repeat(np.arange(len(units)), size)
        end = np.cumsum(size)[unit]
        # Edges of the lattice: start, letters and id, walking the trie from all places at once.
        at, state = np.arange(len(letters)), np.zeros(len(letters), np.int64)
        edges, alone = [], np.ones(len(letters), bool)
        for n in range(1, self.longest + 1):
            inside = at + n <= end[at]
            at, state = at[inside], state[inside]
            key = state << 21 | letters[at + n - 1]
            found = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            hit = self.steps[found] == key
            at, state = at[hit], self.to[found[hit]]
            if not len(at):
                break
            ids = self.piece[state]
            full = ids >= 0
            edges.append((at[full], np.full(int(full.sum()), n), ids[full]))
            if n == 1:
                alone[at[full]] = False
        alone = np.flatnonzero(alone)
        edges.append((alone, np.ones(len(alone), np.int64), np.full(len(alone), -1)))
        start, n, ids = (np.concatenate(x) for x in zip(*edges, strict=True))
        gain = np.where(ids >= 0, self.score_of[ids], self.unknown)
        place = start + n - (end - size[unit])[start]  # from the unit's start
        source, target = start + unit[start], start + n + unit[start]  # a unit has one node more than letters
        order = np.lexsort((start, target, place))
        place, source, target, gain, ids, start = (x[order] for x in (place, source, target, gain, ids, start))
        nodes = len(letters) + len(units)
        best, second, back = np.full(nodes, -np.inf), np.full(nodes, -np.inf), np.zeros(nodes, np.int64)
        first = np.cumsum(size + 1) - size - 1
        best[first] = 0
        edge = np.searchsorted(place, np.arange(1, int(size.max()) + 2))
        for a, b in pairwise(edge.tolist()):
            value, to = best[source[a:b]] + gain[a:b], target[a:b]
            new = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            group = np.repeat(np.arange(len(new)), np.diff(np.append(new, b - a)))
            top = np.maximum.reduceat(value, new)
            which = np.flatnonzero(value == top[group])
            which = which[np.append(True, group[which[1:]] != group[which[:-1]])]
            best[to[new]], back[to[new]] = top, a + which
            value[which] = -np.inf
            second[to[new]] = np.maximum.reduceat(value, new)
        # Back along the best ways, all units at once.
        here, loss = first + size, np.full(len(units), np.inf)
        steps, active = [], np.arange(len(units))
        while len(active):
            own = here[active]
            loss[active] = np.minimum(loss[active], best[own] - second[own])
            steps.append((active, back[own]))
            here[active] = source[back[own]]
            active = active[here[active] > first[active]]
        owner, taken = (np.concatenate(x[::-1]) for x in zip(*steps, strict=True))
        order = np.argsort(owner, kind="stable")
        owner, taken = owner[order], taken[order]
        out, unknown = ids[taken], np.flatnonzero(ids[taken] < 0)
        if len(unknown):  # spelt in bytes
            spelt = [chr(c).encode() for c in letters[start[taken[unknown]]].tolist()]
            width = np.ones(len(out), np.int64)
            width[unknown] = list(map(len, spelt))
            out, owner = np.repeat(out, width), np.repeat(owner, width)
            out[out < 0] = self.bytes_at + np.frombuffer(b"".join(spelt), np.uint8).astype(np.int64)
        return (out.astype(np.uint32), np.bincount(owner, minlength=len(units)), best[first + size], loss)

    def lattice(self, unit: str) -> tuple[list[float], list[list[tuple[int, float, tuple[int, ...]]]]]:
        """Best score up to each place, and the pieces that end there. A character that no piece
        stands for alone can be spelt in bytes."""
        n, get, scores = len(unit), self.starts.get, self.scores
        best, ends = [0.0] + [-np.inf] * n, [[] for _ in range(n + 1)]
        for start in range(n):
            base = best[start]
            for stop in range(start + 1, n + 1):
                i = get(unit[start:stop])
                if i is None:
                    break
                if i >= 0:
                    ends[stop].append((start, scores[i], (i,)))
                    if base + scores[i] > best[stop]:
                        best[stop] = base + scores[i]
            c = unit[start]
            if c not in self.ids:
                ends[start + 1].append((start, self.unknown, tuple(self.bytes_at + b for b in c.encode())))
                best[start + 1] = max(best[start + 1], base + self.unknown)
        return best, ends

    def n_best(self, unit: str, n: int) -> list[Path]:
        """The n best segmentations with their scores. Of equal scores the one that is nearer to its
        start goes on, so ties take no more steps than pieces."""
        best, ends = self.lattice(unit)
        agenda: list[tuple[float, int, int, float]] = [(-best[-1], len(unit), 0, 0.0)]
        trail: list[tuple[int, tuple[int, ...]]] = [(0, ())]  # the step behind each one, and its ids
        found: list[Path] = []
        while agenda and len(found) < n:
            _, at, step, score = heapq.heappop(agenda)
            if not at:
                path: list[int] = []
                while step:
                    step, ids = trail[step]
                    path += ids
                found.append((score, tuple(path)))
                continue
            for start, gain, ids in ends[at]:
                heapq.heappush(agenda, (-(best[start] + score + gain), start, len(trail), score + gain))
                trail.append((step, ids))
        return found

    def _part(self, part: str) -> tuple[bytes, float, float, int]:
        """Ids and score of the best segmentation, the loss of the second, and the pieces.

        Forward scores are exact, so the backward search leaves the best path for the second at the
        place of it where the best two ways in lie closest; the search itself is not needed for
        that. Of equal scores the longest piece counts, as in ``n_best``."""
        n, get, scores, ids = len(part), self.starts.get, self.scores, self.ids
        best, second = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1)
        back: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (n + 1)
        for start in range(n):
            base = best[start]
            for stop in range(start + 1, n + 1):
                i = get(part[start:stop])
                if i is None:
                    break
                if i >= 0:
                    score = base + scores[i]
                    if score > best[stop]:
                        second[stop], best[stop], back[stop] = best[stop], score, (start, (i,))
                    elif score > second[stop]:
                        second[stop] = score
            c = part[start]
            if c not in ids:
                score, stop = base + self.unknown, start + 1
                if score > best[stop]:
                    second[stop], best[stop] = best[stop], score
                    back[stop] = start, tuple(self.bytes_at + b for b in c.encode())
                elif score > second[stop]:
                    second[stop] = score
        loss, at, path = np.inf, n, []
        while at:
            loss = min(loss, best[at] - second[at])
            at, step = back[at]
            path.append(step)
        found = [i for step in reversed(path) for i in step]
        return struct.pack(f"<{len(found)}I", *found), best[n], loss, len(found)

    def _unit(self, unit: str) -> tuple[bytes, float, float, int]:
        """As ``_part``. No piece crosses from one part of a unit to the next: the neighbours
        there stand together in no piece. Parts come again more often than units."""
        whole = self.neighbours
        cuts = [0, *[i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in whole], len(unit)]
        found = []
        for start, stop in pairwise(cuts):
            part = unit[start:stop]
            got = self.parts.get(part)
            if got is None:
                got = self._part(part)
                if len(part) <= MAX_CACHED_CHARS:
                    self.parts[part] = got
            found.append(got)
        if len(found) == 1:
            return found[0]
        ids, scores, losses, sizes = zip(*found)
        return b"".join(ids), sum(scores), min(losses), sum(sizes)

    def text(self, text: str, n: int) -> tuple[bytes, list[float], list[list[tuple[int, tuple[int, ...]]]], bytes]:
        """Ids of the best segmentation of a text, the scores of its n best, and how each of them differs:
        numbers of units and their ids; and the ids of the library's encoding."""
        units = units_of(text)
        self.learn(set(units))
        return self.combined(units, n)

    def combined(self, units: list[str], n: int) -> tuple[bytes, list[float], list[list[tuple[int, tuple[int, ...]]]], bytes]:
        """``text`` of units that are known."""
        rows = np.fromiter(map(self.rows.__getitem__, units), np.int64, len(units))
        loss = self.loss[rows]
        near = np.argsort(loss, kind="stable")[:n - 1]
        choices = []
        for i in sorted(near.tolist()):
            if loss[i] < np.inf:
                ways = self._ways(units[i], n)
                choices.append((i, [(score - ways[0][0], ids) for score, ids in ways]))
        return (gathered(self.best_ids, self.best_at, rows), *_combined(float(self.score[rows].sum()), choices, n),
                gathered(self.own_ids, self.own_at, rows))

    def _ways(self, unit: str, n: int) -> list[Path]:
        found = self.known_ways.get(unit)
        if found is None or len(found) < n:
            found = self.n_best(unit, n)
            if len(unit) <= MAX_CACHED_CHARS:
                if len(self.known_ways) >= HELD_WAYS:
                    self.known_ways.clear()
                self.known_ways[unit] = found
        return found[:n]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: bytes join to characters, blanks become spaces, the first is dropped."""
        out = b"".join(map(self.spelt.__getitem__, ids))
        return out.decode(errors="replace").replace(BLANK, " ")[1:]


def units_of(text: str) -> list[str]:
    return UNIT.findall(BLANK + text.replace(" ", BLANK)) if text else []


def gathered(ids: np.ndarray, at: np.ndarray, rows: np.ndarray) -> bytes:
    """The ids of the units in ``rows``, one after another, as little-endian bytes."""
    first, size = at[rows], at[rows + 1] - at[rows]
    place = np.arange(int(size.sum())) + np.repeat(first - np.cumsum(size) + size, size)
    return ids[place].astype("<u4").tobytes()


def _combined(total: float, choices: list, n: int) -> tuple[list[float], list]:
    """N best sums of one choice per unit, the best of each being a loss of nothing."""
    best = [(0.0, [])]
    for unit, ways in choices:
        best = heapq.nsmallest(n, ((loss - gain, taken + ([(unit, ids)] if k else []))
                                   for loss, taken in best for k, (gain, ids) in enumerate(ways)),
                               key=lambda x: x[0])
    return [total - loss for loss, _ in best], [taken for _, taken in best]


def pieces(path: str) -> Pieces:
    return remembered(("pieces", path), lambda: Pieces(path))


def segmented(docs: DataFrame, model: str | None = None, n: int = 4, with_ids: bool = False) -> DataFrame:
    """Each document with its ``n`` best segmentations.

    ``n_pieces`` and ``ids_crc32`` (of little-endian unsigned 32-bit ids) are of the best; ``scores`` has
    the scores of all, best first (fewer where there are fewer); ``changed`` the units (from 0) in
    which each differs from the best; ``round_trip`` tells whether the best decodes to the text (a
    text that has the blank sign itself does not). ``own_pieces`` and ``own_crc32`` are of the library's
    encoding by the model's own rules. A null or empty text has no pieces and one
    segmentation of score 0. ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Equal
    texts fare alike; an empty table gives no rows. ``with_ids`` adds the ids of both.
    """
    path = model or tokenizer_path("piece_bpe_32k.model")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for block in blocks(batches):
            given = [data.decode() for data in blobs(block.column("text"))]
            units = [units_of(t) for t in given]
            vocabulary.learn(set().union(*units))
            rows = []
            for key, text, parts in zip(block.column("doc_id").to_pylist(), given, units, strict=True):
                ids, scores, changed, own = vocabulary.combined(parts, n)
                back = vocabulary.decode(np.frombuffer(ids, "<u4").tolist()) if text else ""
                rows.append((key, len(ids) // 4, zlib.crc32(ids), scores, [[u for u, _ in c] for c in changed],
                             back == text, len(own) // 4, zlib.crc32(own), ids, own))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.list_(pa.int64())),
                     pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            names = ["doc_id", "n_pieces", "ids_crc32", "scores", "changed", "round_trip", "own_pieces", "own_crc32",
                     "ids", "own_ids"]
            k = 10 if with_ids else 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in list(zip(zip(*rows), kinds))[:k]],
                                             names[:k])

    return texts(docs).mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, scores array<double>, "
                                       "changed array<array<long>>, round_trip boolean, own_pieces long, own_crc32 long"
                                       + ", ids binary, own_ids binary" * with_ids)
