"""Language identification of mixed texts: script ranges, word scores and a Viterbi path."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmill.llm.common import BLOCK_BYTES, blobs, blocks, remembered, texts
from pairmill.sources.staging import spread

GRAM_BITS = 14
STEP_PIECES = 20_000
#: Bytes of text that are labelled at once.
TEXT_BYTES = 4 << 20
#: Score of a language that is no candidate.
NEVER = -1e9
#: Letters that are scored together; what is longer gives several chunks.
CHUNK = 40
#: First code points of ranges, and the script of each (0: none in particular).
SCRIPTS = ((0, 1), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x780, 0), (0x900, 7),
           (0x980, 8), (0xA00, 0), (0xE00, 9), (0xE80, 0), (0x10A0, 10), (0x1100, 11), (0x1200, 0),
           (0x1E00, 1), (0x1F00, 2), (0x2000, 1), (0x2E80, 12), (0x3040, 13), (0x3100, 12), (0xAC00, 11),
           (0xD7B0, 0), (0xF900, 12), (0xFB00, 1), (0xFB50, 6), (0xFE00, 0), (0xFF21, 1), (0xFF66, 13),
           (0xFFA0, 0), (0x20000, 12), (0x32000, 0))
N_SCRIPTS = 14
_EDGES = np.array([s[0] for s in SCRIPTS], np.uint64)
_SCRIPTS = np.array([s[1] for s in SCRIPTS])
#: Odd multipliers and marks of the gram hash.
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_TRIPLE, _WHOLE = np.uint64(1 << 40), np.uint64(1 << 41)


def letters_of(piece: bytes) -> str:
    """The letters of a white-space separated piece, in lower case."""
    word = piece.decode().lower().strip(".,;:!?\"'()")
    return word if word.isalpha() else "".join([c for c in word if c.isalpha()])


def _runs() -> re.Pattern[str]:
    """Up to ``CHUNK`` letters of one script. Modifier letters go with those before them."""
    own: dict[int, str] = {}
    for (start, script), stop in zip(SCRIPTS, [s[0] for s in SCRIPTS[1:]] + [0x110000], strict=True):
        own[script] = own.get(script, "\\u02b0-\\u02ff") + f"\\U{start:08x}-\\U{stop - 1:08x}"
    return re.compile("|".join(f"[{ranges}]{{1,{CHUNK}}}" for ranges in own.values()))


_RUNS = _runs()


def chunks(word: str) -> list[str]:
    """A word's letters, cut where the script changes and after ``CHUNK`` letters of one script."""
    if len(word) <= CHUNK and word.isascii():
        return [word] if word else []
    return _RUNS.findall(word)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words' pairs and triples of letters, edges marked, and of the words themselves;
    how many of them each word has; and each word's script. Words are what ``chunks`` gives."""
    points = np.frombuffer("".join([f"^{w[:CHUNK]}$" for w in words]).encode("utf-32-le"), np.uint32)
    points = np.append(points, np.uint32([0, 0])).astype(np.uint64)
    sizes = np.fromiter((min(len(w), CHUNK) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    at = np.arange(len(points) - 2)
    place = at - np.repeat(starts, sizes)
    left = np.repeat(sizes, sizes) - place  # letters from here to the end, edge included
    pairs = points[:-2] * _STEP + points[1:-1]
    powers = np.cumprod(np.full(CHUNK + 2, _STEP, np.uint64), dtype=np.uint64)
    whole = np.add.reduceat(points[:-2] * powers[place], starts)
    # A word's grams stand together: at each place the pair, the triple, and at the edge the word.
    table = np.stack([pairs, (pairs * _STEP + points[2:]) ^ _TRIPLE, np.zeros_like(pairs)], 1)
    table[starts, 2] = whole ^ _WHOLE
    real = np.stack([left > 1, left > 2, place == 0], 1)
    keys = table[real]
    keys = (keys ^ keys >> np.uint64(32)) * _MIX
    scripts = _SCRIPTS[np.searchsorted(_EDGES, points[starts + 1], "right") - 1]
    return (keys >> np.uint64(64 - GRAM_BITS)).astype(np.int64), 2 * sizes - 2, scripts


class Model(NamedTuple):
    """``scores``: log probability of each gram by language; ``scripts``: which languages are candidates
    for letters of a script; ``known``: scripts that have any; ``common``: the most frequent
    language's number."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray
    known: np.ndarray
    common: int


def training_sample(rows: DataFrame, max_rows: int) -> DataFrame:
    """``lang`` and ``text`` of at most ``max_rows`` different labelled texts, copies counted once.

    Texts are ranked by hash within their language, and taken by rank: a language gets an equal
    share, or all of its texts where it has fewer. Whole texts are read for the sample alone.
    """
    rows = rows.select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("text").alias("h")).where(
        "text is not null and lang is not null")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h")).alias("rank")
    chosen = (rows.select("lang", "h").distinct().select("lang", "h", rank).where(F.col("rank") <= max_rows)
              .orderBy("rank", "h", "lang").limit(max_rows).select("lang", "h"))
    return rows.join(F.broadcast(chosen), ["lang", "h"], "left_semi").groupBy("lang", "h").agg(
        F.first("text").alias("text")).select("lang", "text")


def learned(rows: DataFrame, max_rows: int = 20_000) -> Model:
    """Model of ``text`` and ``lang``, from ``training_sample``. What reaches the driver is one count per
    language and gram or script, and the rows of each language."""
    sample = training_sample(rows, max_rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            pieces: dict[str, Counter] = {}
            for lang, text in zip(block.column("lang").to_pylist(), blobs(block.column("text")), strict=True):
                pieces.setdefault(lang, Counter()).update(text.split())
            for lang, seen in pieces.items():
                found = [(w, n) for p, n in seen.items() for w in chunks(letters_of(p))]
                if not found:
                    continue
                times = np.array([n for _, n in found])
                ids, sizes, scripts = grams([w for w, _ in found])
                own = np.append(np.bincount(ids, np.repeat(times, sizes), 1 << GRAM_BITS),
                                np.bincount(scripts, times, N_SCRIPTS)).astype(np.int64)
                at = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at),
                                                  pa.array(own[at])], ["lang", "gram", "n"])

    totals = (sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram")
              .agg(F.sum("n").alias("n")).toPandas())
    languages = sorted(totals["lang"].unique())
    sizes = {r.lang: r.n for r in rows.groupBy(F.col("lang").cast("string").alias("lang")).agg(
        F.count("text").alias("n")).collect()}
    number = {x: i for i, x in enumerate(languages)}
    table = np.zeros(((1 << GRAM_BITS) + N_SCRIPTS, len(languages)))
    table[totals["gram"], totals["lang"].map(number)] = totals["n"]
    text, scripts = table[:1 << GRAM_BITS] + 0.5, table[1 << GRAM_BITS:]
    scores = np.log(text / text.sum(0)) if languages else text
    # A language is a candidate for a script with a hundredth of the script's words, or of its own.
    uses = (scripts >= 0.01 * scripts.sum(1, keepdims=True)) | (scripts >= 0.01 * scripts.sum(0))
    uses &= scripts > 0
    common = max(range(len(languages)), key=lambda i: sizes[languages[i]], default=0)
    return Model(languages, scores, uses, uses.any(1), common)


class Words(dict):
    """Piece to row of ``scores``, ``letters`` and ``told`` (its script is known); row 0 is for pieces without letters. A piece of
    several chunks has ``~k`` instead, and their rows in ``several[k]``."""

    def __init__(self, model: Model, cap: float):
        super().__init__()
        self.model, self.cap = model, cap
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.used, self.held = 1, 0
        self.several: list[np.ndarray] = []
        self.scores = np.zeros((1 << 14, len(self.model.languages)), np.float32)
        self.letters = np.zeros(1 << 14, np.int32)
        self.told = np.zeros(1 << 14, bool)

    def add(self, pieces: set[bytes]) -> None:
        """Score pieces that are new, ``STEP_PIECES`` at a time."""
        new = list(pieces - self.keys())
        self.held += sum(map(len, new))
        for start in range(0, len(new), STEP_PIECES):
            part = new[start:start + STEP_PIECES]
            found: list[str] = []
            for p in part:
                own = chunks(letters_of(p))
                row = self.used + len(found)
                if len(own) > 1:
                    self[p] = ~len(self.several)
                    self.several.append(np.arange(row, row + len(own)))
                else:
                    self[p] = row if own else 0
                found += own
            for at in range(0, len(found), STEP_PIECES):
                self._score(found[at:at + STEP_PIECES])

    def steps(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a text's chunks, and the number of the piece that each is of."""
        rows = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        cut = np.flatnonzero(rows < 0)
        if not len(cut):
            return rows, np.arange(len(rows))
        parts = [self.several[~k] for k in rows[cut].tolist()]
        sizes = np.ones(len(rows), np.int64)
        sizes[cut] = list(map(len, parts))
        piece = np.repeat(np.arange(len(rows)), sizes)
        own = rows[piece]
        own[own < 0] = np.concatenate(parts)
        return own, piece

    def _score(self, words: list[str]) -> None:
        stop = self.used + len(words)
        if stop > len(self.letters):
            more = max(stop, 2 * len(self.letters)) - len(self.letters)
            self.scores = np.concatenate([self.scores, np.zeros((more, self.scores.shape[1]), np.float32)])
            self.letters = np.concatenate([self.letters, np.zeros(more, np.int32)])
            self.told = np.concatenate([self.told, np.zeros(more, bool)])
        self.letters[self.used:stop] = [len(w) for w in words]
        if self.model.languages:
            ids, sizes, scripts = grams(words)
            # Grams of a word overlap, so their sum counts the same evidence about thrice.
            own = np.add.reduceat(self.model.scores[ids], np.cumsum(sizes) - sizes) / 3
            # The script leaves candidates; what others would score doesn't count, and no path can take them.
            candidate = self.model.scripts[scripts]
            own = np.where(candidate, own, NEVER)
            own = np.where(candidate, np.maximum(own - own.max(1, keepdims=True), -self.cap), NEVER)
            told = self.model.known[scripts]
            own[~told] = 0
            self.scores[self.used:stop] = own
            self.told[self.used:stop] = told
        self.used = stop


def viterbi(ids: list[np.ndarray], scores: np.ndarray, penalty: float) -> list[np.ndarray]:
    """The best language of each word of each text, where each change of language costs ``penalty``.

    All texts advance together, word by word, the longest first.
    """
    order = sorted(range(len(ids)), key=lambda i: -len(ids[i]))
    lengths = np.array([len(ids[i]) for i in order])
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts longer than t
    offsets = np.append(0, np.cumsum(active))
    flat = np.zeros(int(offsets[-1]), np.int32)
    for rank, i in enumerate(order):
        flat[offsets[:len(ids[i])] + rank] = ids[i]
    n_langs = scores.shape[1]
    value = np.zeros((len(order), n_langs))
    back = np.zeros((len(flat), n_langs), np.uint8 if n_langs < 256 else np.int32)
    own = np.arange(n_langs)
    for t in range(steps):
        a, b = offsets[t], offsets[t + 1]
        v = value[:b - a]
        best = v.max(1, keepdims=True) - penalty
        stay = v >= best
        back[a:b] = np.where(stay, own, v.argmax(1)[:, None])
        np.maximum(v, best, out=v)
        v += scores[flat[a:b]]
    state = value.argmax(1)
    labels = np.zeros(len(flat), back.dtype)
    for t in range(steps - 1, -1, -1):
        a, b = offsets[t], offsets[t + 1]
        labels[a:b] = state[:b - a]
        state[:b - a] = back[np.arange(a, b), state[:b - a]]
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
    for rank, i in enumerate(order):
        out[i] = labels[offsets[:len(ids[i])] + rank]
    return out


def identified(docs: DataFrame, training: DataFrame, penalty: float = 12.0, cap: float = 6.0,
               max_rows: int = 20_000) -> DataFrame:
    """Each document with ``lang_pred``, ``score`` and ``spans`` of one language each.

    The script of a chunk of letters leaves the languages that use it as candidates; among these, letter grams
    score at most ``cap`` below the best, and a change of language costs ``penalty``. The model is learned
    from at most ``max_rows`` different texts of ``training``, in equal shares by language.

    ``lang_pred`` is the language of most letters, ``score`` its share of them; a tie goes to the first
    name. A text that is null or has no letter is ``und`` with score 0. Letters of scripts that no
    training text has say nothing: a text of such alone gets the most frequent language with score 0.
    ``spans`` gives language, first word and number of words; words are what stands between white space.
    Scripts without spaces, and any run of letters, are labelled by chunks of at most ``CHUNK`` letters of one
    script, so a span can start within a word: ``skip`` letters of its first word are of spans before, and
    ``letters`` are its own. A word that spans share counts in each. ``docs`` needs ``doc_id`` and
    ``text``, ``training`` ``text`` and ``lang``; no other column is read. Equal texts are labelled alike;
    an empty table gives no rows; without training rows every text is ``und``.
    """
    label = _labels(learned(training, max_rows), penalty, cap)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, out in label(batches):
            kinds = (pa.string(), pa.float64(),
                     pa.list_(pa.struct([("lang", pa.string()), *((c, pa.int64()) for c in
                                                                 ("first", "n", "skip", "letters"))])))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                ["doc_id", "lang_pred", "score", "spans"])

    return texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double, "
                                       "spans array<struct<lang:string, first:long, n:long, skip:long, letters:long>>")


def of_one_language(docs: DataFrame, training: DataFrame, least_share: float = 0.5, penalty: float = 12.0,
                    cap: float = 6.0, max_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, of whose letters one language has ``least_share``
    or more, as ``identified`` tells. A null text, and one without letters, goes."""
    label = _labels(learned(training, max_rows), penalty, cap)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, out in label(batches):
            yield block.filter(pa.array([lang != "und" and score >= least_share for lang, score, _ in out],
                                        pa.bool_()))

    return spread(docs).mapInArrow(run, docs.schema)


def _labels(model: Model, penalty: float, cap: float):
    """Blocks of rows, and language, score and spans of each row's text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
        remembered("language", dict)  # drops what other operators left in the worker
        words = Words(model, cap)
        for block in blocks(batches, limit=TEXT_BYTES):
            if max(len(words), words.used) > 300_000 or words.held > BLOCK_BYTES:
                words.reset()
            pieces = [t.split() for t in blobs(block.column("text"))]
            words.add(set().union(*pieces))
            steps = [words.steps(p) for p in pieces]
            ids = [rows for rows, _ in steps]
            scores, counts = words.scores, words.letters
            labels = viterbi(ids, scores, penalty) if model.languages else ids
            out = []
            for own, (seen, piece) in zip(labels, steps, strict=True):
                letters = counts[seen]
                if not model.languages or not letters.sum():
                    out.append(("und", 0.0, []))
                    continue
                share = np.bincount(own, letters, len(model.languages)) / letters.sum()
                told = bool(words.told[seen].any())
                top = int(share.argmax()) if told else model.common
                first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                last = np.append(first[1:], len(own)) - 1
                before = np.cumsum(letters, dtype=np.int64) - letters
                skip = before[first] - before[np.searchsorted(piece, piece[first])]
                spans = zip(own[first].tolist(), piece[first].tolist(), (piece[last] - piece[first] + 1).tolist(),
                            skip.tolist(), np.add.reduceat(letters, first).tolist(), strict=True)
                out.append((model.languages[top], float(share[top]) if told else 0.0,
                            [{"lang": model.languages[k], "first": a, "n": n, "skip": x, "letters": m}
                             for k, a, n, x, m in spans]))
            yield block, out
    return run
