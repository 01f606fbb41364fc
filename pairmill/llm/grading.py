"""Ordinal quality classifier: a cumulative-link regression on graded ratings.

All grades share one weight per hashed word; ordered thresholds cut the score into grades:
P(grade >= k) = logistic(score - threshold k).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import blobs, blocks, texts

BITS = 16


class Hasher(dict):
    """Word to feature number, remembered within a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        number = self[word] = zlib.crc32(word.strip(b".,!?;:")) & (1 << BITS) - 1
        return number


_hasher = Hasher()


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text, and the damped counts of its words."""
    words = text.lower().split()
    found = np.fromiter(map(_hasher.__getitem__, words), np.int64, len(words))
    at, counts = np.unique(found, return_counts=True)
    return at, 1 + np.log(counts)


def scaled(at: np.ndarray, counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Counts weighed by rarity, of length one together."""
    values = counts * rarity[at]
    return values / max(1e-9, float(np.sqrt((values ** 2).sum())))


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray
    rarity: np.ndarray

    def tails(self, text: bytes) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        at, counts = features(text)
        return _logistic(float(self.weights[at] @ scaled(at, counts, self.rarity)) - self.thresholds)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(data: list[bytes], grades: list[int], n_grades: int, rounds: int = 150, rate: float = 0.15,
        decay: float = 1e-5) -> Model:
    """Maximum likelihood by full-batch adaptive gradient steps; thresholds stay ordered, as a first
    one and the logarithms of the gaps."""
    rows = [features(t) for t in data]
    at = np.concatenate([r[0] for r in rows])
    seen = np.bincount(at, minlength=1 << BITS)
    rarity = np.log((len(rows) + 1) / (seen + 1)).clip(0.01)
    values = np.concatenate([scaled(*r, rarity) for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    y = np.array(grades)
    k = n_grades - 1
    share = np.array([(np.sum(y >= j + 1) + 1) / (len(y) + 2) for j in range(k)])
    cuts = -np.log(share / (1 - share))
    params = np.concatenate([np.zeros(1 << BITS), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))])
    m, v = np.zeros_like(params), np.zeros_like(params)
    split = 1 << BITS
    for step in range(1, rounds + 1):
        gaps = np.exp(params[split + 1:])
        cuts = params[split] + np.append(0, np.cumsum(gaps))
        score = np.bincount(owner, params[at] * values, len(rows))
        tail = _logistic(score[:, None] - cuts)  # rows x k
        full = np.concatenate([np.ones((len(rows), 1)), tail, np.zeros((len(rows), 1))], 1)
        slope = full * (1 - full)
        index = np.arange(len(rows))
        p = np.maximum(full[index, y] - full[index, y + 1], 1e-9)
        up, down = slope[index, y] / p, slope[index, y + 1] / p
        pull = (up - down) / len(rows)
        grad = np.zeros_like(params)
        grad[:split] = np.bincount(at, pull[owner] * values, split) - decay * params[:split]
        on_cut = np.array([(np.sum(down[y == j]) - np.sum(up[y == j + 1])) / len(rows) for j in range(k)])
        grad[split] = on_cut.sum()
        grad[split + 1:] = np.cumsum(on_cut[::-1])[::-1][1:] * gaps
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        params = params + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    cuts = params[split] + np.append(0, np.cumsum(np.exp(params[split + 1:])))
    return Model(params[:split].astype(np.float32), cuts, rarity.astype(np.float32))


def trained(docs: DataFrame, ratings: DataFrame, n_grades: int, max_rows: int = 10_000) -> Model | None:
    """Model of the ``ratings`` (``doc_id``, ``grade`` from 0), fitted in one task to a bounded sample:
    the ``max_rows`` rated documents whose ids have the smallest hashes.

    Of several ratings of a document the lowest counts; null grades and ids are left out. None if no
    rated document is there.
    """
    sample = (ratings.where("grade is not null and doc_id is not null").groupBy("doc_id")
              .agg(F.min("grade").cast("int").alias("grade"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(sample), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
            .limit(max_rows).repartition(1))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        for batch in batches:
            held += zip(batch.column("grade").to_pylist(), blobs(batch.column("text")), strict=True)
        if held:
            held.sort()
            model = fit([t for _, t in held], [g for g, _ in held], n_grades)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in model], ["weights", "cuts", "rarity"])

    found = rows.mapInArrow(run, "weights binary, cuts binary, rarity binary").collect()
    if not found:
        return None
    return Model(np.frombuffer(found[0].weights, np.float32), np.frombuffer(found[0].cuts),
                 np.frombuffer(found[0].rarity, np.float32))


def graded(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, select_from: int = 2,
           threshold: float = 0.5, max_rows: int = 10_000) -> DataFrame:
    """Each document with ``expected_grade``, ``tail_probability`` (of grade ``select_from`` or more)
    and ``selected`` (that is ``threshold`` or more).

    ``docs`` needs ``doc_id`` and ``text``; other columns are not read. Null and empty texts have no
    words and get what the thresholds say alone. Equal texts are graded alike; an empty table gives
    no rows. Without any rating the grades are null and nothing is selected.
    """
    model = trained(docs, ratings, n_grades, max_rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            tails = [None if model is None else model.tails(t) for t in blobs(block.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array([None if t is None else float(t.sum()) for t in tails], pa.float64()),
                 pa.array([None if t is None else float(t[select_from - 1]) for t in tails], pa.float64())],
                ["doc_id", "expected_grade", "tail_probability"])

    return texts(docs).mapInArrow(run, "doc_id long, expected_grade double, tail_probability double").withColumn(
        "selected", F.coalesce(F.col("tail_probability") >= threshold, F.lit(False)))
