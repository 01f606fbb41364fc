"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairmill.llm.common import blobs, blocks, texts
from pairmill.sources.staging import stage

SYMBOLS = b"#*$%&|<>"
MARKS = SYMBOLS + b"!?.,;:@/\\^_~`+=-\"'()[]{}"
LETTERS_UPPER, LETTERS_LOWER = bytes(range(65, 91)), bytes(range(97, 123))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines",
          "n_marks", "n_upper", "n_lower")


def measures(text: bytes) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one text. Words lie between ASCII white space; a repeated word is
    one in a window of three words that the text has more than once."""
    words = text.split()
    joined = b"".join(words)
    raw = np.frombuffer(joined, np.uint8)
    chars = len(raw) - int(((raw & 0xC0) == 0x80).sum())
    lines = [x for x in text.split(b"\n") if x.split()]
    ended = sum(x.rstrip()[-1:] in b".!?:;\"" for x in lines)
    ids: dict[bytes, int] = {}
    seq = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    return (len(words), chars, len(joined) - len(joined.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), _repeated(seq, len(ids)), len(lines), ended,
            len(joined) - len(joined.translate(None, MARKS)),
            len(joined) - len(joined.translate(None, LETTERS_UPPER)),
            len(joined) - len(joined.translate(None, LETTERS_LOWER)))


def _repeated(seq: np.ndarray, n: int) -> int:
    if len(seq) < 4:
        return 0
    pairs = seq[:-1] * n + seq[1:]
    if n > 1_000_000:  # keep three-word keys within 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, counts = np.unique(pairs[:-1] * n + seq[2:], return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[at] > 1)
    hit = np.zeros(len(seq), bool)
    for k in range(3):
        hit[again + k] = True
    return int(hit.sum())


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _low(value: Column, good: float, bad: float) -> Column:
    """Votes 1 (good) below the one bound, 0 (bad) above the other, 2 (abstains) between."""
    return F.when(value <= good, 1).when(value >= bad, 0).otherwise(2)


def _high(value: Column, good: float, bad: float) -> Column:
    return F.when(value >= good, 1).when(value <= bad, 0).otherwise(2)


def votes() -> list[Column]:
    """The rules. Texts too small for a rule get no vote from it."""
    length = _ratio("word_chars", "n_words")
    return [F.when(length.between(3, 10), 1).when(~length.between(2, 15), 0).otherwise(2),
            _low(_ratio("n_symbols", "n_words"), 0.05, 0.3),
            F.when(F.col("n_lines") < 3, 2).otherwise(_low(_ratio("n_dup_lines", "n_lines"), 0.1, 0.3)),
            _low(_ratio("n_repeat_words", "n_words"), 0.1, 0.3),
            _low(_ratio("n_marks", "n_words"), 0.4, 1.0),
            _low(F.col("n_upper") / F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1)), 0.2, 0.5),
            _high(_ratio("n_ended_lines", "n_lines"), 0.5, 0.1)]


def fit(patterns: dict[int, int], n_rules: int, rounds: int = 100) -> dict[int, float]:
    """Posterior probability of good quality for each pattern of votes (base 3, first rule lowest).

    Every rule has an accuracy on good and one on bad texts. They start at 0.95 and 0.5, as most rules
    overlook most kinds of bad texts, and are smoothed by ten such votes. A rule stays likelier to vote
    bad on bad texts than on good ones, so the classes can't change sides.
    """
    marks = {p: [p // 3 ** j % 3 for j in range(n_rules)] for p in patterns}
    right = [[0.5, 0.95] for _ in range(n_rules)]  # on bad, on good texts
    prior, post = 0.8, {}
    for _ in range(rounds):
        for p, own in marks.items():
            odds = math.log(prior / (1 - prior))
            for j, v in enumerate(own):
                if v == 1:
                    odds += math.log(right[j][1] / (1 - right[j][0]))
                elif v == 0:
                    odds += math.log((1 - right[j][1]) / right[j][0])
            post[p] = 1 / (1 + math.exp(-odds))
        total = sum(patterns.values())
        prior = (8 + sum(n * post[p] for p, n in patterns.items())) / (10 + total)
        for j in range(n_rules):
            for y, start in ((1, 9.5), (0, 5)):
                weight = {p: n * (post[p] if y else 1 - post[p]) for p, n in patterns.items()
                          if marks[p][j] != 2}
                hit = sum(w for p, w in weight.items() if marks[p][j] == y)
                least = 0.5 if y else 1.001 - right[j][1]
                right[j][y] = min(0.999, max(least, (start + hit) / (10 + sum(weight.values()))))
    return post


def judged(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Each document with its counts, ``base_failed``, ``quality`` (posterior probability) and ``kept``.

    A document fails the base if it has under 50 words, or if over half of its words are repeated.
    The others are kept at a ``quality`` of ``threshold`` or more. ``docs`` needs ``doc_id`` and
    ``text``; other columns are not read. A null or empty text has no words. Each row is judged for
    itself, so equal texts fare alike. An empty table gives no rows. Rules are weighed over all
    documents that pass the base: only their number for each pattern of votes, 3 ** 7 patterns at most,
    goes to the driver.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            columns = zip(*map(measures, blobs(block.column("text"))), strict=True)
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                                             ["doc_id", *COUNTS])

    rules = votes()
    pattern = sum((v * 3 ** j for j, v in enumerate(rules)), F.lit(0))
    rows = stage(texts(docs).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))
                 .withColumn("pattern", pattern.cast("int")), "measures")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    counts = {r["pattern"]: r["n"] for r in rows.groupBy("pattern").agg(
        F.count_if(~F.col("base_failed")).alias("n")).collect()}
    post = docs.sparkSession.createDataFrame(sorted(fit(counts, len(rules)).items()),
                                             "pattern int, quality double")
    return (rows.join(F.broadcast(post), "pattern")
            .select("doc_id", *COUNTS[:5], "base_failed",
                    (~F.col("base_failed") & (F.col("quality") >= threshold)).alias("kept"), "quality"))
