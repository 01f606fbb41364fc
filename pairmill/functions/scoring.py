"""Per-row ingredients of the text metrics (published definitions)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from pairmill.functions.text import SPACE, one_of, words


def tokens_13a(text: Column) -> Column:
    """mteval-v13a tokenisation."""
    text = F.replace(text, F.lit("<skipped>"), F.lit(""))
    text = F.replace(text, F.lit("-\n"), F.lit(""))
    text = F.replace(text, F.lit("\n"), F.lit(" "))
    for entity, plain in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(plain))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    # The published class also pads the space itself, which changes no token.
    digit = one_of("09")
    text = F.regexp_replace(text, f"([{one_of('{~[`!&(+:@//')}])", " $1 ")
    text = F.regexp_replace(text, f"([^{digit}])([.,])", "$1 $2 ")
    text = F.regexp_replace(text, f"([.,])([^{digit}])", " $1 $2")
    text = F.regexp_replace(text, f"([{digit}])(-)", "$1 $2 ")
    return words(text)


def tokens_rouge(text: Column) -> Column:
    """Lower-cased ASCII alphanumerics; no stemming."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{one_of('az09')}]+"), F.lit(0))


#: Tokens of both sides that a task counts at once.
_AT_ONCE = 500_000


def _counted(tokens: np.ndarray, hyp_lens: np.ndarray, ref_lens: np.ndarray, top: int) -> list[np.ndarray]:
    """Matches m1, m2, ... of rows whose numbered tokens are given, all hypotheses first.

    An n-gram is numbered by its row, the number of the gram before it and its last token, so equal numbers
    are equal n-grams of one row, told by value and not by a hash.
    """
    rows, lens = len(hyp_lens), np.concatenate([hyp_lens, ref_lens])
    row = np.repeat(np.concatenate([np.arange(rows), np.arange(rows)]), lens)
    left = np.repeat(np.cumsum(lens), lens) - np.arange(len(tokens))
    base, of_hyp = int(tokens.max(initial=0)) + 1, int(hyp_lens.sum())
    number, out = row, []
    for n in range(1, top + 1):
        at = np.flatnonzero(left >= n)
        codes, found = pd.factorize(number[at] * base + tokens[at + (n - 1)])
        cut = int(np.searchsorted(at, of_hyp))
        both = np.minimum(np.bincount(codes[:cut], minlength=len(found)), np.bincount(codes[cut:], minlength=len(found)))
        owner = np.zeros(len(found), dtype=np.int64)
        owner[codes] = row[at]
        out.append(np.bincount(owner, weights=both, minlength=rows).astype(np.int64))
        number = np.zeros(len(tokens), dtype=np.int64)
        number[at] = codes
    return out


def _overlaps(hyp_lens: np.ndarray, ref_lens: np.ndarray, numbered, top: int, hyp_null, ref_null) -> pa.Array:
    """The struct of ``overlap`` for a batch, counted in slices of bounded size. ``numbered`` gives the tokens of
    rows ``a`` to ``b``."""
    matches = [np.zeros(len(hyp_lens), dtype=np.int64) for _ in range(top)]
    ends, a = np.cumsum(hyp_lens + ref_lens), 0
    while a < len(hyp_lens):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + _AT_ONCE, side="right")))
        for n, m in enumerate(_counted(numbered(a, b), hyp_lens[a:b], ref_lens[a:b], top)):
            matches[n][a:b] = m
        a = b
    names, arrays = [], []
    for n in range(1, top + 1):
        names += [f"m{n}", f"h{n}", f"r{n}"]
        arrays += [pa.array(matches[n - 1], mask=hyp_null | ref_null),
                   pa.array(np.maximum(hyp_lens - (n - 1), 0), mask=hyp_null),
                   pa.array(np.maximum(ref_lens - (n - 1), 0), mask=ref_null)]
    return pa.StructArray.from_arrays(arrays, names=names)


def _fields(top: int) -> str:
    return "struct<" + ",".join(f"{side}{n}:bigint" for n in range(1, top + 1) for side in "mhr") + ">"


def _lens(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lens, lists.is_null().to_numpy(zero_copy_only=False)


def _token_overlap(top: int):
    @F.arrow_udf(_fields(top))
    def counted(hyp: pa.Array, ref: pa.Array) -> pa.Array:
        (hyp_lens, hyp_null), (ref_lens, ref_null) = _lens(hyp), _lens(ref)
        h_at, r_at = (np.concatenate([[0], np.cumsum(x)]) for x in (hyp_lens, ref_lens))
        h, r = hyp.flatten(), ref.flatten()

        def numbered(a: int, b: int) -> np.ndarray:
            both = pa.concat_arrays([h[h_at[a]:h_at[b]], r[r_at[a]:r_at[b]]])
            return both.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return _overlaps(hyp_lens, ref_lens, numbered, top, hyp_null, ref_null)
    return counted


def _char_overlap(top: int):
    @F.arrow_udf(_fields(top))
    def counted(hyp: pa.Array, ref: pa.Array) -> pa.Array:
        h, r = ([t or "" for t in side.to_pylist()] for side in (hyp, ref))

        def numbered(a: int, b: int) -> np.ndarray:
            text = "".join(h[a:b]) + "".join(r[a:b])
            return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        hyp_lens, ref_lens = (np.array([len(t) for t in side], dtype=np.int64) for side in (h, r))
        nulls = [side.is_null().to_numpy(zero_copy_only=False) for side in (hyp, ref)]
        return _overlaps(hyp_lens, ref_lens, numbered, top, *nulls)
    return counted


def overlap(hyp: Column, ref: Column, top: int, chars: bool = False) -> Column:
    """``struct(m1, h1, r1, m2, ...)``: clipped matches and totals per n-gram order up to ``top``, of two token
    arrays or of the characters of two texts. An Arrow function counts a whole batch in numpy."""
    return (_char_overlap if chars else _token_overlap)(top)(hyp, ref)


def bleu_overlap(hyp: Column, ref: Column, lowercase: bool) -> Column:
    if lowercase:
        hyp, ref = F.lower(hyp), F.lower(ref)
    return overlap(tokens_13a(hyp), tokens_13a(ref), 4)


def chrf_overlap(hyp: Column, ref: Column) -> Column:
    def bare(text: Column) -> Column:
        return F.regexp_replace(text, f"{SPACE}+", "")
    return overlap(bare(hyp), bare(ref), 6, chars=True)


def rouge_overlap(hyp: Column, ref: Column) -> Column:
    return overlap(tokens_rouge(hyp), tokens_rouge(ref), 2)


def f_measure(matches: Column, hyp_total: Column, ref_total: Column) -> Column:
    """2PR/(P+R) = 2m/(h+r); 0 when nothing matches."""
    return F.when(matches > 0, 2.0 * matches / (hyp_total + ref_total)).otherwise(0.0)


def bleu(stats: Column, effective_order: bool) -> Column:
    """BLEU in percent from a ``bleu_overlap`` struct (a row's or summed)."""
    log_sum, order, doublings = F.lit(0.0), F.lit(0), F.lit(0)
    alive = F.lit(True)
    for n in range(1, 5):
        match, total = stats[f"m{n}"], stats[f"h{n}"]
        alive = alive & (total > 0)
        doublings = doublings + F.when(alive & (match == 0), 1).otherwise(0)
        share = F.when(match > 0, match / total).otherwise(
            1.0 / (F.pow(F.lit(2.0), doublings) * total))
        log_sum = log_sum + F.when(alive, F.log(share)).otherwise(0.0)
        order = order + F.when(alive, 1).otherwise(0)
    hyp_len, ref_len = stats["h1"], stats["r1"]
    brevity = F.when(hyp_len >= ref_len, F.lit(1.0)).otherwise(F.exp(1.0 - ref_len / hyp_len))
    any_match = stats["m1"] + stats["m2"] + stats["m3"] + stats["m4"] > 0
    complete = F.lit(True) if effective_order else order == 4
    return F.when(any_match & complete, 100.0 * brevity * F.exp(log_sum / order)).otherwise(0.0)


def bleu_precisions(stats: Column) -> Column:
    """Smoothed n-gram precisions in percent, four entries."""
    out, doublings, alive = [], F.lit(0), F.lit(True)
    for n in range(1, 5):
        match, total = stats[f"m{n}"], stats[f"h{n}"]
        alive = alive & (total > 0)
        doublings = doublings + F.when(alive & (match == 0), 1).otherwise(0)
        out.append(F.when(~alive, 0.0).when(match > 0, 100.0 * match / total)
                   .otherwise(100.0 / (F.pow(F.lit(2.0), doublings) * total)))
    any_match = stats["m1"] + stats["m2"] + stats["m3"] + stats["m4"] > 0
    return F.array(*[F.when(any_match, p).otherwise(0.0) for p in out])


def chrf(stats: Column, beta: float = 2.0) -> Column:
    """chrF in percent from summed ``chrf_overlap`` fields."""
    precision, recall, orders = F.lit(0.0), F.lit(0.0), F.lit(0)
    for n in range(1, 7):
        match, hyp, ref = stats[f"m{n}"], stats[f"h{n}"], stats[f"r{n}"]
        both = (hyp > 0) & (ref > 0)
        precision = precision + F.when(both, match / hyp).otherwise(0.0)
        recall = recall + F.when(both, match / ref).otherwise(0.0)
        orders = orders + F.when(both, 1).otherwise(0)
    b2 = beta * beta
    # The mean's divisor cancels in P*R/(b2*P+R) up to one factor.
    return F.when(precision + recall > 0,
                  100.0 * (1 + b2) * precision * recall
                  / ((b2 * precision + recall) * orders)).otherwise(0.0)


@F.pandas_udf(LongType())
def lcs_length(left: pd.Series, right: pd.Series) -> pd.Series:
    """Longest common subsequence of two token lists, whole lists.

    Bit-parallel dynamic programming (Hyyro 2004): one big-integer step per
    token of ``left`` covers a whole column of the table.
    """
    def one(a, b) -> int:
        where: dict = {}
        for i, token in enumerate(b):
            where[token] = where.get(token, 0) | (1 << i)
        full = (1 << len(b)) - 1
        v = full
        for token in a:
            m = where.get(token, 0)
            if m:
                u = v & m
                v = ((v + u) | (v - u)) & full
        return len(b) - v.bit_count()
    return pd.Series([one(a, b) for a, b in zip(left, right)], dtype="int64")
