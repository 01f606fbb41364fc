"""Array operators over token and id lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairmill.functions.basics import empty_strings, let
from pairmill.settings import EOS, PAD, SOS

# Keeps a zero-width scan from stopping inside a surrogate pair.
_WHOLE = r"(?![\x{DC00}-\x{DFFF}])"
_COUNTER = "\x02"     # separates a key from its repeat number


def ngrams(items: Column, n: int) -> Column:
    """All contiguous n-slices. ``sequence`` counts down, hence the guard."""
    grams = F.transform(F.sequence(F.lit(1), F.size(items) - n + 1),
                        lambda i: F.slice(items, i, n))
    return F.when(F.size(items) >= n, grams).otherwise(F.slice(F.array(items), 1, 0))


def ngram_keys(tokens: Column, n: int) -> Column:
    """n-grams of a token array as strings, words joined by one space.

    Tokens are never empty and hold no space, so the joined text can be cut by
    one regular expression: at each word start, look ahead over n words.
    """
    if n == 1:
        return tokens
    gram = rf"{_WHOLE}(?<![^ ])(?=([^ ]+(?: [^ ]+){{{n - 1}}}))"
    return F.regexp_extract_all(F.array_join(tokens, " "), F.lit(gram), F.lit(1))


def char_ngrams(text: Column, n: int) -> Column:
    """Overlapping n-grams of code points."""
    gram = rf"(?s){_WHOLE}(?=(.{{{n}}}))"
    return F.regexp_extract_all(text, F.lit(gram), F.lit(1))


def _further_copies(keys: Column) -> Column:
    """The multiset without one copy of every key, sorted."""
    return let(F.sort_array(keys), lambda s: F.filter(
        s, lambda k, i: (i > 0) & (k == F.get(s, i - 1))))


def _numbered(s: Column) -> Column:
    """Give the k-th copy of a key in a sorted array the number k.

    The run starts give every copy its number in linear time, and the multiset
    becomes an ordinary set.
    """
    starts = F.filter(F.sequence(F.lit(1), F.size(s)),
                      lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))

    def spread(st: Column) -> Column:
        return F.flatten(F.transform(st, lambda p, j: let(
            F.coalesce(F.get(st, j + 1), F.size(s) + 1) - p,
            lambda copies: F.transform(
                F.sequence(F.lit(1), copies),
                lambda k: F.concat(F.get(s, p - 1), F.lit(_COUNTER), k.cast("string"))))))
    return F.when(F.size(s) > 0, let(starts, spread)).otherwise(empty_strings())


def clipped_matches(left: Column, right: Column) -> Column:
    """Size of the multiset intersection of two string arrays, inside the row.

    One copy of every common key is a plain set intersection; only keys that
    occur repeatedly need their copies numbered.
    """
    def further(a: Column, b: Column) -> Column:
        return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(
            F.array_intersect(_numbered(a), _numbered(b)))).otherwise(0)
    more = let(_further_copies(left), lambda a: let(_further_copies(right),
                                                    lambda b: further(a, b)))
    return (F.size(F.array_intersect(left, right)) + more).cast("bigint")


def repeat_completions(ids: Column, n: int = 3) -> Column:
    """Items that would complete an n-gram the sequence already holds."""
    if n <= 0:
        return F.slice(ids, 1, 0)

    def met(a: Column, i: Column) -> Column:
        same = F.lit(True)
        for j in range(n - 1):
            same = same & F.get(a, i + j).eqNullSafe(F.get(a, F.size(a) - (n - 1) + j))
        return same

    def found(a: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(a) - n), lambda i: met(a, i))
        return F.transform(starts, lambda i: F.get(a, i + (n - 1)))
    none = F.flatten(F.slice(F.array(ids), 1, 0))
    return F.when(F.size(ids) >= n, let(ids, found)).otherwise(none)


def has_repeat(items: Column, n: int = 3) -> Column:
    """Whether an n-gram occurs twice. Different hashes tell most sequences without; else the n-grams are
    sorted, where equal ones are neighbours."""
    def hashes(a: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(a) - n),
                           lambda i: F.xxhash64(*[F.get(a, i + j) for j in range(n)]))

    def neighbours(grams: Column) -> Column:
        return F.exists(F.sequence(F.lit(1), F.size(grams) - 1),
                        lambda i: F.get(grams, i).eqNullSafe(F.get(grams, i - 1)))
    def sought(a: Column) -> Column:
        different = F.size(F.array_distinct(hashes(a))) == F.size(a) - (n - 1)
        return F.when(different, False).otherwise(let(F.sort_array(ngrams(a, n)), neighbours))
    return F.when(F.size(items) > n, let(items, sought)).otherwise(False)


def frame_ids(ids: Column, max_len: int, add_sos: bool = True, add_eos: bool = True) -> Column:
    """Cut to the budget, add the marks and pad to exactly ``max_len``."""
    budget = max_len - int(add_sos) - int(add_eos)
    parts = [F.slice(ids, 1, budget)]
    if add_sos:
        parts.insert(0, F.array(F.lit(SOS)))
    if add_eos:
        parts.append(F.array(F.lit(EOS)))
    return let(F.concat(*parts),
               lambda a: F.concat(a, F.array_repeat(F.lit(PAD), F.lit(max_len) - F.size(a))))


def until_eos(ids: Column) -> Column:
    """Ids before the first end mark, without padding and start marks."""
    end = F.array_position(ids, F.lit(EOS)).cast("int")
    kept = F.when(end > 0, F.slice(ids, F.lit(1), end - 1)).otherwise(ids)
    return F.filter(kept, lambda i: ~i.isin(PAD, SOS))


def decoder_input(ids: Column) -> Column:
    """All but the last id (what a decoder reads)."""
    return F.slice(ids, F.lit(1), F.greatest(F.size(ids) - 1, F.lit(0)))


def decoder_labels(ids: Column) -> Column:
    """All but the first id (what a decoder predicts)."""
    return F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0)))
