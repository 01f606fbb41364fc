"""Token list -> readable reply text.

The spacing of a word depends only on its neighbours and on whether a quote is
open. The latter is the parity of the quote's ordinal number, so no running
state is needed. The work grows with the number of words, and with the square of the number of quotes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairmill.functions import fixed
from pairmill.functions.basics import let, map_literal, upper_first
from pairmill.functions.text import SPACE, squeeze

_ALNUM = r"[\p{L}\p{N}]"


def _title(slot: Column) -> Column:
    """``<ph_order_number>`` -> ``Order Number``."""
    words = F.replace(F.substring(slot, 5, 2147483647), F.lit("_"), F.lit(" "))
    words = F.regexp_replace(words, ">$", "")
    return F.array_join(F.transform(F.split(words, r"(?<!\p{L})(?=\p{L})", -1),
                                    upper_first), "")


def surface(token: Column, inverse_map: Mapping[str, str] | None = None,
            name: Column | None = None) -> Column:
    """What a reader sees for one token. ``name`` is a slot's raw name, where one is known. All typed tokens
    begin alike, so one test passes words over."""
    out = F.when(~token.startswith("<"), token).when(
        token.isin(list(fixed.SURFACES)), F.element_at(map_literal(fixed.SURFACES), token))
    slot = _title(token)
    if inverse_map:
        slot = F.coalesce(F.element_at(map_literal(inverse_map), token), slot)
    if name is not None:
        slot = F.coalesce(name, slot)
    return (out.when(is_slot(token),
                     F.concat(F.lit("{{"), slot, F.lit("}}")))
            .otherwise(token))


def _glued(words: Column, dq: Column, sq: Column):
    def ordinal(word: Column, at: Column) -> Column:
        """Position of this quote among the quotes of its kind (from 1)."""
        return F.when(word == '"', F.array_position(dq, at)).otherwise(
            F.array_position(sq, at))

    def word(tok: Column) -> Column:
        # Neither a quote nor a mark of the lists: all of them lie outside this range.
        return (tok >= "a") & (tok < "{")

    def rule(tok: Column, i: Column) -> Column:
        prev = F.get(words, i - 1)
        nxt = F.get(words, i + 1)
        both_words = prev.rlike(_ALNUM + "$") & nxt.rlike("^" + _ALNUM)
        return (F.when(i == 0, True)
                .when(word(tok) & word(prev), False)
                .when(tok.isin(fixed.GLUE_LEFT), True)
                .when(tok.isin(fixed.GLUE_BOTH), F.coalesce(both_words, F.lit(False)))
                .when(prev.isin(fixed.GLUE_BOTH), True)
                .when(tok.isin('"', "'"), ordinal(tok, i) % 2 == 0)
                .when(prev.isin('"', "'") & (ordinal(prev, i - 1) % 2 == 1), True)
                .when(prev.isin(fixed.GLUE_RIGHT), True)
                .when(tok.startswith("'") & (F.length(tok) <= 3), True)
                .otherwise(False))
    return rule


def join_words(words: Column) -> Column:
    """Concatenate surface words with the spacing rules."""
    def positions(w: Column, quote: str) -> Column:
        at = F.transform(w, lambda x, i: F.when(x == quote, i).otherwise(-1))
        return F.when(F.array_contains(w, quote), F.filter(at, lambda i: i >= 0)).otherwise(
            F.array().cast("array<int>"))

    def pieces(w: Column, dq: Column, sq: Column) -> Column:
        rule = _glued(w, dq, sq)
        return F.array_join(F.transform(
            w, lambda tok, i: F.when(rule(tok, i), tok)
            .otherwise(F.concat(F.lit(" "), tok))), "")

    return let(words, lambda w: let(positions(w, '"'), lambda dq: let(
        positions(w, "'"), lambda sq: pieces(w, dq, sq))))


def polish(text: Column) -> Column:
    """Capitals, spaces before punctuation and the closing period."""
    text = F.regexp_replace(text, rf"i(?<![{fixed.WORD}]i)(?![{fixed.WORD}])", "I")
    sentences = F.split(text, rf"(?<=[.!?]{SPACE})", -1)
    text = F.array_join(F.transform(
        sentences, lambda s: F.when(s.rlike("^[a-z]"), upper_first(s)).otherwise(s)), "")
    text = F.regexp_replace(text, rf"{SPACE}++([.,!?;:])", "$1")
    return let(squeeze(text), lambda t: F.when((t == "") | t.rlike(r"[.!?]\z"), t)
               .otherwise(F.concat(t, F.lit("."))))


def is_slot(token: Column) -> Column:
    return token.startswith("<ph_") & token.endswith(">")


def render(tokens: Column, inverse_map: Mapping[str, str] | None = None,
           names: Column | None = None) -> Column:
    """``names`` has the raw name, or null, of each token that ``is_slot``, in their order."""
    def shown(t: Column, i: Column) -> Column:
        if names is None:
            return surface(t, inverse_map)
        before = F.size(F.filter(F.slice(tokens, F.lit(1), i), is_slot))
        return F.when(is_slot(t), surface(t, inverse_map, F.get(names, before))).otherwise(surface(t, inverse_map))

    words = F.filter(F.transform(tokens, shown), lambda w: w != "")
    return polish(join_words(words))
