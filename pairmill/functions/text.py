"""Cleaning, normalising and tokenising as column expressions.

Everything here runs inside the JVM. The order of the cleaning steps is part of
the result and must not change.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairmill.functions import fixed
from pairmill.functions.basics import let, map_literal


def _when_contains(text: Column, needles: list[str], pattern: str, repl: str) -> Column:
    """``regexp_replace`` that skips rows without any of the plain ``needles``."""
    def body(t: Column) -> Column:
        hit = F.contains(t, F.lit(needles[0]))
        for needle in needles[1:]:
            hit = hit | F.contains(t, F.lit(needle))
        return F.when(hit, F.regexp_replace(t, pattern, repl)).otherwise(t)
    return let(text, body)


def one_of(ranges: str) -> str:
    """A character class of Latin-1 ranges (``"azAZ"``: a to z, A to Z) spelled out. Java looks such a class up in
    one table; ranges and classes inside a class are a call each, which its compiler stops inlining."""
    return "".join(rf"\x{c:02x}" for a, z in zip(ranges[::2], ranges[1::2]) for c in range(ord(a), ord(z) + 1))


# White space, the same as ``fixed.SPACE``, and its complement.
SPACE = "[" + one_of("\t\r\x1c\x20\x85\x85\xa0\xa0") + r"[\x{1680}-\x{3000}&&\p{Z}]]"
_NO_SPACE = f"[{one_of('!~')}[^{fixed.SPACE}]]"
_OTHER_ASCII_SPACE = "[" + one_of("\t\r\x1c\x1f") + "]"
# The same slots and repeats as the fixed patterns, without places to go back to; names are trimmed after.
_SLOT = r"\{\{([^{}]++)\}\}"
_CHAR_RUN = fixed.CHAR_RUN.replace(r"\1{2,}", r"\1\1+")
# A web address begins with one of four letters, which is told before both branches are tried.
_URL = "(?=[hHwW])" + fixed.URL.replace("(?iu)", "(?iu:").replace(f"[^{fixed.SPACE}]", _NO_SPACE) + ")"


def _contains_any(text: Column, needles: Iterable[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(n)) for n in needles])


def _unless_ascii(text: Column, step: Callable[[Column], Column]) -> Column:
    """``step`` for texts beyond ASCII; two lengths tell, without decoding the text."""
    return let(text, lambda t: F.when(F.octet_length(t) == F.length(t), t).otherwise(step(t)))


def strip_zero_width(text: Column) -> Column:
    return _unless_ascii(text, lambda t: F.regexp_replace(
        t, rf"[\x{{200B}}-\x{{FEFF}}&&{fixed.ZERO_WIDTH}]", " "))


def strip_markup(text: Column) -> Column:
    """Short tags become a space; typed tokens such as ``<ph_x>`` stay."""
    return _when_contains(text, ["<"], fixed.MARKUP, " ")


def trim_space(text: Column) -> Column:
    """Unicode-aware strip."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def slot_names(text: Column) -> Column:
    """Raw names of every ``{{ name }}``, trimmed, in order, repeats kept."""
    return F.transform(F.regexp_extract_all(text, F.lit(_SLOT), F.lit(1)), trim_space)


def slug(name: Column) -> Column:
    """``Order Number`` -> ``<ph_order_number>``."""
    body = F.regexp_replace(F.lower(trim_space(name)), "[^a-z0-9]+", "_")
    body = F.regexp_replace(body, "^_+|_+$", "")
    return let(body, lambda b: F.when(b == "", fixed.GENERIC_SLOT)
               .otherwise(F.concat(F.lit("<ph_"), b, F.lit(">"))))


def fill_slots(text: Column, slots: Column) -> Column:
    """Replace the i-th ``{{...}}`` of ``text`` by the i-th entry of ``slots``."""
    pieces = F.split(text, _SLOT, -1)
    return F.array_join(F.zip_with(
        pieces, slots,
        lambda piece, slot: F.when(slot.isNull(), piece)
        .otherwise(F.concat(piece, F.lit(" "), slot, F.lit(" ")))), "")


def apply_slots(text: Column, slot_map: Mapping[str, str] | None) -> Column:
    """Slot substitution with a small in-plan map; unknown names are generic."""
    frequent = {k: v for k, v in (slot_map or {}).items() if v != fixed.GENERIC_SLOT}

    def slot_of(name: Column) -> Column:
        if not frequent:
            return F.lit(fixed.GENERIC_SLOT)
        # A constant map is searched entry by entry; the set first spares names it lacks.
        return F.when(name.isin(list(frequent)), F.element_at(map_literal(frequent), name)).otherwise(
            fixed.GENERIC_SLOT)

    def body(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("{{")),
                      fill_slots(t, F.transform(slot_names(t), slot_of))).otherwise(t)
    return let(text, body)


def plain_quotes(text: Column) -> Column:
    return _unless_ascii(text, lambda t: F.when(
        _contains_any(t, "’‘“”–—"), F.translate(t, "’‘“”–—", "''\"\"--")).otherwise(t))


def mask_urls(text: Column) -> Column:
    return _when_contains(text, ["://", "ww.", "WW.", "wW.", "Ww."], _URL, " <url> ")


def mask_emails(text: Column) -> Column:
    return _when_contains(text, ["@"], fixed.EMAIL, " <email> ")


def mask_users(text: Column) -> Column:
    return _when_contains(text, ["@"], fixed.USER, " <user> ")


def open_hashtags(text: Column) -> Column:
    return _when_contains(text, ["#"], fixed.HASHTAG, " $1 ")


def strip_emoji(text: Column) -> Column:
    # One range test rejects almost every character before the list of blocks.
    return _unless_ascii(text, lambda t: F.regexp_replace(
        t, rf"[\x{{2190}}-\x{{1FAFF}}&&{fixed.EMOJI[:-1]}]+", " "))


def collapse_punctuation(text: Column) -> Column:
    return _when_contains(text, ["!!", "??", "..", ",,"], fixed.PUNCT_RUN, "$1")


def collapse_letters(text: Column) -> Column:
    return F.regexp_replace(text, _CHAR_RUN, "$1$1")


def squeeze(text: Column) -> Column:
    """Every run of white space as one space; runs that are one space already are passed over, and so are
    ASCII texts without any other."""
    def body(t: Column) -> Column:
        plain = (F.octet_length(t) == F.length(t)) & ~F.contains(t, F.lit("  ")) & ~t.rlike(_OTHER_ASCII_SPACE)
        return F.when(plain, t).otherwise(F.regexp_replace(t, rf"{SPACE}(?:(?<! )|(?={SPACE})){SPACE}*", " "))
    return F.trim(let(text, body))


def expand_chat(text: Column) -> Column:
    """Chat-speak lookup, one pass over words of an already squeezed text."""
    words = F.split(text, " ", -1)
    return F.array_join(F.transform(
        words, lambda w: F.when(w.isin(list(fixed.CHAT_WORDS)),
                                F.element_at(map_literal(fixed.CHAT_WORDS), w))
        .otherwise(w)), " ")


def before_slots(text: Column) -> Column:
    return strip_markup(strip_zero_width(text))


def after_slots(text: Column, chat: bool = False) -> Column:
    for step in (plain_quotes, mask_urls, mask_emails, mask_users, open_hashtags,
                 strip_emoji, F.lower, collapse_punctuation, collapse_letters, squeeze):
        text = step(text)
    return expand_chat(text) if chat else text


def clean_text(text: Column, slot_map: Mapping[str, str] | None = None,
               chat: bool = False) -> Column:
    """The whole cleaning chain for one side of a pair."""
    return after_slots(apply_slots(before_slots(text), slot_map), chat)


# The same pattern without places to go back to.
_TOKEN = (fixed.TOKEN.replace("[a-z]+(?:['’\\-][a-z]+)*", "[a-z]++(?:['’\\-][a-z]++)*+")
          .replace(f"[^{fixed.SPACE}]", _NO_SPACE))


def tokenize(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))


def reference_slot(context: Column) -> Column:
    """Which slot a bare number in this query stands for."""
    def mentions(cues: str) -> Column:
        return F.lower(context).rlike(rf"(?<![{fixed.WORD}])(?:{cues})")
    return (F.when(mentions(fixed.INVOICE_CUE), fixed.INVOICE_SLOT)
            .when(mentions(fixed.TRACKING_CUE), fixed.TRACKING_SLOT)
            .when(mentions(fixed.REFUND_CUE), fixed.REFUND_SLOT)
            .otherwise(fixed.ORDER_SLOT))


def slot_reference_numbers(tokens: Column, context: Column) -> Column:
    return F.transform(tokens, lambda t: F.when(t.rlike(fixed.REFERENCE_NUMBER),
                                                reference_slot(context)).otherwise(t))


def query_tokens(cleaned: Column) -> Column:
    """Tokens of a cleaned query with reference numbers slotted. A token with four digits has them in a
    row, so most texts need no look at each token."""
    return let(cleaned, lambda c: F.when(c.rlike(r"\p{Nd}{4}"), slot_reference_numbers(tokenize(c), c))
               .otherwise(tokenize(c)))


def prepare_query(text: Column, slot_map: Mapping[str, str] | None = None) -> Column:
    """Raw query -> tokens; the same function serves batch and stream."""
    return query_tokens(clean_text(text, slot_map, chat=True))


def content_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda t: t.rlike(fixed.CONTENT_WORD)
                    & ~t.isin(fixed.STOPWORDS))


def is_automated(text: Column) -> Column:
    """Boilerplate test; a plain search first spares most rows the regex.

    The last needles are the letters that case folding maps to plain ones.
    """
    def body(t: Column) -> Column:
        hit = let(F.lower(t), lambda low: _contains_any(low, fixed.AUTOMATED_NEEDLES))
        return (hit | _contains_any(t, "\u017f\u0131\u0130\u212a")) & t.rlike(fixed.AUTOMATED)
    return let(text, body)


def surely_longer(text: Column, limit: int) -> Column:
    """Whether a raw text is sure to have more than ``limit`` tokens when cleaned as a query, told without
    cleaning it.

    A word that starts with a visible ASCII character after a space gives a token at least: cleaning splits
    words and puts others in their place, and only markup and slots take several at once. Texts that may hold
    one of these are not told.
    """
    word = r"(?:[^ ]++| (?![!-~]))*+ [!-~]"
    return ~_contains_any(text, ["<", "{{"]) & text.rlike(rf"\A(?:{word}){{{limit + 1}}}")


def words(text: Column) -> Column:
    """Whitespace words (no empty entries)."""
    return F.regexp_extract_all(text, F.lit(f"{_NO_SPACE}+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{_NO_SPACE}+"))


def truncate_at_sentence(tokens: Column, limit: int) -> Column:
    """Cut to ``limit`` tokens at the last sentence end that fits, else hard."""
    def cut(window: Column) -> Column:
        ends = F.transform(window, lambda t, i: F.when(t.isin(".", "!", "?"), i + 1))
        return F.slice(window, F.lit(1), F.coalesce(F.array_max(ends), F.lit(limit)))
    return F.when(F.size(tokens) <= limit, tokens).otherwise(
        let(F.slice(tokens, 1, limit), cut))


def prefix(text: Column, n: int = 160) -> Column:
    return F.substring(text, 1, n)


def lines(text: Column) -> Column:
    """Non-blank stripped lines of a text."""
    return F.filter(F.transform(F.split(text, r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x85\x{2028}\x{2029}]", -1),
                                trim_space), lambda x: x != "")

