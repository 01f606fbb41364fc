"""SQL forms of the text operators for an engine whose regexes know neither
look-around nor back-references."""

from __future__ import annotations

from pairmill.catalog.inputs import SUPPORT_SQL
from pairmill.functions import fixed

W, S = fixed.WORD, fixed.SPACE
TYPED = "/?(?:ph_[a-z0-9_]*|url|email|user|num|unk|pad|sos|eos)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(repl)}, 'g')"


def let(x: str, name: str, body: str) -> str:
    return f"list_transform([{x}], lambda {name}: {body})[1]"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def strip_markup(x: str) -> str:
    kept = f"regexp_replace({x}, '<({TYPED})>', chr(1) || '\\1' || chr(2), 'g')"
    bare = sub(kept, r"<[^<>\x01\x02]{1,40}>", " ")
    return f"translate({bare}, chr(1) || chr(2), '<>')"


def trim_space(x: str) -> str:
    return sub(x, rf"^[{S}]+|[{S}]+$", "")


def fill_slots(x: str, slot_of_name: str) -> str:
    """``slot_of_name`` is an expression over the lambda variable ``nm``."""
    names = f"list_transform(regexp_extract_all(t, {lit(fixed.SLOT)}, 1), lambda r: {trim_space('r')})"
    slots = f"list_transform({names}, lambda nm: ' ' || {slot_of_name} || ' ')"
    pieces = f"regexp_split_to_array(t, {lit(fixed.SLOT)})"
    return let(x, "t", f"array_to_string(list_transform(list_zip({pieces}, {slots}), "
                       "lambda p: p[1] || coalesce(p[2], '')), '')")


def collapse_letters(x: str) -> str:
    """Drop a character equal to both before it (not for line feeds)."""
    zipped = "list_zip(c, list_concat([null], c), list_concat([null, null], c))"
    keep = ("lambda z: z[1] is not null and not (z[1] <> chr(10) and "
            "coalesce(z[1] = z[2], false) and coalesce(z[1] = z[3], false))")
    return let(f"regexp_extract_all({x}, '(?s).')", "c",
               f"array_to_string(list_transform(list_filter({zipped}, {keep}), lambda z: z[1]), '')")


def squeeze(x: str) -> str:
    return f"trim({sub(x, f'[{S}]+', ' ')}, ' ')"


def expand_chat(x: str) -> str:
    entries = ", ".join(f"{lit(k)}: {lit(v)}" for k, v in fixed.CHAT_WORDS.items())
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            f"lambda w: coalesce(map {{{entries}}}[w], w)), ' ')")


def clean(x: str, chat: bool = False, slot_of_name: str = lit(fixed.GENERIC_SLOT)) -> str:
    x = sub(x, fixed.ZERO_WIDTH, " ")
    x = strip_markup(x)
    x = fill_slots(x, slot_of_name)
    x = f"translate({x}, '’‘“”–—', '''''\"\"--')"
    x = sub(x, rf"(?i)https?://[^{S}]+|www\.[^{S}]+", " <url> ")
    x = sub(x, rf"[{W}][{W}.+\-]*@[{W}\-]+\.[{W}.\-]*[{W}]", " <email> ")
    x = sub(x, rf"(^|[^{W}])@[{W}]{{2,}}", r"\1 <user> ")
    x = sub(x, rf"(^|[^{W}])#([{W}]+)", r"\1 \2 ")
    x = sub(x, fixed.EMOJI, " ")
    x = f"lower({x})"
    for mark in ("!", "?", ".", ","):
        x = sub(x, rf"\{mark}{{2,}}", mark)
    x = squeeze(collapse_letters(x))
    return expand_chat(x) if chat else x


def tokens(x: str) -> str:
    return f"regexp_extract_all({x}, {lit(fixed.TOKEN)})"


def reference_slot(x: str) -> str:
    def cue(words: str) -> str:
        return f"regexp_matches(lower({x}), {lit(f'(^|[^{W}])(?:{words})')})"
    return (f"case when {cue(fixed.INVOICE_CUE)} then {lit(fixed.INVOICE_SLOT)} "
            f"when {cue(fixed.TRACKING_CUE)} then {lit(fixed.TRACKING_SLOT)} "
            f"when {cue(fixed.REFUND_CUE)} then {lit(fixed.REFUND_SLOT)} "
            f"else {lit(fixed.ORDER_SLOT)} end")


def slotted(toks: str, context: str) -> str:
    number = lit(fixed.REFERENCE_NUMBER)
    return let(reference_slot(context), "rs", f"list_transform({toks}, lambda tk: "
               f"case when regexp_matches(tk, {number}) then rs else tk end)")


def query_tokens(cleaned: str) -> str:
    return let(cleaned, "cc", slotted(tokens("cc"), "cc"))


def content(toks: str) -> str:
    return (f"list_filter({toks}, lambda cw: regexp_matches(cw, {lit(fixed.CONTENT_WORD)}) "
            f"and cw not in {in_list(fixed.STOPWORDS)})")


def word_count(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, {lit(f'[{S}]+')}), lambda w: w <> ''))"


def fraction(key: str, seed: int = 42) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::bigint / 4294967296.0::double)"


def split_of(key: str) -> str:
    u = fraction(key)
    return f"case when {u} < 0.8 then 'train' when {u} < 0.9 then 'valid' else 'test' end"


def truncate(toks: str, limit: int = 118) -> str:
    last = (f"list_max(list_transform(tw[1:{limit}], lambda s, i: "
            "case when s in ('.', '!', '?') then i end))")
    return let(toks, "tw", f"case when len(tw) <= {limit} then tw "
               f"else tw[1:coalesce({last}, {limit})] end")


LINES = """with lp as (
 select doc_id * 10000000 + i as row_id, l[i + 1] as query, l[i + 2] as response,
        source as category, lang as intent
 from (select doc_id, source, lang, l, unnest(range(0, len(l) - 1)) as i
       from (select doc_id, source, lang, string_split(text, chr(10)) as l from documents)))"""

CLEANED_LINES = LINES + f""",
cl as materialized (select row_id, category, intent,
   array_to_string({query_tokens(clean('query', chat=True))}, ' ') as query_clean,
   {clean('response')} as response_clean from lp)"""

_FINE = ("case when query_clean = '' then 0 else len(string_split(query_clean, ' ')) end between 2 and 30"
         " and case when response_clean = '' then 0 else len(string_split(response_clean, ' ')) end >= 3")
FINE = _FINE


def kept(cleaned: str = "cl") -> str:
    return f"""w1 as (select * from {cleaned} qualify row_number() over
   (partition by query_clean, response_clean order by row_id) = 1),
 f5 as (select * from w1 where {_FINE}),
 kept as materialized (select * from f5 qualify row_number() over
   (partition by query_clean order by row_id) <= 4)"""


PREPARED_LINES = CLEANED_LINES + ", " + kept() + f""",
prep as materialized (select *, string_split(query_clean, ' ') as query_tokens,
   {truncate('full_reply')} as response_tokens, len(full_reply) > 118 as truncated,
   {split_of('query_clean')} as split
 from (select *, {tokens('response_clean')} as full_reply from kept))"""

DIALOGUES = """dp as (select conv_id * 10000000 + turn as row_id, conv_id, turn,
   text as query, next_text as response
 from (select *, lead(text) over w as next_text, lead(role) over w as next_role
       from conversations window w as (partition by conv_id order by turn))
 where role = 'user' and next_role = 'assistant')"""

SUPPORT = f"with sup as ({SUPPORT_SQL})"
USABLE_SUPPORT = SUPPORT + f""",
us as (select * from sup where query is not null and response is not null
  and not regexp_matches(query, {lit(fixed.AUTOMATED.replace('(?iu)', '(?i)'))})
  and not regexp_matches(response, {lit(fixed.AUTOMATED.replace('(?iu)', '(?i)'))}))"""


def slug(x: str) -> str:
    body = sub(f"lower({trim_space(x)})", "[^a-z0-9]+", "_")
    body = sub(body, "^_+|_+$", "")
    return let(body, "b", f"case when b = '' then {lit(fixed.GENERIC_SLOT)} else '<ph_' || b || '>' end")


SUPPORT_SLOTS = USABLE_SUPPORT + f""",
sc as (select raw, count(*) as n from (
   select {trim_space('unnest(regexp_extract_all(query, ' + lit(fixed.SLOT) + ', 1))')} as raw from us
   union all
   select {trim_space('unnest(regexp_extract_all(response, ' + lit(fixed.SLOT) + ', 1))')} from us)
   group by raw),
sm as materialized (select raw, case when n >= 20 then {slug('raw')}
   else {lit(fixed.GENERIC_SLOT)} end as slot, n from sc),
smap as (select map(list(raw), list(slot)) as m from sm where slot <> {lit(fixed.GENERIC_SLOT)})"""

_NAMED = f"coalesce(m[nm], {lit(fixed.GENERIC_SLOT)})"
CLEANED_SUPPORT = SUPPORT_SLOTS + f""",
cl as materialized (select row_id, category, intent,
   array_to_string({query_tokens(clean('query', True, _NAMED))}, ' ') as query_clean,
   {clean('response', False, _NAMED)} as response_clean from us, smap)"""
