"""Text operators over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairmill.catalog import sqltext as q
from pairmill.catalog.inputs import joined, support_rows, table, texts
from pairmill.catalog.registry import query
from pairmill.functions import fixed, text
from pairmill.functions.basics import compute_once
from pairmill.functions.render import render
from pairmill.operators import slots
from pairmill.plans.prepare import clean_pairs, usable_pairs
from pairmill.sources.staging import stage


@query(f"select doc_id, {q.clean('text')} as cleaned from documents")
def clean_documents(spark, sf):
    return texts(spark, sf, "documents").select(
        "doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(f"select page_id, {q.clean('url')} as url_clean, {q.clean('html')} as cleaned from pages")
def clean_pages(spark, sf):
    return texts(spark, sf, "pages").select(
        "page_id", text.clean_text(F.col("url")).alias("url_clean"),
        text.clean_text(F.col("html")).alias("cleaned"))


@query(f"select page_id, {q.strip_markup('html')} as bare from pages")
def strip_page_markup(spark, sf):
    return texts(spark, sf, "pages").select("page_id", text.strip_markup(F.col("html")).alias("bare"))


@query(q.CLEANED_SUPPORT + " select row_id, query_clean from cl")
def prepare_support_queries(spark, sf):
    return _cleaned_support(spark, sf).select("row_id", "query_clean")


def _cleaned_support(spark, sf):
    """Cleaned pairs by their own slot map, a constant or a join as its size demands."""
    usable = usable_pairs(support_rows(spark, sf))
    mapping = stage(slots.slot_map(usable, ["query", "response"]), "slots")
    return clean_pairs(usable, mapping)


@query(q.CLEANED_SUPPORT + " select row_id, response_clean from cl")
def clean_support_replies(spark, sf):
    return _cleaned_support(spark, sf).select("row_id", "response_clean")


@query(q.SUPPORT_SLOTS + f""" select row_id, {q.fill_slots('response', q._NAMED)} as filled
 from us, smap""")
def fill_slots_by_join(spark, sf):
    """The join form of slot substitution (maps of any size)."""
    usable = usable_pairs(support_rows(spark, sf))
    mapping = stage(slots.slot_map(usable, ["query", "response"]), "slots")
    filled = slots.apply_slots_df(usable.select("row_id", "response"), "response", mapping)
    return filled.select("row_id", F.col("response").alias("filled"))


@query(f"""select doc_id, cast(len({q.tokens('lower(text)')}) as bigint) as n_tokens,
 array_to_string({q.tokens('lower(text)')}, ' ') as tokens from documents""")
def tokenize_documents(spark, sf):
    toks = compute_once(texts(spark, sf, "documents"), t=text.tokenize(F.lower("text")))
    return toks.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"),
                       joined("t").alias("tokens"))


@query(f"""select doc_id, cast(len({q.tokens('lower(text)')}) > 118 as boolean) as truncated,
 array_to_string({q.truncate(q.tokens('lower(text)'))}, ' ') as kept from documents""")
def truncate_replies(spark, sf):
    toks = compute_once(texts(spark, sf, "documents"), t=text.tokenize(F.lower("text")))
    return toks.select("doc_id", (F.size("t") > 118).alias("truncated"),
                       joined(text.truncate_at_sentence(F.col("t"), 118)).alias("kept"))


@query(f"""select doc_id, array_to_string({q.content(q.tokens('lower(text)'))}, ' ') as content
 from documents""")
def content_words_of_documents(spark, sf):
    words = text.content_words(text.tokenize(F.lower("text")))
    return texts(spark, sf, "documents").select("doc_id", joined(words).alias("content"))


@query(q.SUPPORT + f""" select row_id, {q.reference_slot('query')} as slot from sup
 where query is not null""")
def reference_slots(spark, sf):
    return (support_rows(spark, sf).where(F.col("query").isNotNull())
            .select("row_id", text.reference_slot(F.col("query")).alias("slot")))


@query(q.SUPPORT + f""" select row_id,
 array_to_string({q.slotted(q.tokens('lower(query)'), 'query')}, ' ') as tokens
 from sup where query is not null""")
def reference_numbers(spark, sf):
    toks = text.slot_reference_numbers(text.tokenize(F.lower("query")), F.col("query"))
    return (support_rows(spark, sf).where(F.col("query").isNotNull())
            .select("row_id", joined(toks).alias("tokens")))


@query(q.SUPPORT + f""" select row_id, {q.expand_chat(q.squeeze('lower(query)'))} as expanded
 from sup where query is not null""")
def chat_words(spark, sf):
    return (support_rows(spark, sf).where(F.col("query").isNotNull())
            .select("row_id", text.expand_chat(text.squeeze(F.lower("query"))).alias("expanded")))


@query(f"select p_partkey, {q.slug('concat(p_name, p_brand, p_type)')} as slot from part")
def slugs(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", text.slug(F.concat("p_name", "p_brand", "p_type")).alias("slot"))


_AUTO = q.lit(fixed.AUTOMATED.replace("(?iu)", "(?i)"))


@query(q.SUPPORT + f""" select row_id, regexp_matches(query, {_AUTO}) as query_automated,
 regexp_matches(response, {_AUTO}) as reply_automated from sup""")
def automated_flags(spark, sf):
    return support_rows(spark, sf).select(
        "row_id", text.is_automated(F.col("query")).alias("query_automated"),
        text.is_automated(F.col("response")).alias("reply_automated"))


@query("""select lower(trim(text)) as reply, cast(count(*) as bigint) as n,
 substr(lower(trim(text)), 1, 160) as shown from documents group by 1""")
def reply_prefixes(spark, sf):
    counted = table(spark, sf, "documents").groupBy(
        F.lower(F.trim("text")).alias("reply")).agg(F.count("*").alias("n"))
    return counted.select("reply", "n", text.prefix(F.col("reply")).alias("shown"))


def render_sql(toks: str, names: str | None = None) -> str:
    """Spacing rules as a list expression; quotes by their ordinal number. ``names`` is a map of slots to
    raw names."""
    surfaces = ", ".join(f"{q.lit(k)}: {q.lit(v)}" for k, v in fixed.SURFACES.items())
    titled = ("'{{' || array_to_string(list_transform(regexp_extract_all(replace(tk[5:-2], '_', ' '), "
              "'[^a-z]*[a-z]+|[^a-z]+'), lambda ti: regexp_extract(ti, '^[^a-z]*') || "
              "upper(regexp_extract(ti, '[a-z]')) || regexp_extract(ti, '[a-z]([a-z]*)', 1)), '') || '}}'")
    if names:
        titled = f"coalesce('{{{{' || {names}[tk] || '}}}}', {titled})"
    surface = (f"coalesce(map {{{surfaces}}}[tk], case when starts_with(tk, '<ph_') and "
               f"ends_with(tk, '>') then {titled} else tk end)")
    words = (f"list_filter(list_transform({toks}, lambda tk: {surface}), lambda sw: sw <> '')")
    dq = "list_filter(list_transform(ws, lambda x, i: case when x = '\"' then i else 0 end), lambda y: y > 0)"
    sq = "list_filter(list_transform(ws, lambda x, i: case when x = '''' then i else 0 end), lambda y: y > 0)"

    def ordinal(word: str, at: str) -> str:
        return (f"case when {word} = '\"' then list_position(dq, {at}) "
                f"else list_position(sq, {at}) end")
    prev, nxt = "ws[wi - 1]", "ws[wi + 1]"
    glued = f"""case when wi = 1 then true
 when wd in {q.in_list(fixed.GLUE_LEFT)} then true
 when wd in {q.in_list(fixed.GLUE_BOTH)} then coalesce(regexp_matches({prev}, '[\\p{{L}}\\p{{N}}]$')
   and regexp_matches({nxt}, '^[\\p{{L}}\\p{{N}}]'), false)
 when {prev} in {q.in_list(fixed.GLUE_BOTH)} then true
 when wd in ('"', '''') then ({ordinal('wd', 'wi')}) % 2 = 0
 when {prev} in ('"', '''') and ({ordinal(prev, 'wi - 1')}) % 2 = 1 then true
 when {prev} in {q.in_list(fixed.GLUE_RIGHT)} then true
 when starts_with(wd, '''') and length(wd) <= 3 then true else false end"""
    glue = q.let(dq, "dq", q.let(sq, "sq", "array_to_string(list_transform(ws, lambda wd, wi: "
                 f"case when {glued} then wd else ' ' || wd end), '')"))
    out = q.let(words, "ws", f"case when len(ws) = 0 then '' else {glue} end")
    out = q.sub(out, rf"(^|[^{q.W}])i($|[^{q.W}])", r"\1I\2")
    out = q.sub(out, rf"(^|[^{q.W}])i($|[^{q.W}])", r"\1I\2")
    marked = q.sub(out, rf"([.!?][{q.S}])", "\\1\x01")
    capital = ("case when regexp_matches(s, '^[a-z]') then upper(s[1:1]) || s[2:] else s end")
    out = (f"array_to_string(list_transform(string_split({marked}, '\x01'), lambda s: {capital}), '')")
    out = q.sub(out, rf"[{q.S}]+([.,!?;:])", r"\1")
    out = q.squeeze(out)
    return q.let(out, "fin", "case when fin = '' or regexp_matches(fin, '[.!?]$') then fin "
                 "else fin || '.' end")


#: Raw names of slots, by the learned map.
INVERSE = """, iv as (select map(list(slot), list(raw)) as im from (select * from sm
   where slot <> '<ph_details>' qualify row_number() over (partition by slot order by n desc, raw) = 1))"""


@query(q.CLEANED_SUPPORT + INVERSE + f", tk as (select row_id, {q.tokens('response_clean')} as toks, "
       "string_split(query_clean, ' ') as qt from cl) "
       f"select row_id, {render_sql('qt', 'im')} as query_text, {render_sql('toks', 'im')} as reply_text from tk, iv")
def render_support(spark, sf):
    usable = usable_pairs(support_rows(spark, sf))
    mapping = stage(slots.slot_map(usable, ["query", "response"]), "slots")
    toks = compute_once(clean_pairs(usable, mapping), qt=F.split("query_clean", " ", -1),
                        rt=text.tokenize(F.col("response_clean")))
    shown = slots.render_df(toks, {"qt": "query_text", "rt": "reply_text"}, mapping)
    return shown.select("row_id", "query_text", "reply_text")


@query(f"select doc_id, {render_sql(q.tokens('lower(text)'))} as reply from documents")
def render_documents(spark, sf):
    return texts(spark, sf, "documents").select(
        "doc_id", render(text.tokenize(F.lower("text"))).alias("reply"))
