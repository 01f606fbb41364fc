"""Filters, dedupe, splits and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairmill.catalog import sqltext as q
from pairmill.catalog.inputs import (cleaned_lines, dialogues, lines, prepared_lines, support_rows,
                                     table)
from pairmill.catalog.registry import query
from pairmill.operators import filters, slots, split, stats
from pairmill.plans.prepare import kept_clean_pairs, prepare, usable_pairs


@query(q.SUPPORT + " select row_id, query, response from sup order by row_id limit 100")
def first_rows(spark, sf):
    return filters.first_rows(support_rows(spark, sf).select("row_id", "query", "response"), 100)


@query(q.SUPPORT + " select row_id, query, response from sup "
       "where query is not null and response is not null")
def drop_null_pairs(spark, sf):
    return filters.drop_null_pairs(support_rows(spark, sf)).select("row_id", "query", "response")


@query(q.USABLE_SUPPORT + " select row_id, query from us")
def drop_automated(spark, sf):
    return usable_pairs(support_rows(spark, sf)).select("row_id", "query")


@query(q.CLEANED_LINES + f" select row_id from cl where {q.FINE}")
def proper_lengths(spark, sf):
    return cleaned_lines(spark, sf).where(filters.proper_length()).select("row_id")


@query(q.CLEANED_LINES + """ select row_id, query_clean, response_clean from cl
 qualify row_number() over (partition by query_clean, response_clean order by row_id) = 1""")
def first_copies(spark, sf):
    kept = filters.drop_repeated_pairs(cleaned_lines(spark, sf))
    return kept.select("row_id", "query_clean", "response_clean")


@query("""select doc_id, text, source from documents
 qualify row_number() over (partition by text, lang order by doc_id) = 1""")
def first_copy_documents(spark, sf):
    docs = table(spark, sf, "documents")
    return (filters.drop_repeated_pairs(docs, "text", "lang", "doc_id")
            .select("doc_id", "text", "source"))


@query(q.CLEANED_LINES + ", " + q.kept() + " select row_id, query_clean, category from kept")
def capped_replies(spark, sf):
    return kept_clean_pairs(lines(spark, sf)).select("row_id", "query_clean", "category")


_STATS_SQL = q.CLEANED_SUPPORT + ", " + q.kept() + f""",
prep as (select *, string_split(query_clean, ' ') as query_tokens, {q.tokens('response_clean')} as fr,
   {q.split_of('query_clean')} as split from kept),
pr as (select *, {q.truncate('fr')} as response_tokens from prep),
tk as materialized (select split, 'query' as side, unnest(query_tokens) as token from pr
  union all select split, 'response', unnest(response_tokens) from pr),
vc as (select token, count(*) as n from tk where split = 'train' group by 1 having count(*) >= 2)
select (select count(*) from sup) as raw_pairs,
 (select count(*) from sup where query is null or response is null) as dropped_null,
 (select count(*) from sup where query is not null and response is not null)
   - (select count(*) from us) as dropped_automated,
 (select count(distinct slot) from sm) as placeholder_types,
 (select count(*) from us) - (select count(*) from w1) as dropped_duplicate_pairs,
 (select count(*) from w1) - (select count(*) from f5) as dropped_too_short,
 (select count(*) from f5) - (select count(*) from kept) as dropped_over_represented,
 (select count(*) from kept) as pairs_after_cleaning,
 (select count(*) from pr where len(fr) > 118) as truncated_responses,
 (select round(avg(len(query_tokens)), 2) from pr) as mean_query_tokens,
 (select round(avg(len(response_tokens)), 2) from pr) as mean_response_tokens,
 (select count(*) from pr where split = 'train') as train_size,
 (select count(*) from pr where split = 'valid') as valid_size,
 (select count(*) from pr where split = 'test') as test_size,
 (select count(*) + 4 from vc) as vocab_size,
 (select round(sum(case when token in (select token from vc) then 1 else 0 end) / count(*), 4)
    from tk) as token_coverage,
 (select count(*) from (select token from tk where split = 'train' and side = 'query'
    group by 1 having count(*) >= 2)) as scope_query_vocab"""


@query(_STATS_SQL)
def preparation_stats(spark, sf):
    """The whole preparation, start to end, as its one-row summary."""
    return prepare(support_rows(spark, sf)).stats


@query(q.PREPARED_LINES + """ select row_id, query_clean, split,
 array_to_string(response_tokens, ' ') as reply, truncated from prep""")
def prepared_pairs(spark, sf):
    return prepared_lines(spark, sf).select(
        "row_id", "query_clean", "split", F.array_join("response_tokens", " ").alias("reply"),
        "truncated")


@query(q.PREPARED_LINES + """ select split, count(*) as n_pairs,
 cast(sum(len(query_tokens)) as bigint) as query_tokens,
 cast(sum(len(response_tokens)) as bigint) as reply_tokens from prep group by split""")
def split_token_counts(spark, sf):
    return prepared_lines(spark, sf).groupBy("split").agg(
        F.count("*").alias("n_pairs"),
        F.sum(F.size("query_tokens")).cast("bigint").alias("query_tokens"),
        F.sum(F.size("response_tokens")).cast("bigint").alias("reply_tokens"))


@query(f"""select split, count(*) as n from (select {q.split_of('text')} as split from documents)
 group by 1""")
def split_sizes(spark, sf):
    docs = table(spark, sf, "documents")
    return split.split_sizes(split.group_split(docs, "text"))


@query("""with k as (select text, row_number() over (order by md5('42:' || text)) - 1 as r,
  count(*) over () as n from (select distinct text from documents)),
 s as (select text, case when r < floor(0.8 * n) then 'train'
   when r < floor(0.8 * n) + floor(0.1 * n) then 'valid' else 'test' end as split from k)
 select doc_id, split from documents join s using (text)""")
def exact_split(spark, sf):
    return split.group_split(table(spark, sf, "documents"), "text", exact=True).select(
        "doc_id", "split")


@query(f"""with s as (select text, {q.split_of('text')} as split from documents)
 select count(*) as shared from (select text from s where split = 'train'
 intersect select text from s where split = 'test')""")
def shared_between_splits(spark, sf):
    s = split.group_split(table(spark, sf, "documents"), "text")
    return split.shared_keys(s.where("split = 'train'"), s.where("split = 'test'"), "text")


@query("""select count(*) as shared from (select text from documents
 intersect select text from benchmark)""")
def shared_with_benchmark(spark, sf):
    return split.shared_keys(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "text")


@query("""select doc_id from documents order by md5('42:' || cast(doc_id as varchar)), doc_id
 limit 400""")
def seeded_sample(spark, sf):
    return filters.seeded_sample(table(spark, sf, "documents").select("doc_id"), 400, key="doc_id")


def _summary(side: str) -> str:
    def pct(p):
        return f"round(quantile_cont(w, {p}), 2)"
    return (f"select '{side}' as side, count(*) as count, round(avg(w), 2) as mean, "
            f"round(stddev_samp(w), 2) as std, cast(min(w) as double) as min, {pct(.25)} as p25, "
            f"{pct(.5)} as p50, {pct(.75)} as p75, cast(max(w) as double) as max "
            f"from (select {q.word_count(side)} as w from dp)")


@query(f"with {q.DIALOGUES} {_summary('query')} union all {_summary('response')}")
def length_summary(spark, sf):
    return stats.length_summary(dialogues(spark, sf), ["query", "response"])


@query(q.SUPPORT + """ select count(distinct category) as n_category,
 count(distinct intent) as n_intent from sup""")
def distinct_intents(spark, sf):
    return stats.distinct_values(support_rows(spark, sf), ["category", "intent"])


@query(q.SUPPORT + " select category, count(*) as n from sup group by 1 order by 2 desc, 1")
def category_counts(spark, sf):
    return stats.value_counts(support_rows(spark, sf), "category")


@query("select p_brand, count(*) as n from part group by 1 order by 2 desc, 1 limit 8")
def top_flags(spark, sf):
    return stats.value_counts(table(spark, sf, "part"), "p_brand", top=8)


@query(q.PREPARED_LINES + " select count(*) as truncated from prep where truncated")
def truncated_replies_count(spark, sf):
    return prepared_lines(spark, sf).agg(F.count_if("truncated").alias("truncated"))


@query("""select cast(26872 as bigint) as expected, count(*) as actual, count(*) = 26872 as ok
 from documents""")
def row_count_check(spark, sf):
    return stats.row_count_check(table(spark, sf, "documents"), 26872)


@query(q.SUPPORT_SLOTS + " select raw, slot, n from sm")
def slot_map(spark, sf):
    return slots.slot_map(usable_pairs(support_rows(spark, sf)), ["query", "response"])


@query(q.SUPPORT_SLOTS + " select count(distinct slot) as placeholder_types from sm")
def slot_types(spark, sf):
    return slots.slot_types(
        slots.slot_map(usable_pairs(support_rows(spark, sf)), ["query", "response"]))


@query(q.SUPPORT_SLOTS + """ select slot, raw from sm where slot <> '<ph_details>'
 qualify row_number() over (partition by slot order by n desc, raw) = 1""")
def inverse_slot_map(spark, sf):
    return slots.inverse_map(
        slots.slot_map(usable_pairs(support_rows(spark, sf)), ["query", "response"]))
