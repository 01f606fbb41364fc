"""Evaluation metrics and the count-based reply model."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairmill.catalog import sqltext as q
from pairmill.catalog.dictionaries import train_lines
from pairmill.catalog.inputs import dialogues, lines, staged_tokens, table, texts
from pairmill.catalog.registry import query
from pairmill.functions import scoring, text
from pairmill.functions.basics import compute_once
from pairmill.operators import lm, metrics
from pairmill.plans.evaluate import evaluate
from pairmill.sources.staging import stage

# A line is scored against the next line of its document; strategy = language.
_ALIGNED = q.LINES + """,
al as (select row_id, intent as strategy, query as hyp, response as ref from lp)"""


def aligned(spark, sf):
    return lines(spark, sf).select("row_id", F.col("intent").alias("strategy"),
                                   F.col("query").alias("hyp"), F.col("response").alias("ref"))


def _13a(x: str) -> str:
    x = f"replace(replace(replace({x}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' ')"
    for entity, plain in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        x = f"replace({x}, '{entity}', '{plain}')"
    x = f"' ' || {x} || ' '"
    x = q.sub(f"({x})", r"([\{-~\[-` -&\(-\+:-@/])", r" \1 ")
    x = q.sub(x, r"([^0-9])([.,])", r"\1 \2 ")
    x = q.sub(x, r"([.,])([^0-9])", r" \1 \2")
    x = q.sub(x, r"([0-9])(-)", r"\1 \2 ")
    return f"list_filter(regexp_split_to_array({x}, {q.lit(f'[{q.S}]+')}), lambda w: w <> '')"


def _overlap(source: str, orders: range, joiner: str = "' '") -> str:
    """(row_id, n, m, h, r): exploded n-grams, counted and joined."""
    parts = []
    for side in ("h", "r"):
        for n in orders:
            gram = f"array_to_string(a[i:i + {n - 1}], {joiner})"
            parts.append(f"select row_id, strategy, {n} as n, '{side}' as side, {gram} as g from "
                         f"(select row_id, strategy, {side}a as a, unnest(range(1, len({side}a) - {n - 2})) as i "
                         f"from {source})")
    grams = " union all ".join(parts)
    return f"""gc as (select row_id, strategy, n, g, count(*) filter (where side = 'h') as hc,
   count(*) filter (where side = 'r') as rc from ({grams}) group by all),
ov as materialized (select row_id, strategy, n, cast(sum(least(hc, rc)) as double) as m,
   cast(sum(hc) as double) as h, cast(sum(rc) as double) as r from gc group by all)"""


def _bleu_rows(by: str) -> str:
    """One row per group: score from per-order totals in ``tot``."""
    return f"""ps as (select *, case when m > 0 then m / h else
   1.0 / (pow(2, sum(case when m = 0 then 1 else 0 end) over (partition by {by} order by n)) * h) end as p
   from tot where h > 0),
bl as (select {by}, case when sum(m) = 0 then 0.0 else 100.0 * exp(avg(ln(p))) end as geo,
   count(*) as orders from ps group by {by})"""


@query(_ALIGNED + f""",
tk as (select row_id, strategy, {_13a('lower(hyp)')} as ha, {_13a('lower(ref)')} as ra from al),
{_overlap('tk', range(1, 5))},
tot as (select strategy, n, sum(m) as m, sum(h) as h, sum(r) as r from ov group by all),
{_bleu_rows('strategy')}
select strategy, round(geo * (select case when h >= r then 1.0 else exp(1 - r / h) end
  from tot t where t.strategy = bl.strategy and n = 1), 6) as bleu from bl""")
def corpus_bleu(spark, sf):
    scored = compute_once(aligned(spark, sf),
                          bleu_lower=scoring.bleu_overlap(F.col("hyp"), F.col("ref"), True))
    return metrics.corpus_bleu(scored, ["strategy"]).select(
        "strategy", F.round("bleu", 6).alias("bleu"))


@query(_ALIGNED + f""",
tk as (select row_id, strategy, {_13a('hyp')} as ha, {_13a('ref')} as ra from al),
{_overlap('tk', range(1, 5))},
tot as (select * from ov), {_bleu_rows('row_id')},
ro as (select strategy, row_id, coalesce(geo, 0.0) * case when o1.h >= len(ra) then 1.0
  when o1.h is null then 0.0 else exp(1 - len(ra) / o1.h) end as s
 from tk left join bl using (row_id) left join (select row_id, h from ov where n = 1) o1 using (row_id))
select strategy, round(avg(s), 6) as sentence_bleu from ro group by 1""")
def sentence_bleu(spark, sf):
    scored = compute_once(aligned(spark, sf),
                          bleu_cased=scoring.bleu_overlap(F.col("hyp"), F.col("ref"), False))
    return metrics.mean_sentence_bleu(scored, ["strategy"]).select(
        "strategy", F.round("sentence_bleu", 6).alias("sentence_bleu"))


_CHRF_FORM = """tot as (select strategy, n, sum(m) as m, sum(case when r > 0 then h else 0 end) as h,
   sum(r) as r from ov group by all),
pr as (select strategy, avg(m / h) as p, avg(m / r) as c from tot where h > 0 and r > 0 group by 1)
select strategy, round(case when p + c > 0 then 100.0 * 5 * p * c / (4 * p + c) else 0.0 end, 6) as chrf from pr"""


@query(f"""with {q.DIALOGUES},
tk as (select row_id, 'next' as strategy,
  regexp_extract_all({q.sub('query', f'[{q.S}]+', '')}, '(?s).') as ha,
  regexp_extract_all({q.sub('response', f'[{q.S}]+', '')}, '(?s).') as ra from dp),
{_overlap('tk', range(1, 7), "''")}, {_CHRF_FORM}""")
def corpus_chrf(spark, sf):
    pairs = dialogues(spark, sf).select("row_id", F.lit("next").alias("strategy"),
                                        F.col("query").alias("hyp"), F.col("response").alias("ref"))
    scored = compute_once(pairs, chrf=scoring.chrf_overlap(F.col("hyp"), F.col("ref")))
    return metrics.corpus_chrf(scored, ["strategy"]).select(
        "strategy", F.round("chrf", 6).alias("chrf"))


@query(_ALIGNED + f""",
tk as (select row_id, strategy,
  list_filter(regexp_split_to_array(lower(hyp), '[^a-z0-9]+'), lambda w: w <> '') as ha,
  list_filter(regexp_split_to_array(lower(ref), '[^a-z0-9]+'), lambda w: w <> '') as ra from al),
{_overlap('tk', range(1, 3))},
fs as (select tk.strategy, tk.row_id, coalesce(max(2 * m / (h + r)) filter (where n = 1), 0.0) as f1,
  coalesce(max(2 * m / (h + r)) filter (where n = 2), 0.0) as f2
 from tk left join ov using (row_id) group by all)
select strategy, round(avg(f1), 6) as rouge1, round(avg(f2), 6) as rouge2 from fs group by 1""")
def rouge_n(spark, sf):
    scored = compute_once(aligned(spark, sf),
                          rouge=scoring.rouge_overlap(F.col("hyp"), F.col("ref")))
    return metrics.mean_rouge_n(scored, ["strategy"]).select(
        "strategy", F.round("rouge1", 6).alias("rouge1"), F.round("rouge2", 6).alias("rouge2"))


@query(_ALIGNED.replace("with lp", "with recursive lp", 1) + """,
tk as materialized (select row_id, strategy,
  list_filter(regexp_split_to_array(lower(hyp), '[^a-z0-9]+'), lambda w: w <> '') as ha,
  list_filter(regexp_split_to_array(lower(ref), '[^a-z0-9]+'), lambda w: w <> '') as ra from al),
lc as (select row_id, 0 as i, list_transform(ra, lambda w: 0) as l from tk
 union all select lc.row_id, i + 1, list_transform(step, lambda x, j: list_max(step[1:j])) from (
   select lc.row_id, i, list_transform(l, lambda x, j: case when ha[i + 1] = ra[j]
     then case when j > 1 then l[j - 1] else 0 end + 1 else x end) as step
   from lc join tk using (row_id) where i < len(ha)) lc)
select strategy, round(avg(case when len(l) > 0 and len(ha) > 0 then 2.0 * l[-1] / (len(ha) + len(ra)) else 0.0 end), 6)
  as "rougeL" from tk join lc using (row_id) where i = len(ha) group by 1""")
def rouge_l(spark, sf):
    """Longest common subsequences of whole texts."""
    return metrics.rouge_l(aligned(spark, sf)).groupBy("strategy").agg(
        F.round(F.avg("rougeL"), 6).alias("rougeL"))


@query(f"""with t as (select lang, {q.tokens('lower(text)')} as a from documents),
g1 as (select lang, unnest(a) as g from t),
g2 as (select lang, unnest(list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) as g from t)
select lang, round(o.d, 6) as distinct_1, round(w.d, 6) as distinct_2
from (select lang, count(distinct g) / count(*) as d from g1 group by 1) o
join (select lang, count(distinct g) / count(*) as d from g2 group by 1) w using (lang)""")
def distinct_ngrams(spark, sf):
    toks = compute_once(texts(spark, sf, "documents").select("lang", "text"),
                        a=text.tokenize(F.lower("text")))
    one = metrics.distinct_n(toks, "a", 1, ["lang"])
    two = metrics.distinct_n(toks, "a", 2, ["lang"])
    return one.join(two, "lang").select("lang", F.round("distinct_1", 6).alias("distinct_1"),
                                        F.round("distinct_2", 6).alias("distinct_2"))


@query(f"""with c as (select lang, lower({q.trim_space('text')}) as r, count(*) as n from documents group by all)
select lang, count(*) as unique_responses,
 round(sum(case when n > 1 then n else 0 end) / sum(n), 4) as repeated_response_rate from c group by 1""")
def genericity(spark, sf):
    return metrics.genericity(table(spark, sf, "documents"), "text", ["lang"])


@query(f"""select count(*) as count, substr(lower({q.trim_space('text')}), 1, 160) as response from documents
group by lower({q.trim_space('text')}) order by 1 desc, lower({q.trim_space('text')}) limit 5""")
def most_common_replies(spark, sf):
    return metrics.most_common(table(spark, sf, "documents"), "text", 5)


@query(f"""with c as (select lang as strategy, lower({q.trim_space('text')}) as r, count(*) as n
  from documents group by all)
select strategy, cast(row_number() over w as integer) as rank, n as count, substr(r, 1, 160) as response from c
 window w as (partition by strategy order by n desc, r)
 qualify row_number() over w <= 5""")
def top_replies_by_strategy(spark, sf):
    replies = table(spark, sf, "documents").select(F.col("lang").alias("strategy"), "text")
    return metrics.most_common(replies, "text", 5, ["strategy"])


@query(f"""with {q.DIALOGUES} select 'all' as strategy,
 round(avg({q.word_count('query')}), 6) as mean_hypothesis_tokens,
 round(avg({q.word_count('response')}), 6) as mean_reference_tokens from dp""")
def mean_lengths(spark, sf):
    pairs = dialogues(spark, sf).select(F.lit("all").alias("strategy"), F.col("query").alias("hyp"),
                                        F.col("response").alias("ref"))
    out = metrics.mean_lengths(pairs, ["strategy"])
    return out.select("strategy", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


MODEL = q.PREPARED_LINES + """,
bg as (select row_id, split, unnest(list_zip(list_concat(['<sos>'], response_tokens),
   list_concat(response_tokens, ['<eos>']))) as vw from prep),
b as materialized (select row_id, split, vw[1] as v, vw[2] as w from bg),
cvw as materialized (select v, w, count(*) as n from b where split = 'train' group by all),
cv as (select v, sum(n) as nv from cvw group by 1), cw as (select w, sum(n) as nw from cvw group by 1),
sz as (select sum(nw) + count(*) + 1 as d from cw),
lpr as (select row_id, split, ln(case when nv is null then (coalesce(nw, 0) + 1) / d
   else 0.7 * coalesce(n, 0) / nv + 0.3 * (coalesce(nw, 0) + 1) / d end) as lp
 from b left join cvw using (v, w) left join cv using (v) left join cw using (w), sz)"""


@query(MODEL + " select v, w, n from cvw")
def reply_bigrams(spark, sf):
    grams = train_lines(spark, sf).select(F.inline(lm.bigrams(F.col("response_tokens"))))
    return grams.groupBy("v", "w").agg(F.count("*").alias("n"))


@query(MODEL + " select row_id, round(avg(lp), 6) as avg_logprob from lpr where split <> 'train' group by 1")
def reply_logprobs(spark, sf):
    prep = staged_tokens(spark, sf)
    model = lm.train_reply_model(prep.where("split = 'train'"))
    out = lm.mean_reply_logprob(prep.where("split <> 'train'"), model)
    return out.select("row_id", F.round("avg_logprob", 6).alias("avg_logprob"))


@query(MODEL + """ select split, round(exp(-sum(lp) / count(*)), 5) as perplexity,
 count(*) as n_tokens from lpr group by 1""")
def perplexity(spark, sf):
    prep = staged_tokens(spark, sf)
    model = lm.train_reply_model(prep.where("split = 'train'"))
    return lm.corpus_perplexity(prep, model, ["split"]).select(
        "split", F.round("perplexity", 5).alias("perplexity"), "n_tokens")


@query("""select event_type, round(exp(sum(value / 100) / count(*)), 6) as perplexity,
 count(*) as n_tokens from events group by 1""")
def perplexity_of_table(spark, sf):
    rows = table(spark, sf, "events").select("event_type", (-F.col("value") / 100).alias("logprob"))
    return lm.perplexity(rows, ["event_type"]).select(
        "event_type", F.round("perplexity", 6).alias("perplexity"), "n_tokens")


@query("""with h as (select conv_id, turn, text as hyp from conversations where role = 'user'),
r as (select conv_id, turn - 1 as turn, text as ref from conversations where role = 'assistant')
select conv_id, turn, length(hyp) as hyp_chars, length(ref) as ref_chars from h join r using (conv_id, turn)""")
def aligned_pairs(spark, sf):
    turns = table(spark, sf, "conversations")
    hyp = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("hyp"))
    ref = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("ref"))
    return metrics.align(hyp, ref, ["conv_id", "turn"]).select(
        "conv_id", "turn", F.length("hyp").cast("bigint").alias("hyp_chars"),
        F.length("ref").cast("bigint").alias("ref_chars"))


@query()
def evaluation_report(spark, sf):
    """Every metric for two strategies plus perplexity of held-out lines."""
    pairs = dialogues(spark, sf)
    both = pairs.select("row_id", F.inline(F.array(
        F.struct(F.lit("echo").alias("strategy"), F.col("query").alias("hyp")),
        F.struct(F.lit("copy").alias("strategy"), F.col("response").alias("hyp")))),
        F.col("response").alias("ref"))
    prep = staged_tokens(spark, sf)
    model = lm.train_reply_model(prep.where("split = 'train'"))
    return evaluate(both, prep, model)
