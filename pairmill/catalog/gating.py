"""Scope gate, candidate replies and the answer table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairmill.catalog import sqltext as q
from pairmill.catalog.dictionaries import LEXICON, TRAIN_TOKENS, train_lines
from pairmill.catalog.inputs import SUPPORT_SQL, dialogues, joined, staged_tokens, table, texts
from pairmill.catalog.registry import query
from pairmill.catalog.scores import MODEL
from pairmill.catalog.texts import INVERSE, render_sql
from pairmill.functions import fixed, text
from pairmill.functions.basics import compute_once
from pairmill.operators import gate, hypotheses, lm, slots, vocab
from pairmill.plans.answer import answer_batch, batch_summary
from pairmill.plans.prepare import clean_pairs, tokenised_pairs, usable_pairs
from pairmill.settings import Settings
from pairmill.sources.staging import stage

# Every dialogue query gets a log-probability derived from its reply's length.
_LOGPROB = "-(length(response) % 400) / 300.0"

_SIGNALS_SQL = LEXICON + f""",
{q.DIALOGUES},
dq as (select row_id, query, response, {q.query_tokens(q.clean('query', True))} as qt from dp),
dc as (select *, {q.content('qt')} as cw from dq),
kn as (select list(token) filter (where known) as known,
  list(token) filter (where anchor_rank is not null) as anchors from lx),
si as materialized (select row_id, query, response, qt, cw,
   list_filter(cw, lambda w: not list_contains(known, w)) as unknown,
   cast(len(list_filter(cw, lambda w: list_contains(anchors, w))) as integer) as n_anchors from dc, kn),
sg as materialized (select *, case when len(cw) > 0 then len(unknown) / len(cw)
   when len(list_filter(qt, lambda w: starts_with(w, '<ph_'))) > 0 then 0.0 else 1.0 end as oov,
   {_LOGPROB} as logprob from si)"""


def asked(spark, sf):
    """Dialogue queries with their tokens and a stand-in log-probability."""
    pairs = dialogues(spark, sf).selectExpr("row_id", "query", "response",
                                            f"cast({_LOGPROB} as double) as logprob")
    return compute_once(pairs, query_tokens=text.prepare_query(F.col("query")))


@query(_SIGNALS_SQL + """ select row_id, array_to_string(unknown, ' ') as unknown,
 round(oov, 6) as oov, n_anchors from sg""")
def scope_signals(spark, sf):
    lexicon = stage(gate.scope_lexicon(train_lines(spark, sf)), "lexicon")
    out = gate.scope_signals(asked(spark, sf), lexicon)
    return out.select("row_id", joined("unknown").alias("unknown"),
                      F.round("oov", 6).alias("oov"), "n_anchors")


@query(_SIGNALS_SQL + """ select row_id, array_to_string(unknown, ' ') as unknown,
 round(oov, 6) as oov, n_anchors from sg""")
def scope_signals_by_join(spark, sf):
    """The join form, for lexicons beyond an in-plan set."""
    lexicon = stage(gate.scope_lexicon(train_lines(spark, sf)), "lexicon")
    out = gate.scope_signals(asked(spark, sf), lexicon, always_join=True)
    return out.select("row_id", joined("unknown").alias("unknown"),
                      F.round("oov", 6).alias("oov"), "n_anchors")


_VERDICT = """case when len(qt) = 0 then false else oov <= 0.5 and logprob >= -1.5 end as in_scope,
 case when len(qt) = 0 then 1.0 else round_even(oov, 3) end as oov_ratio, n_anchors,
 array_to_string(unknown[1:8], ' ') as unknown_words,
 case when len(qt) = 0 then 0.0 else round_even(logprob, 3) end as avg_logprob"""
_REASON = """case when len(qt) = 0 then 'empty query after cleaning'
 when oov > 0.5 then cast(cast(round_even(oov * 100, 0) as integer) as varchar)
   || '% of the meaningful words in this query never appear in the support corpus ('
   || case when len(unknown) = 0 then 'none' else array_to_string(unknown[1:5], ', ') end || ')'
 when logprob < -1.5 then printf('the decoder is not confident (mean log-probability %.2f)', logprob)
 else 'in scope (' || n_anchors || ' known support term' || case when n_anchors = 1 then '' else 's' end || ')'
 end as reason"""


@query(_SIGNALS_SQL + f" select row_id, {_VERDICT}, {_REASON} from sg")
def scope_gate(spark, sf):
    lexicon = stage(gate.scope_lexicon(train_lines(spark, sf)), "lexicon")
    out = gate.scope_gate(asked(spark, sf), lexicon)
    return out.select("row_id", "in_scope", "oov_ratio", "n_anchors",
                      joined("unknown_words").alias("unknown_words"), "avg_logprob", "reason")


@query(_SIGNALS_SQL + f""" select row_id, case when len(qt) > 0 and oov <= 0.5 and logprob >= -1.5
 then response else {q.lit(fixed.REFUSAL)} end as reply from sg""")
def refusals(spark, sf):
    lexicon = stage(gate.scope_lexicon(train_lines(spark, sf)), "lexicon")
    out = gate.scope_gate(asked(spark, sf), lexicon)
    return out.select("row_id", gate.substitute_refusal(
        F.col("response"), F.col("in_scope")).alias("reply"))


@query(_SIGNALS_SQL + """, v as (select len(qt) > 0 and oov <= 0.5 and logprob >= -1.5 as ok,
  role_in as inside from sg join (select row_id, length(response) >= length(query) as role_in from sg) using (row_id))
select round(count(*) filter (where inside and ok) / count(*) filter (where inside), 4) as in_domain_accepted,
 round(count(*) filter (where not inside and not ok) / count(*) filter (where not inside), 4)
   as out_of_domain_rejected from v""")
def gate_rates(spark, sf):
    lexicon = stage(gate.scope_lexicon(train_lines(spark, sf)), "lexicon")
    out = gate.scope_gate(asked(spark, sf), lexicon)
    return gate.gate_rates(out.withColumn("in_domain", F.length("response") >= F.length("query")))


_OOD = ", ".join(f"({q.lit(t)})" for t in fixed.OUT_OF_DOMAIN)


@query(LEXICON + f""",
oq as (select query, {q.query_tokens(q.clean('query', True))} as qt from (values {_OOD}) t(query)
  union all select text, {q.query_tokens(q.clean('text', True))} from benchmark),
oc as (select *, {q.content('qt')} as cw from oq),
kn as (select list(token) filter (where known) as known from lx)
select query, round_even(case when len(cw) > 0 then len(list_filter(cw, lambda w: not list_contains(known, w))) / len(cw)
  else 1.0 end, 3) as oov_ratio from oc, kn""")
def out_of_domain_report(spark, sf):
    """The six fixed foreign queries next to the benchmark texts."""
    lexicon = stage(gate.scope_lexicon(train_lines(spark, sf)), "lexicon")
    fixed_rows = spark.createDataFrame(
        [("fixed", str(i), t) for i, t in enumerate(fixed.OUT_OF_DOMAIN)],
        "origin string, item string, query string")
    rows = fixed_rows.union(table(spark, sf, "benchmark").select(
        F.lit("benchmark"), F.col("item_id").cast("string"), "text"))
    rows = compute_once(rows, query_tokens=text.prepare_query(F.col("query")))
    out = gate.scope_gate(rows.withColumn("logprob", F.lit(0.0)), lexicon, key=["origin", "item"])
    return out.select("query", "oov_ratio")


def line_items_as_hypotheses(spark, sf):
    """n-best lists: one query per order, one candidate per line."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("bigint").alias("query_id"), F.lit("beam").alias("strategy"),
        F.col("l_partkey").cast("int").alias("hyp_id"),
        (-F.col("l_extendedprice") / 1000).alias("logprob_sum"),
        F.col("l_quantity").cast("int").alias("len"))


@query("""with h as (select cast(l_orderkey as bigint) as query_id, cast(l_partkey as integer) as hyp_id,
  -l_extendedprice / 1000 as lp, greatest(cast(l_quantity as integer), 1) as len from lineitem)
select query_id, hyp_id, lp / len as avg_logprob from h
qualify row_number() over (partition by query_id order by lp / pow(len, 0.7) desc, hyp_id) = 1""")
def best_hypotheses(spark, sf):
    out = hypotheses.best_hypothesis(line_items_as_hypotheses(spark, sf))
    return out.select("query_id", "hyp_id", "avg_logprob")


@query("""with s as (select user_id as query_id, event_id as pos,
   case when event_type = 'error' then 2 else 5 end as token_id, -value / 100 as logprob from events),
e as (select query_id, min(pos) filter (where token_id = 2) as fin from s group by 1)
select query_id, cast(count(*) filter (where token_id <> 2) as bigint) as n_tokens,
 round(sum(logprob) / count(*), 6) as avg_logprob
from s join e using (query_id) where fin is null or pos <= fin group by 1""")
def cut_at_eos(spark, sf):
    """Events told as decoding steps of one sequence per user."""
    steps = table(spark, sf, "events").select(
        F.col("user_id").alias("query_id"), F.col("event_id").alias("pos"),
        F.when(F.col("event_type") == "error", 2).otherwise(5).alias("token_id"),
        (-F.col("value") / 100).alias("logprob"))
    out = hypotheses.cut_at_eos(steps)
    return out.select("query_id", "n_tokens", F.round("avg_logprob", 6).alias("avg_logprob"))


@query("""select doc_id, quality = 1 and toxic = 0 as in_scope from labels""")
def scope_predicate(spark, sf):
    settings = Settings()
    oov = F.when(F.col("quality") == 1, 0.5).otherwise(0.51)
    logprob = F.when(F.col("toxic") == 0, -1.5).otherwise(-1.51)
    return table(spark, sf, "labels").select(
        "doc_id", gate.in_scope(oov, logprob, settings).alias("in_scope"))


CUTOFF = """,
vq as (select row_id, avg(lp) as m from lpr where split = 'valid' group by 1),
vr as (select m, row_number() over (order by m) as place, ceil(0.05 * count(*) over ()) as wanted from vq),
cut as materialized (select round(m, 6) as c from vr where place = greatest(wanted, 1))"""


def cutoff(prep, model):
    """The gate's bound from the replies of the validation split."""
    valid = stage(lm.mean_reply_logprob(prep.where("split = 'valid'"), model), "valid-scores")
    return gate.logprob_cutoff(valid, exact=True)


@query(MODEL + CUTOFF + " select c as min_logprob from cut")
def logprob_cutoff(spark, sf):
    prep = staged_tokens(spark, sf)
    found = cutoff(prep, lm.train_reply_model(prep.where("split = 'train'")))
    return spark.createDataFrame([(found,)], "min_logprob double")


def answered(spark, sf, limit=None):
    """Dialogue queries answered with candidates: the own reply and the own
    query echoed, both scored by the reply model of the training lines."""
    prep = staged_tokens(spark, sf)
    train = prep.where("split = 'train'")
    words = stage(vocab.build_vocab(train, ["query_tokens", "response_tokens"]), "vocab")
    lexicon = stage(gate.scope_lexicon(train), "lexicon")
    model = lm.train_reply_model(train)
    pairs = stage(tokenised_pairs(clean_pairs(dialogues(spark, sf))), "dialogues")
    both = pairs.select("row_id", F.inline(F.array(
        F.struct(F.lit(1).alias("hyp_id"), F.col("response_tokens").alias("tokens")),
        F.struct(F.lit(2).alias("hyp_id"), F.slice("query_tokens", 1, 118).alias("tokens")))))
    both = stage(both.withColumn("key", F.concat_ws("/", "row_id", "hyp_id")), "candidates")
    scored = lm.reply_logprobs(both, model, "tokens", "key").groupBy("key").agg(
        F.sum("logprob").alias("logprob_sum"), F.count("*").cast("int").alias("len"))
    ids = vocab.encode(both, "tokens", words, 120, add_sos=False, key="key", out="token_ids")
    candidates = stage(ids.join(scored, "key").select(
        F.col("row_id").alias("query_id"), F.lit("beam").alias("strategy"), "hyp_id",
        "token_ids", "logprob_sum", "len"), "hypotheses")
    queries = dialogues(spark, sf).select(F.col("row_id").alias("query_id"), "query")
    settings = Settings(min_logprob=cutoff(prep, model))
    return answer_batch(queries, candidates, lexicon, words, settings=settings, limit=limit)


def _tail(ctes: str) -> str:
    """The part of a CTE chain after the prepared lines."""
    return ctes[len(q.PREPARED_LINES):]


_ANSWERS_SQL = LEXICON + _tail(TRAIN_TOKENS) + _tail(MODEL) + CUTOFF + f""",
{q.DIALOGUES},
dq as materialized (select row_id, query, {q.query_tokens(q.clean('query', True))} as qt,
  {q.truncate(q.tokens(q.clean('response')))} as rt from dp),
ca as (select row_id, 1 as hyp_id, rt as toks from dq union all select row_id, 2, qt[1:118] from dq),
cb as (select row_id, hyp_id, vw[1] as v, vw[2] as w from (select row_id, hyp_id,
  unnest(list_zip(list_concat(['<sos>'], toks), list_concat(toks, ['<eos>']))) as vw from ca)),
cs as (select row_id, hyp_id, count(*) as len, sum(ln(case when nv is null then (coalesce(nw, 0) + 1) / d
   else 0.7 * coalesce(n, 0) / nv + 0.3 * (coalesce(nw, 0) + 1) / d end)) as lp
  from cb left join cvw using (v, w) left join cv using (v) left join cw using (w), sz group by all),
be as (select * from cs qualify row_number() over (partition by row_id
  order by lp / pow(len, 0.7) desc, hyp_id) = 1),
vl as (select list(token) as vocabulary from vo),
kn as (select list(token) filter (where known) as known,
  list(token) filter (where anchor_rank is not null) as anchors from lx),
dr as (select row_id, lp / len as logprob, list_transform(toks, lambda t:
   case when list_contains(vocabulary, t) then t else '<unk>' end) as raw
  from be join ca using (row_id, hyp_id), vl),
g0 as (select *, {q.content('qt')} as cw from dq join dr using (row_id)),
g1 as (select *, list_filter(cw, lambda w: not list_contains(known, w)) as unknown,
   cast(len(list_filter(cw, lambda w: list_contains(anchors, w))) as integer) as n_anchors from g0, kn),
g2 as (select *, case when len(cw) > 0 then len(unknown) / len(cw)
   when len(list_filter(qt, lambda w: starts_with(w, '<ph_'))) > 0 then 0.0 else 1.0 end as oov from g1),
aw as materialized (select row_id as query_id, query,
  case when len(qt) > 0 and oov <= 0.5 and logprob >= c then {render_sql('raw')}
   else {q.lit(fixed.REFUSAL)} end as response,
  {_VERDICT.replace('-1.5', 'c')}, {_REASON.replace('-1.5', 'c')} from g2, cut)"""


@query(_ANSWERS_SQL + """ select query_id, query, response, in_scope, oov_ratio, n_anchors, avg_logprob, reason
 from aw""")
def answers(spark, sf):
    out = answered(spark, sf)
    return out.select("query_id", "query", "response", "in_scope", "oov_ratio", "n_anchors",
                      "avg_logprob", "reason")


@query(_ANSWERS_SQL + f""" select count(*) filter (where not in_scope) as out_of_scope,
 cast(floor(avg({q.word_count('response')})) as bigint) as mean_words from aw""")
def answer_summary(spark, sf):
    return batch_summary(answered(spark, sf))


@query(_ANSWERS_SQL + " select query_id, in_scope, reason from aw order by query_id limit 100")
def answers_with_row_limit(spark, sf):
    return answered(spark, sf, limit=100).select("query_id", "in_scope", "reason")


_BRAND = "case when p_partkey % 3 = 0 then upper(p_brand) else p_brand end"
_PART_COLUMNS = [
    ("p_partkey", "row_id"), ("p_type", "category"), ("p_brand", "intent"),
    (f"concat('How do I return {{{{ ', {_BRAND}, ' }}}} of type {{{{', p_type, '}}}}, the ', p_name, '?')", "query"),
    (f"concat('Your {{{{', p_type, '}}}} by {{{{ ', {_BRAND}, ' }}}} left today. We said \"', p_name,"
     " '\" is fine, {{Size ', p_size, '}} too.')", "response")]
PART_SQL = "select {} from part".format(", ".join(f"{e} as {n}" for e, n in _PART_COLUMNS))
#: Parts told as support messages: all of them training rows, with their own slots.
_PART_ANSWERS = q.CLEANED_SUPPORT.replace(SUPPORT_SQL, PART_SQL) + INVERSE + f""",
prep as materialized (select row_id, string_split(query_clean, ' ') as query_tokens,
  {q.tokens('response_clean')} as response_tokens, 'train' as split from cl)
""" + _tail(LEXICON) + _tail(TRAIN_TOKENS) + f""",
vl as (select list(token) as vocabulary from vo),
kn as (select list(token) filter (where known) as known,
  list(token) filter (where anchor_rank is not null) as anchors from lx),
g0 as (select row_id, query, query_tokens as qt, -0.01 * len(response_tokens) as logprob,
  list_transform(response_tokens[1:119], lambda t: case when list_contains(vocabulary, t) then t else '<unk>' end) as raw,
  {q.content('query_tokens')} as cw from prep join us using (row_id), vl),
g1 as (select *, list_filter(cw, lambda w: not list_contains(known, w)) as unknown,
   cast(len(list_filter(cw, lambda w: list_contains(anchors, w))) as integer) as n_anchors from g0, kn),
g2 as (select *, case when len(cw) > 0 then len(unknown) / len(cw)
   when len(list_filter(qt, lambda w: starts_with(w, '<ph_'))) > 0 then 0.0 else 1.0 end as oov from g1)
select row_id as query_id, query, array_to_string(qt, ' ') as query_tokens,
  case when oov <= 0.5 and logprob >= -1.5 then {render_sql('raw', 'im')}
   else {q.lit(fixed.REFUSAL)} end as response, {_REASON} from g2, iv"""


def slot_answers(spark, sf, settings=Settings()):
    """Queries and replies with template slots, answered by way of a learned slot table."""
    rows = texts(spark, sf, "part").selectExpr(*[f"{e} as {n}" for e, n in _PART_COLUMNS])
    usable = usable_pairs(rows)
    mapping = stage(slots.slot_map(usable, ["query", "response"]), "slots")
    train = stage(compute_once(clean_pairs(usable, mapping, settings), query_tokens=F.split("query_clean", " ", -1),
                               response_tokens=text.tokenize(F.col("response_clean"))), "slot-pairs")
    words = stage(vocab.build_vocab(train, ["query_tokens", "response_tokens"]), "vocab")
    lexicon = stage(gate.scope_lexicon(train), "lexicon")
    ids = vocab.encode(train, "response_tokens", words, 120, add_sos=False, out="token_ids", settings=settings)
    length = F.size("response_tokens")
    candidates = stage(ids.select(
        F.col("row_id").alias("query_id"), F.lit("beam").alias("strategy"), F.lit(1).alias("hyp_id"), "token_ids",
        (F.lit(-0.01) * length * length).alias("logprob_sum"), length.alias("len")), "hypotheses")
    queries = usable.select(F.col("row_id").alias("query_id"), "query")
    return answer_batch(queries, candidates, lexicon, words, mapping, settings=settings)


@query(_PART_ANSWERS)
def answers_with_slots(spark, sf):
    return slot_answers(spark, sf).select("query_id", "query", joined("query_tokens").alias("query_tokens"),
                                          "response", "reason")
