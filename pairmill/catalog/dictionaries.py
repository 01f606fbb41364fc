"""Vocabulary, encoding, lexicon and training batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairmill.catalog import sqltext as q
from pairmill.catalog.inputs import joined, prepared_lines, staged_tokens, texts
from pairmill.catalog.registry import query
from pairmill.functions import arrays, text
from pairmill.functions.basics import compute_once
from pairmill.operators import gate, vocab
from pairmill.sources.staging import stage

TRAIN_TOKENS = q.PREPARED_LINES + """,
tt as (select unnest(query_tokens) as token from prep where split = 'train'
  union all select unnest(response_tokens) from prep where split = 'train'),
tc as materialized (select token, count(*) as n from tt
  where token not in ('<pad>', '<sos>', '<eos>', '<unk>') group by token),
vo as materialized (select token, cast(row_number() over (order by n desc, token) + 3 as integer) as id, n
  from tc where n >= 2)"""


def train_lines(spark, sf):
    return prepared_lines(spark, sf).where(F.col("split") == "train")


@query(TRAIN_TOKENS + " select token, n from tc")
def token_counts(spark, sf):
    return vocab.token_counts(train_lines(spark, sf), ["query_tokens", "response_tokens"])


@query(TRAIN_TOKENS + " select token, id, n from vo order by id")
def vocabulary(spark, sf):
    return vocab.build_vocab(train_lines(spark, sf), ["query_tokens", "response_tokens"])


@query(TRAIN_TOKENS + " select token, id, n from vo where id < 1000 order by id")
def vocabulary_of_fixed_size(spark, sf):
    return vocab.build_vocab(train_lines(spark, sf), ["query_tokens", "response_tokens"],
                             max_size=1000)


@query(TRAIN_TOKENS + """,
al as (select unnest(query_tokens) as token from prep union all select unnest(response_tokens) from prep)
select round(sum(case when id is not null then 1 else 0 end) / count(*), 6) as coverage
from al left join vo using (token)""")
def token_coverage(spark, sf):
    counts = stage(vocab.sided_counts(prepared_lines(spark, sf)), "counts")

    def summed(rows):
        return rows.groupBy("token").agg(F.sum("n").alias("n"))
    words = vocab.vocab_from_counts(summed(counts.where("split = 'train'")))
    return vocab.coverage(summed(counts), words).select(F.round("coverage", 6).alias("coverage"))


@query(TRAIN_TOKENS + """,
te as (select row_id, unnest(case when len(response_tokens) = 0 then [null] else response_tokens end) as token
  from prep where split <> 'train')
select row_id, round(coalesce(sum(case when token is not null and id is null then 1 else 0 end)
  / nullif(count(token), 0), 1.0), 6) as oov_ratio from te left join vo using (token) group by row_id""")
def token_oov_ratio(spark, sf):
    prep = staged_tokens(spark, sf)
    words = stage(vocab.build_vocab(prep.where("split = 'train'"),
                                    ["query_tokens", "response_tokens"]), "vocab")
    out = vocab.oov_ratio(prep.where("split <> 'train'"), "response_tokens", words)
    return out.select("row_id", F.round("oov_ratio", 6).alias("oov_ratio"))


_ENCODED = TRAIN_TOKENS + """,
ex as (select row_id, 'q' as side, unnest(query_tokens[1:30]) as token,
   generate_subscripts(query_tokens[1:30], 1) as p from prep
 union all select row_id, 'r', unnest(response_tokens[1:118]),
   generate_subscripts(response_tokens[1:118], 1) from prep),
il as (select row_id, list(coalesce(id, 3) order by p) filter (where side = 'q') as qi,
   list(coalesce(id, 3) order by p) filter (where side = 'r') as ri
 from ex left join vo using (token) group by row_id),
en as materialized (select row_id,
   list_resize(list_concat([1], qi, [2]), 32, 0) as src,
   list_resize(list_concat([1], ri, [2]), 120, 0) as tgt from il)"""


def encoded_lines(spark, sf):
    prep = staged_tokens(spark, sf)
    words = stage(vocab.build_vocab(prep.where("split = 'train'"),
                                    ["query_tokens", "response_tokens"]), "vocab")
    out = vocab.encode_columns(prep.select("row_id", "query_tokens", "response_tokens"),
                               {"query_tokens": ("src", 32), "response_tokens": ("tgt", 120)}, words)
    return out, words


@query(_ENCODED + " select row_id, array_to_string(src, ' ') as src, array_to_string(tgt, ' ') as tgt from en")
def encoded_pairs(spark, sf):
    encoded, _ = encoded_lines(spark, sf)
    return encoded.select("row_id", joined("src").alias("src"), joined("tgt").alias("tgt"))


@query(_ENCODED + """,
de as (select row_id, unnest(tgt[2:list_position(tgt, 2) - 1]) as id,
  generate_subscripts(tgt[2:list_position(tgt, 2) - 1], 1) as p from en)
select row_id, string_agg(case when id = 3 then '<unk>' else token end, ' ' order by p) as reply,
  cast(0 as bigint) as unknown_ids from de left join vo using (id) group by row_id""")
def decoded_replies(spark, sf):
    encoded, words = encoded_lines(spark, sf)
    out = vocab.decode(encoded.select("row_id", "tgt"), "tgt", words)
    return out.select("row_id", joined("tokens").alias("reply"),
                      F.col("unknown_ids").cast("bigint").alias("unknown_ids"))


@query(_ENCODED + """ select row_id, array_to_string(tgt[1:119], ' ') as decoder_input,
 array_to_string(tgt[2:120], ' ') as decoder_labels from en""")
def teacher_forcing(spark, sf):
    encoded, _ = encoded_lines(spark, sf)
    return encoded.select("row_id", joined(arrays.decoder_input(F.col("tgt"))).alias("decoder_input"),
                          joined(arrays.decoder_labels(F.col("tgt"))).alias("decoder_labels"))


@query(_ENCODED + """,
sz as (select *, len(list_filter(src, lambda x: x <> 0)) as sl, len(list_filter(tgt, lambda x: x <> 0)) as tl from en),
ba as (select *, cast(floor((row_number() over (order by sl, tl, row_id) - 1) / 64) as bigint) as batch_id from sz),
mx as (select *, max(sl) over (partition by batch_id) as ms, max(tl) over (partition by batch_id) as mt from ba)
select batch_id, row_id, array_to_string(src[1:ms], ' ') as src,
 array_to_string(tgt[1:mt - 1], ' ') as tgt_in, array_to_string(tgt[2:mt], ' ') as tgt_out from mx""")
def training_batches(spark, sf):
    encoded, _ = encoded_lines(spark, sf)
    out = vocab.training_batches(encoded)
    return out.select("batch_id", "row_id", *[joined(c).alias(c) for c in ("src", "tgt_in", "tgt_out")])


_TRIGRAMS = f"""with t as (select doc_id, {q.tokens('lower(text)')} as a from documents),
z as (select doc_id, a[-2] as x, a[-1] as y, unnest(list_zip(a, a[2:], a[3:])) as g,
  generate_subscripts(a, 1) as p, len(a) as n from t)"""


@query(_TRIGRAMS + """ select g[1] || ' ' || g[2] || ' ' || g[3] as gram, count(*) as n from z
 where g[3] is not null group by 1""")
def trigram_counts(spark, sf):
    toks = compute_once(texts(spark, sf, "documents"), a=text.tokenize(F.lower("text")))
    grams = toks.select(F.explode(arrays.ngrams(F.col("a"), 3)).alias("g"))
    return (grams.select(F.array_join("g", " ").alias("gram"))
            .groupBy("gram").agg(F.count("*").alias("n")))


@query(_TRIGRAMS + """ select doc_id,
 coalesce(string_agg(g[3], ' ' order by p) filter (where p <= n - 2 and g[1] = x and g[2] = y), '') as completions,
 count(distinct (g[1], g[2], g[3])) filter (where p <= n - 2) < count(*) filter (where p <= n - 2) as has_repeat
 from z group by doc_id""")
def repeated_trigrams(spark, sf):
    toks = compute_once(texts(spark, sf, "documents"), a=text.tokenize(F.lower("text")))
    return toks.select("doc_id", joined(arrays.repeat_completions(F.col("a"), 3)).alias("completions"),
                       arrays.has_repeat(F.col("a"), 3).alias("has_repeat"))


LEXICON = q.PREPARED_LINES + f""",
qc as (select token, count(*) as n from (select unnest(query_tokens) as token from prep
  where split = 'train') group by token),
an as (select token, row_number() over (order by n desc, token) as anchor_rank from qc
  where regexp_matches(token, {q.lit(q.fixed.CONTENT_WORD)}) and token not in {q.in_list(q.fixed.STOPWORDS)}
  order by n desc, token limit 200),
lx as materialized (select token, n, n >= 2 as known, cast(anchor_rank as integer) as anchor_rank
  from qc left join an using (token) where n >= 2 or anchor_rank is not null)"""


@query(LEXICON + " select token, n, known, anchor_rank from lx")
def scope_lexicon(spark, sf):
    return gate.scope_lexicon(train_lines(spark, sf))


@query(LEXICON + " select token, anchor_rank, n from lx where anchor_rank is not null order by 2")
def anchors(spark, sf):
    lexicon = gate.scope_lexicon(train_lines(spark, sf))
    return (lexicon.where(F.col("anchor_rank").isNotNull())
            .select("token", "anchor_rank", "n"))
