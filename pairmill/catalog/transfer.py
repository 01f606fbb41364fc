"""Sources and sinks: tables written and read back through the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairmill.catalog import sqltext as q
from pairmill.catalog.dictionaries import TRAIN_TOKENS, train_lines
from pairmill.catalog.inputs import dialogues, prepared_lines, support_rows, table, texts
from pairmill.catalog.registry import query
from pairmill.catalog.texts import render_sql
from pairmill.functions import text
from pairmill.operators import filters, metrics, vocab
from pairmill.schema import PREPARED_PAIRS
from pairmill.sources import readers, writers
from pairmill.sources.staging import stage, stage_path


@query(q.SUPPORT + """ select query, response, category, intent, flags from sup
 where query is not null""")
def pair_csv(spark, sf):
    """Pairs through CSV: renamed, declared, quotes and line breaks kept."""
    rows = support_rows(spark, sf).where(F.col("query").isNotNull())
    rows = rows.select("flags", F.col("query").alias("instruction"), "category", "intent", "response")
    path = stage_path(spark, "pairs") + ".csv"
    writers.write_csv(rows, path)
    return readers.read_pairs(spark, path, rows.schema)


@query(f"""with {q.DIALOGUES} select query, response from dp""")
def dialogue_csv(spark, sf):
    """Multi-line texts through CSV."""
    rows = dialogues(spark, sf).select(F.col("query").alias("instruction"), "response")
    path = stage_path(spark, "dialogues") + ".csv"
    writers.write_csv(rows, path)
    return readers.read_pairs(spark, path, rows.schema)


@query(f"""with l as (select {q.trim_space('unnest(string_split(text, chr(10)))')} as query from documents)
select query, count(*) as n from l where query <> '' group by 1""")
def query_lines(spark, sf):
    path = stage_path(spark, "lines")
    table(spark, sf, "documents").select("text").write.text(path)
    return readers.read_query_lines(spark, path).groupBy("query").agg(F.count("*").alias("n"))


@query(q.SUPPORT + " select query from sup where query is not null")
def query_csv(spark, sf):
    """The query column is found by name, next to other text columns."""
    rows = support_rows(spark, sf).where(F.col("query").isNotNull()).select(
        F.concat(F.lit("T-"), "row_id").alias("ticket_id"), F.col("category").alias("channel"), "query")
    path = stage_path(spark, "tickets") + ".csv"
    writers.write_csv(rows, path)
    return readers.read_queries(spark, path)


@query("select text as query from benchmark")
def detected_query_column(spark, sf):
    return readers.queries_of(table(spark, sf, "benchmark"))


@query(q.PREPARED_LINES + """ select row_id, query_clean, array_to_string(response_tokens, ' ') as reply
 from prep where split = 'valid'""")
def split_folders(spark, sf):
    """Splits written as folders; reading one prunes the others."""
    path = stage_path(spark, "splits")
    prepared = prepared_lines(spark, sf).select(*PREPARED_PAIRS.fieldNames())
    writers.write_splits(prepared, path)
    return readers.read_split(spark, path, "valid").select(
        "row_id", "query_clean", F.array_join("response_tokens", " ").alias("reply"))


@query(q.PREPARED_LINES + """ select query_clean, array_to_string(response_tokens, ' ') as response_clean,
 coalesce(category, '') as category, coalesce(intent, '') as intent, cast(len(query_tokens) as bigint) as n_tokens
 from prep where split = 'test'""")
def split_csv(spark, sf):
    """A split through CSV, read line by line in many tasks."""
    path = stage_path(spark, "split") + ".csv"
    prepared = prepared_lines(spark, sf).where(F.col("split") == "test")
    writers.write_csv(prepared.select("query_clean", F.array_join("response_tokens", " ").alias("response_clean"),
                                      "category", "intent"), path)
    return readers.read_split_csv(spark, path, multi_line=False).select(
        "query_clean", "response_clean", "category", "intent",
        F.size("query_tokens").cast("bigint").alias("n_tokens"))


@query(TRAIN_TOKENS + " select token, id, n from vo")
def vocabulary_file(spark, sf):
    words = vocab.build_vocab(train_lines(spark, sf), ["query_tokens", "response_tokens"])
    path = stage_path(spark, "vocab") + ".json"
    writers.write_dictionary(words, path)
    return readers.read_dictionary(spark, path, "token string, id int, n bigint")


@query(f"""with c as (select lang, lower({q.trim_space('text')}) as r, count(*) as n from documents group by all),
g as (select lang, cast(count(*) as double) as u,
  round(sum(case when n > 1 then n else 0 end) / sum(n), 4) as s from c group by 1)
select lang as strategy, 'unique_responses' as metric, u as value from g
union all select lang, 'repeated_response_rate', s from g""")
def metrics_file(spark, sf):
    """Metrics as narrow rows through JSON."""
    replies = table(spark, sf, "documents").select(F.col("lang").alias("strategy"), "text")
    rows = metrics.narrow(metrics.genericity(replies, "text", ["strategy"]), "strategy")
    path = stage_path(spark, "metrics") + ".json"
    writers.write_dictionary(rows, path)
    return readers.read_dictionary(spark, path, rows.schema)


@query("""select l_comment as query, reply as generated_response, ok as in_scope, ratio as unknown_word_ratio,
 lp as mean_logprob from (select text as l_comment, lang as reply, n_chars > 500 as ok,
 n_chars / 64.0 as ratio, -n_chars / 32.0 as lp from documents)""")
def answers_export(spark, sf):
    """The export columns, written as CSV and read back."""
    answers = table(spark, sf, "documents").select(
        F.col("text").alias("query"), F.col("lang").alias("response"),
        (F.col("n_chars") > 500).alias("in_scope"), (F.col("n_chars") / 64.0).alias("oov_ratio"),
        (-F.col("n_chars") / 32.0).alias("avg_logprob"))
    export = writers.answers_export(answers)
    path = stage_path(spark, "answers") + ".csv"
    writers.write_csv(export, path)
    return spark.read.schema(export.schema).options(**readers.csv_options()).csv(path)


@query(f"""with {q.DIALOGUES},
en as (select conv_id, turn, 'Customer: ' || query || chr(10) || 'Assistant: ' || response as entry from dp),
pa as (select *, cast(coalesce(sum(strlen(entry)) over (partition by conv_id order by turn, entry
   rows between unbounded preceding and 1 preceding), 0) // 300 as bigint) as part from en)
select conv_id, part, string_agg(entry, chr(10) || chr(10) order by turn, entry) as transcript from pa group by all""")
def transcripts(spark, sf):
    """Parts of 300 bytes, so that a conversation has several."""
    return writers.transcripts(dialogues(spark, sf), "conv_id", "turn", "query", "response", bytes_per_part=300)


@query(f"""with s as (select doc_id, text, lang from documents
 order by md5('42:' || cast(doc_id as varchar)), doc_id limit 20)
select doc_id, lang as intent, cast({q.word_count('text')} as bigint) as n_words from s""")
def rating_sample(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    sample = filters.seeded_sample(docs, 20, key="doc_id")
    return sample.select("doc_id", F.col("lang").alias("intent"),
                         text.word_count(F.col("text")).cast("bigint").alias("n_words"))


@query(q.PREPARED_LINES + f""", sa as (select * from prep
 order by md5('42:' || cast(row_id as varchar)), row_id limit 20)
select {render_sql('query_tokens')} as query, {render_sql('response_tokens')} as reference_reply,
 {render_sql('query_tokens')} as generated_reply, intent, '' as relevance_1_to_5, '' as fluency_1_to_5,
 '' as would_send_as_is_yes_no, '' as rater_comment from sa""")
def rating_sheet(spark, sf):
    rows = prepared_lines(spark, sf).select(
        "row_id", "query_clean", F.array_join("response_tokens", " ").alias("response_clean"),
        F.col("query_clean").alias("generated"), "intent")
    return writers.rating_sheet(filters.seeded_sample(rows, 20))


@query("select page_id as row_id, url as query from pages")
def page_queries(spark, sf):
    pages = stage(texts(spark, sf, "pages").select(F.col("page_id").alias("row_id"),
                                                  F.col("url").alias("question"), "html"), "pages")
    return pages.select("row_id", F.col(readers.query_column(pages.schema)).alias("query"))
