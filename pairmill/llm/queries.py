"""Queries of the document operators, and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.llm import (divergence, exact, grading, idfiles, language, lines, ngrams, packing, pieces,
                          quality, repeats, simhash, whitening)
from pairmill.llm.common import documents
from pairmill.sources.staging import stage_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(documents(spark, sf_dir)).drop("kept")


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def language_training(docs: DataFrame) -> DataFrame:
    """Labelled documents outside the held-out third."""
    return docs.where("pmod(crc32(cast(doc_id as string)), 3) <> 1 and lang is not null")


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identified(docs, language_training(docs)).select(
        "doc_id", F.expr("crc32(cast(doc_id as string)) % 3 = 1").alias("held_out"), "lang_pred", "score",
        F.size("spans").alias("n_spans"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir))


@query
def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "token-ids")
    idfiles.write_ids(documents(spark, sf_dir), path)
    return idfiles.read_ids(spark, path)


@query
def op6_piece_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.segmented(documents(spark, sf_dir))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(documents(spark, sf_dir))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades: toxic 0, of low quality 1, good 2."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        "doc_id", F.expr("case when toxic = 1 then 0 else 1 + quality end").alias("grade"))
    return grading.graded(documents(spark, sf_dir), labels)


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


SQL["op9_exact_dedup"] = """with d as (select doc_id, coalesce(text, '') as t from documents)
 select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(t) as text_sha256
 from d window same as (partition by t)"""


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.by_component(whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


@query
def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.near_documents(documents(spark, sf_dir))


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(documents(spark, sf_dir))


SQL["op13_source_divergence"] = r"""with d as (
  select row_number() over () as k, coalesce(lang, '') as lang, coalesce(source, '') as source,
   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
 w as (select k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
 s as (select lang, source, term, count(*)::hugeint as n, count(distinct k) as docs from w group by all),
 l as (select lang, term, sum(n)::hugeint as n from s group by all having sum(docs) >= 3),
 lt as (select lang, sum(n)::hugeint as total, count(*)::hugeint as v from l group by all),
 g as (select distinct lang, source from d),
 c as (select g.lang, g.source, l.term, coalesce(s.n, 0)::hugeint as n, l.n as lang_n from g join l on l.lang = g.lang
   left join s on s.lang = g.lang and s.source = g.source and s.term = l.term),
 gt as (select lang, source, sum(n)::hugeint as total from c group by all),
 p as (select c.lang, c.source, c.term, c.n, 1 + 1000000000 * (c.n + 1) // (gt.total + lt.v) as p,
   1 + 1000000000 * (c.lang_n + 1) // (lt.total + lt.v) as q
  from c join gt on gt.lang = c.lang and gt.source = c.source join lt on lt.lang = c.lang),
 f as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
  from p a join p b on b.lang = a.lang and b.term = a.term and b.source <> a.source group by all),
 pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value
  from g a join g b on b.lang = a.lang and b.source <> a.source
  left join f on f.lang = a.lang and f.source = a.source and f.item = b.source),
 terms as (select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // q)::bigint as value
  from p where n > 0 and p > q),
 r as (select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
  from (select * from pairs union all select * from terms))
 select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 200"""
