"""Input tables of the catalogue, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairmill.plans.prepare import clean_pairs, kept_clean_pairs, tokenised_pairs
from pairmill.sources.pairs import dialogue_pairs, line_pairs
from pairmill.sources.staging import spread, stage


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def texts(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table whose text is about to be worked on."""
    return spread(table(spark, sf, name))


# Order rows told as support messages. The expressions are valid in Spark SQL and
# in DuckDB, so both sides start from the same rows.
_QUERY = """case
 when o_orderpriority = '1-URGENT' then concat('Heyyy @Agent', o_custkey,
   '!!! pls cancel order ', o_orderkey, '... im waiting, thx')
 when o_orderpriority = '2-HIGH' then concat('<p>Where is the parcel of customer ', o_custkey,
   '?</p> See https://shop.example.com/o?id=', o_custkey, ', ASAP')
 when o_orderpriority = '3-MEDIUM' then concat('My invoice #', o_orderkey,
   ' went to c', o_custkey, '@mail.example.com. #refund it, u cant keep it')
 when o_orderpriority = '4-NOT SPECIFIED' then concat('Refund for {{ Account Type }} ',
   o_custkey, ' ☹☹ — it’s late??')
 when o_orderstatus = 'P' then null
 when o_orderstatus = 'O' then concat('This is an automated message about order ', o_orderkey)
 else 'Hello' end"""
_REPLY = """concat('Dear {{Person Name}}, the ', lower(o_orderpriority), ' case of {{Customer ',
 o_custkey, '}} is {{ Status ', o_orderstatus, ' }}. Mail {{Customer Support Email}} or visit',
 ' www.example.com/', o_orderstatus, ' today! We will call you (soon) about it.')"""
SUPPORT_COLUMNS = [("o_orderkey", "row_id"), (_QUERY, "query"), (_REPLY, "response"),
                   ("o_orderpriority", "category"), ("o_orderstatus", "intent"),
                   ("substr(o_orderpriority, 1, 1)", "flags")]
SUPPORT_SQL = "select {} from orders".format(
    ", ".join(f"{e} as {n}" for e, n in SUPPORT_COLUMNS))


def support_rows(spark: SparkSession, sf: str) -> DataFrame:
    return texts(spark, sf, "orders").selectExpr(*[f"{e} as {n}" for e, n in SUPPORT_COLUMNS])


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return line_pairs(texts(spark, sf, "documents"))


def dialogues(spark: SparkSession, sf: str) -> DataFrame:
    return dialogue_pairs(table(spark, sf, "conversations"))


def cleaned_lines(spark: SparkSession, sf: str) -> DataFrame:
    return clean_pairs(lines(spark, sf))


def prepared_lines(spark: SparkSession, sf: str) -> DataFrame:
    return tokenised_pairs(kept_clean_pairs(lines(spark, sf)))


def staged_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Prepared lines, written once with the columns that encoding and scoring read."""
    return stage(prepared_lines(spark, sf).select("row_id", "query_tokens", "response_tokens", "split"), "prepared")


def joined(column: str):
    return F.array_join(F.transform(column, lambda x: x.cast("string")), " ")
