"""From raw documents to packed training sequences.

Each stage's result is written to the cluster's shared folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pairmill.llm import language, lines, packing, repeats, simhash
from pairmill.llm.queries import language_training
from pairmill.sources.staging import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts of which no language has half the letters; null and empty texts and others without
    a letter go too. Equal texts fare alike, whatever their ids."""
    return language.of_one_language(docs, language_training(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that equal an earlier one but for two edits, and documents left without any word by
    that. Null and empty texts stay. Earlier is what has the smaller id, a null id first, and of rows
    with one id what comes first in the table; of equal lines the earliest stays."""
    return lines.without_repeated_lines(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each SimHash component the document with the smallest id, a null id first; of several
    rows with that id the first. Null and empty texts, and others without words, are one component."""
    return simhash.without_near_duplicates(docs)


def dedup_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes bytes of 100-byte strings that start earlier, and documents left without a word by that.
    Null and empty texts stay; earlier is as in ``dedup_lines``."""
    return repeats.without_passages(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 ids; a null text gives its end id alone. Rows that
    repeat an id or a text are packed each for itself."""
    return packing.packed(docs)


STAGES = [("language", identify_language), ("lines", dedup_lines), ("near", dedup_near),
          ("passages", dedup_passages), ("packing", pack_sequences)]
#: Fingerprints, edit joins and tokenisation have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
