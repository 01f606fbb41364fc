"""Sinks and export shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions.render import render
from pairmill.functions.text import words
from pairmill.operators.lookup import sums_before


def write_splits(prepared: DataFrame, path: str) -> None:
    prepared.write.mode("overwrite").partitionBy("split").parquet(path)


def write_csv(df: DataFrame, path: str, rows_per_file: int = 20_000) -> None:
    """Files of so many rows at most: one with line breaks in its values is read whole by one task."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("maxRecordsPerFile", rows_per_file).option("quoteAll", True).csv(path))


def write_dictionary(df: DataFrame, path: str) -> None:
    """Vocabulary, slot map, lexicon, stats or metrics as JSON lines."""
    df.write.mode("overwrite").json(path)


def answers_export(answers: DataFrame) -> DataFrame:
    return answers.select(
        "query", F.col("response").alias("generated_response"), "in_scope",
        F.col("oov_ratio").alias("unknown_word_ratio"),
        F.col("avg_logprob").alias("mean_logprob"))


def transcripts(turns: DataFrame, session: str, turn: str, query: str, response: str,
                bytes_per_part: int = 1 << 20) -> DataFrame:
    """Session transcripts, one row per part; a session's parts in order are the whole.

    A part has the entries that begin within the same ``bytes_per_part`` bytes of the session, so it is
    bounded by that and one entry, and one endless session spreads over many tasks. A number that no
    entry begins in is left out. Entries of one turn go by their text; one with a null side is left out.
    """
    entry = F.concat(F.lit("Customer: "), F.col(query), F.lit("\nAssistant: "),
                     F.col(response))
    rows = turns.select(session, F.col(turn).alias("turn"), entry.alias("text")).where("text is not null")
    order = [F.col("turn").asc(), F.col("text").asc()]
    placed = sums_before(rows, session, order, F.octet_length("text").cast("bigint"), "_before")
    part = F.expr(f"_before div {bytes_per_part}")
    return (placed.groupBy(F.col(session), part.alias("part"))
            .agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
            .select(session, "part", F.array_join(F.col("t.text"), "\n\n").alias("transcript")))


def rating_sheet(sample: DataFrame, inverse_map: dict[str, str] | None = None) -> DataFrame:
    """Rendered rows with empty columns for a human rater."""
    def shown(column: str):
        return render(words(F.col(column)), inverse_map)
    blank = F.lit("")
    return sample.select(
        shown("query_clean").alias("query"), shown("response_clean").alias("reference_reply"),
        shown("generated").alias("generated_reply"),
        F.coalesce(F.col("intent"), blank).alias("intent"),
        blank.alias("relevance_1_to_5"), blank.alias("fluency_1_to_5"),
        blank.alias("would_send_as_is_yes_no"), blank.alias("rater_comment"))
