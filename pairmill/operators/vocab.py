"""Vocabulary: counts, ids, coverage, encoding and decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairmill.functions.arrays import frame_ids, until_eos
from pairmill.functions.basics import empty_strings
from pairmill.operators.lookup import in_rows, lookup, ranked
from pairmill.settings import SPECIAL_TOKENS, UNK, Settings


def token_counts(df: DataFrame, token_cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Running-text counts; all columns in one scan, partial sums before the shuffle."""
    by = by or []
    return (df.select(*by, F.explode(F.concat(*token_cols)).alias("token"))
            .where(~F.col("token").isin(*SPECIAL_TOKENS))
            .groupBy(*by, "token").agg(F.count("*").alias("n")))


def sided_counts(df: DataFrame) -> DataFrame:
    """(split, side, token, n): the one table vocabulary, lexicon and coverage need."""
    def tagged(column: str, side: str):
        return F.transform(column, lambda t: F.struct(F.lit(side).alias("side"),
                                                      t.alias("token")))
    both = F.concat(tagged("query_tokens", "query"), tagged("response_tokens", "response"))
    return (df.select("split", F.inline(both)).where(~F.col("token").isin(*SPECIAL_TOKENS))
            .groupBy("split", "side", "token").agg(F.count("*").alias("n")))


def vocab_from_counts(counts: DataFrame, min_freq: int = Settings.min_freq,
                      max_size: int | None = None) -> DataFrame:
    """(token, id, n), ids from 4 in the order (n desc, token asc)."""
    kept = counts.where(F.col("n") >= min_freq)
    order = [F.desc("n"), F.asc("token")]
    first = len(SPECIAL_TOKENS)
    if max_size is None:
        numbered = ranked(kept, order, "id", first)
        return numbered.select("token", F.col("id").cast("int").alias("id"), "n")
    # The limit bounds the rows of the single window task.
    top = kept.orderBy(*order).limit(max_size - first)
    rank = F.row_number().over(Window.orderBy(*order)) + (first - 1)
    return top.select("token", rank.cast("int").alias("id"), "n")


def build_vocab(df: DataFrame, token_cols: list[str], min_freq: int = Settings.min_freq,
                max_size: int | None = None) -> DataFrame:
    return vocab_from_counts(token_counts(df, token_cols), min_freq, max_size)


def with_specials(vocab: DataFrame) -> DataFrame:
    rows = [(t, i, 0) for i, t in enumerate(SPECIAL_TOKENS)]
    return vocab.sparkSession.createDataFrame(rows, vocab.schema).unionByName(vocab)


def coverage(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """Share of running tokens the vocabulary covers; 0 for an empty corpus."""
    known = counts.join(vocab.select("token", "id"), "token", "left")
    covered = F.sum(F.when(F.col("id").isNotNull(), F.col("n")))
    return known.agg((F.coalesce(covered, F.lit(0)) / F.sum("n")).alias("c")).select(
        F.coalesce("c", F.lit(0.0)).alias("coverage"))


def oov_ratio(df: DataFrame, tokens_col: str, vocab: DataFrame, key: str = "row_id",
              settings: Settings = Settings()) -> DataFrame:
    """Unknown tokens / tokens per row; 1.0 for rows without tokens."""
    tokens = df.select(key, F.explode_outer(tokens_col).alias("token"))
    found = lookup(tokens, vocab.select("token", "id"), "token", settings)
    unknown = F.count_if(F.col("token").isNotNull() & F.col("id").isNull())
    return found.groupBy(key).agg(
        F.coalesce(F.try_divide(unknown, F.count("token")), F.lit(1.0)).alias("oov_ratio"))


def encode_columns(df: DataFrame, columns: dict[str, tuple[str, int]], vocab: DataFrame,
                   key: str = "row_id", add_sos: bool = True, add_eos: bool = True,
                   settings: Settings = Settings()) -> DataFrame:
    """Encode several token columns in one pass: ``{tokens: (output, max_len)}``.

    Tokens beyond the budget never leave the row, and none does where the vocabulary is small enough to broadcast.
    """
    marks = int(add_sos) + int(add_eos)
    none = F.array().cast("array<int>")
    call = in_rows(vocab, "token", "id", "int", settings)
    if call is not None:
        whole = F.col(key).isNotNull()
        for c in columns:
            whole = whole & F.col(c).isNotNull()
        kept = {f"_{out}": call(F.when(whole, F.slice(c, 1, max_len - marks))) for c, (out, max_len) in columns.items()}
        framed = [frame_ids(F.transform(F.coalesce(f"_{out}", none), lambda i: F.coalesce(i, F.lit(UNK))), max_len,
                            add_sos, add_eos).alias(out) for out, max_len in columns.values()]
        return df.withColumns(kept).select(*df.columns, *framed)
    tagged = F.concat(*[
        F.transform(F.slice(c, 1, max_len - marks), lambda t, i: F.struct(
            F.lit(out).alias("col"), i.alias("pos"), t.alias("token")))
        for c, (out, max_len) in columns.items()])
    found = lookup(df.select(key, F.inline(tagged)), vocab.select("token", "id"),
                   "token", settings)
    unk = F.coalesce("id", F.lit(UNK))
    ids = found.groupBy(key).agg(*[
        F.array_sort(F.collect_list(F.when(F.col("col") == out, F.struct(
            "pos", unk.alias("id"))))).alias(out) for out, _ in columns.values()])
    framed = [frame_ids(F.coalesce(F.col(f"_e.{out}.id"), none), max_len,
                        add_sos, add_eos).alias(out) for out, max_len in columns.values()]
    ids = ids.select(key, F.struct(*[out for out, _ in columns.values()]).alias("_e"))
    return df.join(ids, key, "left").select(*df.columns, *framed)


def encode(df: DataFrame, tokens_col: str, vocab: DataFrame, max_len: int,
           add_sos: bool = True, add_eos: bool = True, key: str = "row_id",
           out: str = "ids", settings: Settings = Settings()) -> DataFrame:
    return encode_columns(df, {tokens_col: (out, max_len)}, vocab, key,
                          add_sos, add_eos, settings)


def decode(df: DataFrame, ids_col: str, vocab: DataFrame, key: str = "row_id",
           strip_special: bool = True, out: str = "tokens",
           settings: Settings = Settings()) -> DataFrame:
    """Ids -> tokens; ids the vocabulary lacks are counted in ``unknown_ids``."""
    ids = until_eos(F.col(ids_col)) if strip_special else F.col(ids_col)
    call = in_rows(with_specials(vocab), "id", "token", "string", settings)
    if call is not None:
        known = F.array_compact("_d")
        return (df.withColumn("_d", F.coalesce(call(F.when(F.col(key).isNotNull(), ids)), empty_strings()))
                .select(*df.columns, known.alias(out), (F.size("_d") - F.size(known)).cast("bigint").alias("unknown_ids")))
    exploded = df.select(key, F.posexplode(ids).alias("pos", "id"))
    found = lookup(exploded, with_specials(vocab).select("id", "token"), "id", settings)
    known = F.when(F.col("token").isNotNull(), F.struct("pos", "token"))
    per_row = found.groupBy(key).agg(
        F.array_sort(F.collect_list(known)).alias("_d"),
        F.count_if(F.col("token").isNull()).alias("unknown_ids"))
    return (df.join(per_row, key, "left")
            .select(*df.columns, F.coalesce(F.col("_d.token"), empty_strings()).alias(out),
                    F.coalesce("unknown_ids", F.lit(0)).alias("unknown_ids")))


def training_batches(df: DataFrame, src: str = "src", tgt: str = "tgt", key: str = "row_id",
                     batch_size: int = Settings.batch_size) -> DataFrame:
    """Length-sorted batches, each trimmed to its longest member, with the
    decoder input and labels of teacher forcing."""
    def used(column: str):
        return F.size(F.filter(column, lambda i: i != 0))
    sized = df.select(key, src, tgt, used(src).alias("src_len"), used(tgt).alias("tgt_len"))
    order = [F.asc("src_len"), F.asc("tgt_len"), F.asc(key)]
    batched = ranked(sized, order, "_rank", 0).withColumn(
        "batch_id", F.floor(F.col("_rank") / batch_size).cast("bigint"))
    # A batch holds at most ``batch_size`` rows, so this window cannot be skewed.
    w = Window.partitionBy("batch_id")
    batched = (batched.withColumn("_s", F.max("src_len").over(w))
               .withColumn("_t", F.max("tgt_len").over(w)))
    return batched.select(
        "batch_id", key, F.slice(src, F.lit(1), F.col("_s")).alias(src),
        F.slice(tgt, F.lit(1), F.col("_t") - 1).alias("tgt_in"),
        F.slice(tgt, F.lit(2), F.col("_t") - 1).alias("tgt_out"))
