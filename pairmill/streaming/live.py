"""Live queries: preparation, lexicon gate and refusal rate over time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.functions import text
from pairmill.functions.basics import compute_once
from pairmill.operators.gate import SmallLexicon, scope_signals, small_lexicon
from pairmill.settings import Settings


def live_gate(stream: DataFrame, lexicon: SmallLexicon,
              slot_map: dict[str, str] | None = None,
              settings: Settings = Settings()) -> DataFrame:
    """Stateless: tokens, signals and the lexicon half of the verdict per query.

    The lexicon is a constant set in the plan; larger ones go through
    ``live_gate_batches``.
    """
    asked = compute_once(stream, query_tokens=text.prepare_query(F.col("query"), slot_map))
    signals = scope_signals(asked, lexicon, settings=settings)
    return signals.withColumn(
        "in_scope", (F.size("query_tokens") > 0) & (F.col("oov") <= settings.max_oov))


def live_gate_batches(lexicon: DataFrame, write: Callable[[DataFrame, int], None],
                      key: str | Sequence[str] = "row_id", slot_map: dict[str, str] | None = None,
                      settings: Settings = Settings()):
    """``foreachBatch`` function for lexicons of any size; the way is chosen once, not per batch."""
    small = small_lexicon(lexicon)

    def handle(batch: DataFrame, batch_id: int) -> None:
        asked = compute_once(batch, query_tokens=text.prepare_query(F.col("query"), slot_map))
        signals = scope_signals(asked, small or lexicon, key=key, settings=settings,
                                always_join=small is None)
        write(signals.withColumn("in_scope", (F.size("query_tokens") > 0)
                                 & (F.col("oov") <= settings.max_oov)), batch_id)
    return handle


def refusal_rate(gated: DataFrame, ts: str = "ts", every: str = "1 hour",
                 lateness: str = "10 minutes") -> DataFrame:
    """Out-of-scope share per tumbling window; rows behind the watermark drop."""
    return (gated.withWatermark(ts, lateness).groupBy(F.window(ts, every).alias("w"))
            .agg(F.count("*").alias("n"), F.count_if(~F.col("in_scope")).alias("refused"))
            .select(F.col("w.start").alias("start"), "n", "refused",
                    (F.col("refused") / F.col("n")).alias("refusal_rate")))
