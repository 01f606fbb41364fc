"""Structured Streaming forms, run over the given tables until they are drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from pairmill.catalog import sqltext as q
from pairmill.catalog.dictionaries import LEXICON, train_lines
from pairmill.catalog.inputs import joined, table
from pairmill.catalog.registry import query
from pairmill.operators import gate
from pairmill.sources.staging import stage, stage_path
from pairmill.streaming import live


def stream_of(spark, sf, name):
    """A table as a stream, be it one file or a folder of part files: the pattern matches its name alone,
    since the file source takes a plain path for a folder."""
    schema = table(spark, sf, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf}/{name}.parque[t]")


def drained(stream, name):
    """Write a stream to a staged table until its input is used up."""
    spark = stream.sparkSession
    path = stage_path(spark, name)
    (stream.writeStream.format("parquet").outputMode("append")
     .option("path", path).option("checkpointLocation", path + "-progress")
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(path)


_LIVE_SQL = LEXICON + f""",
aq as (select conv_id, turn, {q.query_tokens(q.clean('text', True))} as qt from conversations where role = 'user'),
ac as (select *, {q.content('qt')} as cw from aq),
kn as (select list(token) filter (where known) as known from lx),
lv as (select conv_id, turn, qt, cw, list_filter(cw, lambda w: not list_contains(known, w)) as unknown from ac, kn)
select conv_id, turn, array_to_string(unknown, ' ') as unknown, len(qt) > 0 and
 case when len(cw) > 0 then len(unknown) / len(cw)
  when len(list_filter(qt, lambda w: starts_with(w, '<ph_'))) > 0 then 0.0 else 1.0 end <= 0.5 as in_scope from lv"""


@query(_LIVE_SQL)
def live_gate(spark, sf):
    """Live queries against a constant lexicon: stateless."""
    lexicon = stage(gate.scope_lexicon(train_lines(spark, sf)), "lexicon")
    small = gate.small_lexicon(lexicon, entries=20_000)
    asked = (stream_of(spark, sf, "conversations").where("role = 'user'")
             .withColumnRenamed("text", "query"))
    if small is not None:
        out = drained(live.live_gate(asked, small), "live")
    else:
        path = stage_path(spark, "live")

        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        (asked.writeStream.foreachBatch(live.live_gate_batches(lexicon, write, ["conv_id", "turn"]))
         .option("checkpointLocation", path + "-progress")
         .trigger(availableNow=True).start().awaitTermination())
        out = spark.read.parquet(path)
    return out.select("conv_id", "turn", joined("unknown").alias("unknown"), "in_scope")


@query("""with b as (select time_bucket(interval '1 hour', ts) as start, event_type from events),
m as (select max(ts) - interval '10 minutes' as mark from events)
select strftime(start, '%Y-%m-%d %H:%M:%S') as start, count(*) as n, count(*) filter (where event_type = 'error') as refused,
 round(count(*) filter (where event_type = 'error') / count(*), 6) as refusal_rate
from b, m where b.start + interval '1 hour' <= mark group by 1""")
def live_refusal_rate(spark, sf):
    """Hourly refusal share; errors stand for refused queries. The last, still
    open windows stay in the state and are not written."""
    gated = stream_of(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") != "error").alias("in_scope"))
    out = drained(live.refusal_rate(gated), "refusals")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", "refused", F.round("refusal_rate", 6).alias("refusal_rate"))
