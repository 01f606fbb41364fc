"""Readers, writers and streams."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairmill.functions.text import clean_text
from pairmill.operators import gate, lookup
from pairmill.sources import pairs, readers, staging, writers
from pairmill.streaming import live


def test_pair_csv(spark, tmp_path):
    path = str(tmp_path / "p.csv")
    (tmp_path / "p.csv").write_text(
        'flags,instruction,category,intent,response,extra\n'
        'Q,"say ""hi"", now",A,b,"two\nlines",z\nQ,,A,b,r,z\n', encoding="utf-8")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ("flags", "instruction", "category", "intent", "response", "extra")])
    df = readers.read_pairs(spark, path, schema)
    assert df.columns == ["query", "response", "category", "intent", "flags"]
    rows = df.orderBy("response").collect()
    assert rows[1].query == 'say "hi", now' and rows[1].response == "two\nlines"
    assert rows[0].query is None


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "p.csv").write_text("response,instruction\nreply text,query text\n", encoding="utf-8")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("instruction", "response", "intent")])
    row = readers.read_pairs(spark, str(tmp_path / "p.csv"), schema).first()
    assert (row.query, row.response, row.intent) == ("query text", "reply text", None)
    with pytest.raises(ValueError, match="instruction"):
        (tmp_path / "q.csv").write_text("response,other\nr,x\n", encoding="utf-8")
        readers.read_pairs(spark, str(tmp_path / "q.csv"), schema)
    (tmp_path / "s.csv").write_text("response_clean,query_clean\nc d,a\n", encoding="utf-8")
    row = readers.read_split_csv(spark, str(tmp_path / "s.csv")).first()
    assert (row.query_tokens, row.response_tokens, row.intent) == (["a"], ["c", "d"], "")


def test_query_files(spark, tmp_path):
    lines = tmp_path / "q.txt"
    lines.write_bytes(b"  first \r\n\n\xc2\xa0\nsec\xe2\x80\xa8ond\nbad \xff byte\n")
    got = [r.query for r in readers.read_queries(spark, str(lines)).collect()]
    assert got == ["first", "sec", "ond", "bad � byte"]
    table = tmp_path / "q.csv"
    table.write_text("id,channel,Message\n007,mail,hello\n8,chat,\n")
    assert [r.query for r in readers.read_queries(spark, str(table)).collect()] == ["hello", ""]
    empty = tmp_path / "e.csv"
    empty.write_text("query\n")
    assert readers.read_queries(spark, str(empty)).count() == 0


def test_columns_told_by_votes(spark, tmp_path):
    table = tmp_path / "v.csv"
    table.write_text("Text,flag,when,note,none,mixed\n1,true,2024-01-02,3 items,,1\n 2.5e3,FALSE,2024-01-03,4,,true\n,,,,,\n")
    df = spark.read.options(**readers.csv_options()).csv(str(table))
    assert readers.textual_columns(df) == ["when", "note", "none", "mixed"]
    inferred = spark.read.options(**readers.csv_options(), inferSchema=True).csv(str(table)).schema
    assert readers.query_column(inferred) == "when"
    got = readers.read_queries(spark, str(table))
    assert sorted(r.query for r in got.collect()) == ["", "2024-01-02", "2024-01-03"]
    assert readers.textual_columns(df.select("Text", "flag")) == []
    (tmp_path / "n.csv").write_text("a,Question\n1,2\n3,4\n")
    assert [r.query for r in readers.read_queries(spark, str(tmp_path / "n.csv")).collect()] == ["2", "4"]


def test_files_are_split_and_broken_rows_set_aside(spark, tmp_path):
    rows = [f'Q,"say ""{i}"", now",r{i}' for i in range(3000)]
    rows[1000:1000] = ["Q,only two", "Q,a,b,one too many"]
    path = tmp_path / "p.csv"
    path.write_text("\n".join(["flags,instruction,response", *rows]) + "\n", encoding="utf-8")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("instruction", "response", "flags", "intent")])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert readers.read_pairs(spark, str(path), schema, multi_line=False).rdd.getNumPartitions() > 3
        assert readers.read_pairs(spark, str(path), schema).rdd.getNumPartitions() == 1
        whole, broken = readers.read_pairs_checked(spark, str(path), schema)
        assert sorted(r.line for r in broken.collect()) == ["Q,a,b,one too many", "Q,only two"]
        got = {(r.query, r.response, r.flags) for r in whole.collect()}
        assert got == {(f'say "{i}", now', f"r{i}", "Q") for i in range(3000)} and whole.count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    path.write_text("flags,instruction,response\n")
    whole, broken = readers.read_pairs_checked(spark, str(path), schema)
    assert whole.count() == broken.count() == 0


@pytest.mark.parametrize("fields, column", [
    ([("ticket_id", "string"), ("query", "string")], "query"),
    ([("n", "int"), ("note", "string"), ("x", "string")], "note"),
    ([("text", "int"), ("other", "string")], "other"),
    ([("a", "int"), ("question", "int")], "question"),
    ([("a", "int"), ("b", "int")], "a"),
])
def test_query_column(fields, column):
    kinds = {"string": T.StringType(), "int": T.IntegerType()}
    schema = T.StructType([T.StructField(n, kinds[k]) for n, k in fields])
    assert readers.query_column(schema) == column


def test_split_csv_and_dictionary(spark, tmp_path):
    df = spark.createDataFrame([("a b", "c d .", None, "i")],
                               "query_clean string, response_clean string, category string, intent string")
    writers.write_csv(df, str(tmp_path / "s.csv"))
    row = readers.read_split_csv(spark, str(tmp_path / "s.csv")).first()
    assert row.query_tokens == ["a", "b"] and row.response_tokens == ["c", "d", "."]
    assert row.category == ""
    words = spark.createDataFrame([("é", 4, 2)], "token string, id int, n bigint")
    writers.write_dictionary(words, str(tmp_path / "v.json"))
    assert readers.read_dictionary(spark, str(tmp_path / "v.json"), words.schema).collect() == words.collect()


def test_transcripts_split_long_sessions(spark):
    """Each of these entries has 26 bytes; parts begin at multiples of 50."""
    df = spark.createDataFrame([(1, t, f"q{t}", f"r{t}") for t in (2, 0, 1)] + [(None, 5, "q", "é"), (3, 1, None, "r")],
                               "s bigint, t bigint, q string, r string")
    got = {(r.s, r.part): r.transcript
           for r in writers.transcripts(df, "s", "t", "q", "r", bytes_per_part=50).collect()}
    assert got == {(1, 0): "Customer: q0\nAssistant: r0\n\nCustomer: q1\nAssistant: r1",
                   (1, 1): "Customer: q2\nAssistant: r2", (None, 0): "Customer: q\nAssistant: é"}


def test_one_endless_session_spreads(spark):
    rows = [(7, t, "é" * (t % 5), "r") for t in range(500)] + [(8, 1, "x", "y")]
    df = spark.createDataFrame(rows, "s bigint, t bigint, q string, r string").repartition(5)
    got = {(r.s, r.part): r.transcript
           for r in writers.transcripts(df, "s", "t", "q", "r", bytes_per_part=200).collect()}
    want, before = {}, 0
    for _, t, q, r in rows[:-1]:
        entry = f"Customer: {q}\nAssistant: {r}"
        want.setdefault((7, before // 200), []).append(entry)
        before += len(entry.encode())
    assert got == {k: "\n\n".join(v) for k, v in want.items()} | {(8, 0): "Customer: x\nAssistant: y"}
    placed = lookup.sums_before(df, "s", [F.col("t").asc()], F.lit(1).cast("bigint"), "n")
    assert sorted((r.s, r.t, r.n) for r in placed.collect()) == [*((7, t, t) for t in range(500)), (8, 1, 0)]
    assert lookup.sums_before(df.where("false"), "s", [F.col("t").asc()], F.lit(1), "n").count() == 0


def test_rating_sheet(spark):
    df = spark.createDataFrame([("where is it ?", "i am here", "ok", None)],
                               "query_clean string, response_clean string, generated string, intent string")
    row = writers.rating_sheet(df).first()
    assert row[:4] == ("Where is it?", "I am here.", "Ok.", "") and set(row[4:]) == {""}


def test_pair_builders(spark):
    turns = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"),
                                   (1, 3, "user", "u2"), (1, 4, "user", "u3"), (1, 5, "assistant", "a3")],
                                  "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r.query, r.response) for r in pairs.dialogue_pairs(turns).collect())
    assert got == [("u1", "a1"), ("u3", "a3")]
    docs = spark.createDataFrame([(1, "a\nb\nc", "s", "en"), (2, "one", "s", "en")],
                                 "doc_id bigint, text string, source string, lang string")
    got = [(r.row_id, r.query, r.response) for r in pairs.line_pairs(docs).orderBy("row_id").collect()]
    assert got == [(10_000_000, "a", "b"), (10_000_001, "b", "c")]


@pytest.fixture
def stream(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", 1, "cancel my order"), ("2024-01-01 00:50:00", 2, "penguin joke"),
            ("2024-01-01 02:30:00", 3, "???")]
    df = spark.createDataFrame(rows, "ts string, row_id bigint, query string").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    return spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))


def drain(stream, name):
    q = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name).collect()


def test_live_gate_and_rate(spark, stream):
    small = gate.SmallLexicon(("cancel", "order"), ("order",))
    gated = live.live_gate(stream, small)
    assert {r.row_id: r.in_scope for r in drain(gated, "gated")} == {1: True, 2: False, 3: False}
    rate = [(r.n, r.refused, r.refusal_rate) for r in drain(live.refusal_rate(gated), "rate")]
    assert rate == [(2, 1, 0.5)]           # the last window is still open


def test_live_gate_batches(spark, stream, tmp_path):
    lexicon = spark.createDataFrame([("cancel", 2, True, None), ("order", 2, True, 1)],
                                    "token string, n bigint, known boolean, anchor_rank int")
    seen = {}

    def write(batch, batch_id):
        seen.update({r.row_id: r.in_scope for r in batch.collect()})
    stream.writeStream.foreachBatch(live.live_gate_batches(lexicon, write)).trigger(
        availableNow=True).start().awaitTermination()
    assert seen == {1: True, 2: False, 3: False}


def test_cleaning_keeps_typed_tokens(spark):
    df = spark.createDataFrame([("ask <ph_order_number> at <url> or <email> .",)], "c string")
    once = df.select(clean_text(F.col("c")).alias("c"))
    assert once.first().c == once.select(clean_text(F.col("c"))).first()[0] == df.first().c


@pytest.mark.parametrize("conf, checkpoint_dir, master, want", [
    ("file:///shared/x/", "file:///other", "spark://m:7077", "file:///shared/x"),
    (None, "file:///other/", "spark://m:7077", "file:///other"),
    (None, None, "spark://m:7077", ValueError),
    (None, None, "local-cluster[2,1,1024]", ValueError),
    (None, None, "local[4]", "own")])
def test_shared_folder(conf, checkpoint_dir, master, want):
    """The setting counts first, then the context's folder; only one machine falls back to its own."""
    context = SimpleNamespace(master=master, applicationId=f"app-{master}",
                              getCheckpointDir=lambda: checkpoint_dir)
    session = SimpleNamespace(sparkContext=context,
                              conf=SimpleNamespace(get=lambda key, default: conf or default))
    if want is ValueError:
        with pytest.raises(ValueError):
            staging.shared_dir(session)
    elif want == "own":
        own = staging.shared_dir(session)
        assert own == staging.shared_dir(session) and "pairmill-" in own
    else:
        assert staging.shared_dir(session) == want


def test_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    assert staging.spread(spark.range(9).coalesce(1)).rdd.getNumPartitions() == cores
    wide = spark.range(9).repartition(cores + 3)
    assert staging.spread(wide) is wide


def test_dialogue_pairs_by_order(spark):
    """The next turn is the next in order: gaps and repeated numbers neither lose nor multiply pairs."""
    rows = [(1, 1, "user", "u1"), (1, 3, "assistant", "a1"), (1, 3, "assistant", "a1 again"), (1, 9, "user", "u2"),
            (2, 10, "assistant", "not asked here"), (2, 12, "user", "u3"), (2, 40, "system", "s"),
            (2, 41, "assistant", "a3"), (3, 5, "user", "u4"), (3, 700, "assistant", "a4")]
    rows += [(9, 3 * i, "user" if i % 2 == 0 else "assistant", f"t{i:03}") for i in range(400)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(7)
    got = sorted((r.conv_id, r.turn, r.query, r.response) for r in pairs.dialogue_pairs(turns).collect())
    assert got == [(1, 1, "u1", "a1"), (3, 5, "u4", "a4")] + [
        (9, 3 * i, f"t{i:03}", f"t{i + 1:03}") for i in range(0, 400, 2)]
