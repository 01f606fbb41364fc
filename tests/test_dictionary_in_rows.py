"""Encoding and decoding by a small vocabulary stay in the row; CSV files are bounded."""

from dataclasses import replace

from pyspark.sql import functions as F

from pairmill.operators import vocab
from pairmill.settings import Settings
from pairmill.sources import readers, writers

WORDS = [(f"w{i}", i + 4, 99 - i) for i in range(30)]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_in_rows_equals_join(spark):
    words = spark.createDataFrame(WORDS, "token string, id int, n bigint")
    rows = [(i, [f"w{(i * j) % 33}" for j in range(i % 9)], [f"w{j}" for j in range(i % 40)]) for i in range(120)]
    rows += [(500, None, ["w1"]), (501, [None, "w2"], []), (None, ["w1"], ["w2"])]
    df = spark.createDataFrame(rows, "row_id bigint, q array<string>, r array<string>")
    columns = {"q": ("src", 6), "r": ("tgt", 20)}
    by_join = replace(Settings(), broadcast_rows=1)
    a, b = (vocab.encode_columns(df, columns, words, settings=s) for s in (Settings(), by_join))
    assert "Join" not in plan_of(a) and "Aggregate" not in plan_of(a) and "Join" in plan_of(b)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert a.exceptAll(b).count() == 0 and a.count() == len(rows)

    ids = spark.createDataFrame([(1, [1, 4, 5, 2, 6]), (2, [3, 4, 99]), (3, []), (4, None), (None, [4])],
                                "row_id bigint, ids array<int>")
    c, d = (vocab.decode(ids, "ids", words, settings=s) for s in (Settings(), by_join))
    assert "Join" not in plan_of(c) and "Aggregate" not in plan_of(c)
    assert c.schema.simpleString() == d.schema.simpleString()
    assert c.exceptAll(d).count() == 0 and c.count() == 5
    assert c.where("row_id = 2").first().tokens == ["<unk>", "w0"]


def test_repeated_keys_keep_their_rows_apart(spark):
    words = spark.createDataFrame(WORDS, "token string, id int, n bigint")
    df = spark.createDataFrame([(1, ["w0"]), (1, ["w1"])], "row_id bigint, t array<string>")
    ids = vocab.encode(df, "t", words, 4)
    assert sorted(r.ids for r in ids.collect()) == [[1, 4, 2, 0], [1, 5, 2, 0]]


def test_csv_files_are_bounded(spark, tmp_path):
    rows = spark.range(45_000).coalesce(1).select(F.concat(F.lit("a\n"), "id").alias("instruction"),
                                                  F.lit("b").alias("response"))
    path = str(tmp_path / "pairs.csv")
    writers.write_csv(rows, path)
    assert len(list((tmp_path / "pairs.csv").glob("part-*.csv"))) == 3
    back = readers.read_pairs(spark, path, rows.schema)
    assert back.count() == 45_000 and back.select("query").distinct().count() == 45_000
