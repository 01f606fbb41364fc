"""Every path of the dictionary join and of the global rank gives the same rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pairmill.operators.lookup import fits, lookup, ranked, staged_with_hot_keys
from pairmill.operators.vocab import build_vocab, decode, encode, oov_ratio
from pairmill.settings import Settings
from pairmill.sources.staging import stage

SMALL = Settings()
HOT = replace(SMALL, broadcast_rows=1, hot_keys=2, hot_min_rows=10)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one known key, a third one unknown key."""
    return spark.range(3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "missing")
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("token"))


@pytest.fixture(scope="module")
def dictionary(spark):
    rows = [("hot", 1)] + [(f"k{i}", i + 2) for i in range(0, 50, 2)]
    return spark.createDataFrame(rows, "token string, id int")


@pytest.mark.parametrize("settings", [SMALL, HOT, replace(HOT, hot_min_rows=10**9)])
@pytest.mark.parametrize("spread", [False, True])
def test_lookup_paths_agree(skewed, dictionary, settings, spread):
    got = lookup(skewed, dictionary, "token", settings, spread)
    want = skewed.join(dictionary, "token", "left")
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == 3000


def test_hot_keys_are_spread_and_the_input_runs_once(spark, skewed, dictionary):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = skewed.mapInArrow(counted, skewed.schema)
    out = lookup(rows, dictionary, "token", HOT)
    assert out.count() == 3000 and out.where("token = 'hot' and id = 1").count() == 1000
    assert seen.value == 3000  # one evaluation for several results
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan.replace("Generate explode(sequence(0", "") and "_turn" in plan


@pytest.mark.parametrize("column", ["bigint", "string"])
def test_sketch_finds_frequent_keys(spark, column):
    df = spark.range(20_000).select(F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 4 == 1, None)
                                    .otherwise(F.col("id")).cast(column).alias("k"), F.lit(1).alias("_copies2"))
    rows, hot = staged_with_hot_keys(df, "k", replace(HOT, hot_min_rows=1000, hot_keys=5))
    assert rows.count() == 20_000
    copies = {r._hash: r._copies for r in hot.collect()}
    seven = spark.range(1).select(F.xxhash64(F.lit(7).cast(column))).first()[0]
    assert copies[seven] == 6 and len(copies) == 2  # the other is null
    assert staged_with_hot_keys(df.where("false"), "k", HOT)[1].count() == 0


def test_payload_counts_for_the_broadcast(spark):
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(5)], "id int, token string")
    assert not fits(wide, 100, 4000) and fits(wide, 100, 6000) and not fits(wide, 4, 6000)


@pytest.mark.parametrize("length", [1_000, 20_000])
def test_wide_hot_entries_give_the_same_rows(spark, length):
    rows = spark.range(60).select("id", F.lit("k").alias("token"))
    wide = spark.createDataFrame([("k", "x" * length), ("other", "y")], "token string, payload string")
    got = lookup(rows, wide, "token", HOT)
    assert got.where(F.length("payload") == length).count() == got.count() == 60


def test_ranked_is_global(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(7)
    out = ranked(df, [F.desc("v")], "r", 1)
    assert out.where(F.col("r") != 5000 - F.col("v")).count() == 0
    assert out.count() == 5000


@pytest.mark.parametrize("settings", [SMALL, replace(HOT, hot_min_rows=1)])
def test_encode_decode_round_trip(spark, settings):
    rows = [(1, "b a a".split()), (2, "a b c c zzz".split()), (3, [])]
    df = spark.createDataFrame(rows, "row_id bigint, toks array<string>")
    vocab = stage(build_vocab(df, ["toks"]), "v")
    assert [(r.token, r.id, r.n) for r in vocab.orderBy("id").collect()] == [
        ("a", 4, 3), ("b", 5, 2), ("c", 6, 2)]
    enc = encode(df, "toks", vocab, 5, settings=settings)
    assert {r.row_id: r.ids for r in enc.collect()} == {
        1: [1, 5, 4, 4, 2], 2: [1, 4, 5, 6, 2], 3: [1, 2, 0, 0, 0]}
    dec = decode(enc, "ids", vocab, settings=settings)
    assert {r.row_id: (r.tokens, r.unknown_ids) for r in dec.collect()} == {
        1: ("b a a".split(), 0), 2: ("a b c".split(), 0), 3: ([], 0)}
    oov = oov_ratio(df, "toks", vocab, settings=settings)
    assert {r.row_id: r.oov_ratio for r in oov.collect()} == {1: 0.0, 2: 0.2, 3: 1.0}


def test_decode_counts_unknown_ids_and_keeps_specials(spark):
    vocab = spark.createDataFrame([("x", 4, 9)], "token string, id int, n bigint")
    df = spark.createDataFrame([(1, [1, 4, 77, 3, 2, 4])], "row_id bigint, ids array<int>")
    row = decode(df, "ids", vocab).first()
    assert (row.tokens, row.unknown_ids) == (["x", "<unk>"], 1)
    row = decode(df, "ids", vocab, strip_special=False).first()
    assert row.tokens == ["<sos>", "x", "<unk>", "<eos>", "x"]


def test_vocabulary_of_fixed_size_and_specials(spark):
    df = spark.createDataFrame([(["a", "a", "b", "b", "b", "<unk>", "<pad>", "c"],)], "t array<string>")
    vocab = build_vocab(df, ["t"], min_freq=1, max_size=6)
    assert [(r.token, r.id) for r in vocab.orderBy("id").collect()] == [("b", 4), ("a", 5)]
