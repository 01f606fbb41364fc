"""Filters, splits, statistics and the whole preparation."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pairmill.operators import filters, slots, split, stats, vocab
from pairmill.plans import prepare as plan
from pairmill.settings import Settings

PAIRS = "row_id bigint, query string, response string, category string, intent string, flags string"


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(i, f"where is order {12345 + i % 7} please", f"we will check reply {i % 6} now.", "ORDER",
             "track", "Q") for i in range(84)]
    rows += [(100, None, "x", "A", "b", None), (101, "q", None, "A", "b", None),
             (102, "out of office today", "we are away now", "A", "b", None),
             (103, "hello", "too short a query here", "A", "b", None),
             (104, "three words here", "ok", "A", "b", None)]
    rows += [(200 + i, "what about my {{Order Number}} thing", "use {{Rare Name}} or {{Order Number}} today",
              "ORDER", "other", "L") for i in range(15)]
    return spark.createDataFrame(rows, PAIRS)


def test_pipeline_accounts_for_every_row(raw):
    out = plan.prepare(raw)
    row = out.stats.first()
    dropped = sum(row[c] for c in row.asDict() if c.startswith("dropped_"))
    assert dropped + row.pairs_after_cleaning == row.raw_pairs == raw.count()
    assert (row.dropped_null, row.dropped_automated, row.dropped_too_short) == (2, 1, 2)
    # every long number becomes one slot: one query with six replies, capped at four
    assert row.dropped_over_represented == 2 and row.pairs_after_cleaning == 5
    assert row.placeholder_types == 2
    assert row.train_size + row.valid_size + row.test_size == 5
    pairs = out.pairs
    assert pairs.count() == 5
    assert pairs.groupBy("query_clean").count().agg(F.max("count")).first()[0] <= 4
    assert pairs.groupBy("query_clean").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    assert [r.row_id for r in pairs.orderBy("row_id").collect()] == [0, 1, 2, 3, 200]


def test_raw_pairs_are_read_once(spark):
    rows = [(i, f"where is my order number {i} please", "we will look into it today .", "c", "i") for i in range(40)]
    rows += [(50, None, "r", None, None), (51, "q", None, None, None), (52, None, None, None, None),
             (53, "This is an automated message", "reply", None, None), (54, None, "This is an automated message", None, None)]
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    table = spark.createDataFrame(rows, "row_id bigint, query string, response string, category string, intent string")
    out = plan.prepare(table.mapInArrow(seen, table.schema))
    row = out.stats.first()
    assert (row.raw_pairs, row.dropped_null, row.dropped_automated) == (45, 4, 1)
    assert out.pairs.count() == 40 and read.value == 45
    usable, counts = stats.staged_usable(table.where("false"))
    assert usable.count() == 0 and tuple(counts.first()) == (0, 0, 0)
    usable, counts = stats.staged_usable(spark.createDataFrame([], table.schema))
    assert usable.columns == table.columns and tuple(counts.first()) == (0, 0, 0)


def test_first_copy_and_cap_follow_row_id(spark):
    rows = [(5, "a", "x"), (1, "a", "x"), (3, "a", "y"), (2, "b", "x")]
    df = spark.createDataFrame(rows, "row_id bigint, query_clean string, response_clean string")
    kept = filters.drop_repeated_pairs(df)
    assert sorted(r.row_id for r in kept.collect()) == [1, 2, 3]
    assert sorted(r.row_id for r in filters.cap_replies(kept, n=1).collect()) == [1, 2]


def test_group_limits_sit_below_the_shuffles(spark):
    df = spark.createDataFrame([(1, "a", "x")], "row_id bigint, query_clean string, response_clean string")
    text = plan.kept_pairs(df)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Partial") == 2 and "WindowGroupLimit" in text


def test_plan_runs_the_cleaning_once_and_without_python(spark, raw):
    out = plan.tokenised_pairs(plan.kept_pairs(plan.clean_pairs(raw)))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Generate inline(array(struct(query_clean") == 1
    assert "Python" not in text and "CartesianProduct" not in text and "SinglePartition" not in text


def test_large_slot_maps_take_the_join(raw):
    usable = plan.usable_pairs(raw)
    mapping = slots.slot_map(usable, ["query", "response"], 15)
    assert {(r.raw, r.slot, r.n) for r in mapping.collect()} == {
        ("Order Number", "<ph_order_number>", 30), ("Rare Name", "<ph_rare_name>", 15)}
    tiny = replace(Settings(), literal_entries=0, broadcast_rows=0, hot_keys=1, hot_min_rows=1)
    a = plan.clean_pairs(usable, mapping)
    b = plan.clean_pairs(usable, mapping, tiny)
    assert a.exceptAll(b.select(*a.columns)).count() == 0 and b.count() == a.count()


def test_inverse_map_prefers_the_frequent_name(spark):
    df = spark.createDataFrame([("B b", "<ph_b_b>", 30), ("b B", "<ph_b_b>", 40), ("r", "<ph_details>", 1)],
                               "raw string, slot string, n bigint")
    assert [tuple(r) for r in slots.inverse_map(df).collect()] == [("<ph_b_b>", "b B")]


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_partitions_do_not_matter(spark, raw, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    want = plan.tokenised_pairs(plan.kept_pairs(plan.clean_pairs(raw))).collect()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        shuffled = raw.orderBy(F.md5(F.col("row_id").cast("string"))).repartition(3)
        got = plan.tokenised_pairs(plan.kept_pairs(plan.clean_pairs(shuffled))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("n", [1, 2, 9, 10, 37, 1000])
def test_exact_split_sizes(spark, n):
    df = spark.range(n).select(F.concat(F.lit("k"), (F.col("id")).cast("string")).alias("k"))
    twice = df.union(df)
    out = split.group_split(twice, "k", exact=True)
    sizes = {r.split: r.n // 2 for r in split.split_sizes(out).collect()}
    train, valid = int(.8 * n), int(.1 * n)
    want = {"train": train, "valid": valid, "test": n - train - valid}
    assert sizes == {k: v for k, v in want.items() if v}
    assert out.groupBy("k").agg(F.count_distinct("split").alias("c")).where("c > 1").count() == 0


def test_hash_split_shares(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("q"))
    sizes = {r.split: r.n / 20000 for r in split.split_sizes(split.group_split(df, "q")).collect()}
    assert sizes["train"] == pytest.approx(.8, abs=.01) and sizes["valid"] == pytest.approx(.1, abs=.01)
    assert "Exchange" not in split.group_split(df, "q")._jdf.queryExecution().executedPlan().toString()


def test_statistics(spark):
    df = spark.createDataFrame([("a b", "x"), ("a", "x"), (None, "y")], "q string, c string")
    row = stats.length_summary(df, ["q"]).first()
    assert (row["count"], row["mean"], row["min"], row["p50"], row["max"]) == (2, 1.5, 1, 1.5, 2)
    assert [tuple(r) for r in stats.value_counts(df, "c").collect()] == [("x", 2), ("y", 1)]
    assert tuple(stats.distinct_values(df, ["c"]).first()) == (2,)
    assert tuple(stats.row_count_check(df, 3).first()) == (3, 3, True)
    assert stats.row_count_check(df, 4).first().ok is False
    empty = vocab.token_counts(spark.createDataFrame([], "t array<string>"), ["t"])
    words = spark.createDataFrame([], "token string, id int, n bigint")
    assert vocab.coverage(empty, words).first().coverage == 0.0


def test_batches(spark):
    rows = [(i, [1] + [5] * (i % 9) + [2] + [0] * (9 - i % 9), [1, 7, 2, 0]) for i in range(150)]
    df = spark.createDataFrame(rows, "row_id bigint, src array<int>, tgt array<int>")
    out = vocab.training_batches(df).collect()
    assert len(out) == 150 and sorted({r.batch_id for r in out}) == [0, 1, 2]
    for b in range(3):
        batch = [r for r in out if r.batch_id == b]
        assert len(batch) == (64 if b < 2 else 22)
        assert len({len(r.src) for r in batch}) == 1
        assert any(r.src[-1] != 0 for r in batch)
        assert all(r.tgt_in == [1, 7] and r.tgt_out == [7, 2] for r in batch)


def test_sample_is_stable(spark):
    df = spark.range(500).withColumnRenamed("id", "row_id")
    a = [r.row_id for r in filters.seeded_sample(df, 20).collect()]
    b = [r.row_id for r in filters.seeded_sample(df.repartition(5), 20).collect()]
    assert a == b and a != [r.row_id for r in filters.seeded_sample(df, 20, seed=7).collect()]
