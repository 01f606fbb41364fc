"""Cheaper ways to the same rows: slots looked up inside rows, pairs that fall to their length, plain words."""

import random
from dataclasses import replace

from pyspark.sql import functions as F

from pairmill.functions import text
from pairmill.operators import slots
from pairmill.plans import prepare as plan
from pairmill.settings import Settings

PIECES = ["word", "Ünï", "a@b.example", "@user_x", "#tag", "☹☹", "!!!!", "<b i u>", "{{ Order No }}", "{{", "www.x.example/a",
          "http://y.example", "  ", "\t", "​", " ", "u", "asap", "it's", "12345", "'", "sooooo", "☺x", "x☺", "\xa0", "a\nb"]


def odd_texts(n: int) -> list[str]:
    pick = random.Random(5)
    return [" ".join(pick.choice(PIECES) for _ in range(pick.randrange(1, 14))) for _ in range(n)] + ["", " ", None]


def test_queries_told_to_be_long_are_long(spark):
    df = spark.createDataFrame([(t,) for t in odd_texts(400)], "q string")
    for limit in (2, 5):
        rows = df.select(text.surely_longer(F.col("q"), limit).alias("told"),
                         F.size(text.prepare_query(F.col("q"))).alias("n")).collect()
        assert all(r.n > limit for r in rows if r.told)
        assert sum(bool(r.told) for r in rows) > 20


def test_pairs_filtered_on_the_way_are_the_same(spark):
    texts = odd_texts(300)
    rows = [(i // 2 if i % 5 else None, a, b) for i, (a, b) in enumerate(zip(texts, texts[7:] + texts[:7]))]
    df = spark.createDataFrame(rows, "row_id bigint, query string, response string")
    settings = replace(Settings(), max_src_len=10)
    want = plan.kept_pairs(plan.clean_pairs(df, settings=settings), settings)
    got = plan.kept_clean_pairs(df, settings).select(*want.columns)
    columns = ["query_clean", "response_clean"]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert got.count() > 20


def test_squeeze_of_plain_and_other_texts(spark):
    df = spark.createDataFrame([(t,) for t in odd_texts(200) + [" a b ", "a  b", "a\x1cb", "ab\n"]], "q string")
    runs = F.trim(F.regexp_replace("q", f"{text.SPACE}+", " "))
    assert df.where(~text.squeeze(F.col("q")).eqNullSafe(runs)).count() == 0


def test_slots_of_a_map_of_broadcast_size_stay_in_their_rows(spark):
    rows = [(1, "my {{ A b }} is {{x}}", "{{C}}"), (1, "no slot", "{{ }} {{A b}}"), (None, "{{C}}{{C}}", "{{{A b}}} {{a}b}}")]
    pairs = spark.createDataFrame(rows, "row_id bigint, query string, response string")
    mapping = spark.createDataFrame([("A b", "<ph_a_b>", 30), ("C", "<ph_c>", 40), ("x", "<ph_details>", 1)],
                                    "raw string, slot string, n bigint").cache()
    beyond = replace(Settings(), literal_entries=0)
    found = plan.clean_pairs(pairs, mapping, beyond)
    shown = slots.render_df(found.select("row_id", F.split("query_clean", " ").alias("t")), {"t": "o"}, mapping, "row_id", beyond)
    for df in (found, shown):
        steps = df._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in steps and "Exchange" not in steps
    small = plan.clean_pairs(pairs, mapping)
    assert sorted(map(str, found.select(*small.columns).collect())) == sorted(map(str, small.collect()))
    assert sorted(r.o for r in shown.collect())[-1] == "{{C}} {{C}}."
