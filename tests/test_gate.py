"""Scope gate, hypotheses and answers on hand-worked rows."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pairmill.functions import fixed
from pairmill.operators import gate, hypotheses
from pairmill.plans.answer import answer_batch, batch_summary
from pairmill.settings import Settings

LEXICON = [("order", 9, True, 1), ("refund", 5, True, 2), ("cancel", 2, True, None),
           ("status", 1, False, 3), ("the", 50, True, None)]
QUERIES = [
    (1, ["cancel", "order", "the"], -1.0),
    (2, ["order", "penguin"], -1.5),            # half unknown, both bounds inclusive
    (3, ["order", "penguin", "joke", "penguin"], -0.1),
    (4, ["?"], 0.0),
    (5, ["<ph_order_number>"], 0.0),
    (6, ["refund"], -1.51),
    (7, [], 0.0),
    (8, ["status"], 0.0),                       # an anchor may be unknown
]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "token string, n bigint, known boolean, anchor_rank int")


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(QUERIES, "row_id bigint, query_tokens array<string>, logprob double")


@pytest.mark.parametrize("join", [False, True])
def test_verdicts(asked, lexicon, join):
    signals = gate.scope_signals(asked, lexicon, always_join=join)
    rows = {r.row_id: r for r in gate.verdict(signals).collect()}
    assert [rows[i].in_scope for i in range(1, 9)] == [
        True, True, False, False, True, False, False, False]
    assert [rows[i].oov_ratio for i in range(1, 9)] == [0, .5, .75, 1, 0, 0, 1, 1]
    assert [rows[i].n_anchors for i in range(1, 9)] == [1, 1, 1, 0, 0, 1, 0, 1]
    assert rows[3].unknown_words == ["penguin", "joke", "penguin"]
    assert rows[1].reason == "in scope (1 known support term)"
    assert rows[5].reason == "in scope (0 known support terms)"
    assert rows[3].reason == ("75% of the meaningful words in this query never appear in the "
                              "support corpus (penguin, joke, penguin)")
    assert rows[4].reason.startswith("100%") and rows[4].reason.endswith("(none)")
    assert rows[6].reason == "the decoder is not confident (mean log-probability -1.51)"
    assert rows[7].reason == gate.EMPTY_REASON and rows[7].avg_logprob == 0.0


@pytest.mark.parametrize("join", [False, True])
def test_equal_queries_under_keys_of_two_columns(spark, lexicon, join):
    rows = [("a", 1, ["zzzz", "status"]), ("a", 2, ["zzzz", "status"]), ("b", 1, ["zzzz", "status"])]
    df = spark.createDataFrame(rows, "conv_id string, turn int, query_tokens array<string>")
    out = gate.scope_signals(df, lexicon, key=["conv_id", "turn"], always_join=join).collect()
    assert len(out) == 3
    assert {(tuple(r.unknown), r.n_anchors) for r in out} == {(("zzzz", "status"), 1)}


def test_percent_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.625,), (0.875,)], "o double")
    out = df.select(gate.reason_text(F.col("o"), F.lit(0.0), F.lit(0),
                                     F.array().cast("array<string>")).alias("r")).collect()
    assert [r.r[:3] for r in out] == ["62%", "88%"]


def test_lexicon(spark):
    train = spark.createDataFrame([(["order", "order", "a", "a", "zed"],), (["b2b", "cat", "cat"],)],
                                  "query_tokens array<string>")
    rows = {r.token: r for r in gate.scope_lexicon(train, top_k=2).collect()}
    assert {t for t, r in rows.items() if r.known} == {"order", "a", "cat"}
    assert {t: r.anchor_rank for t, r in rows.items() if r.anchor_rank} == {"cat": 1, "order": 2}


def test_best_hypothesis(spark):
    rows = [(1, "beam", 0, -4.0, 4), (1, "beam", 1, -5.0, 10), (1, "beam", 2, -5.0, 10),
            (2, "beam", 0, -1.0, 0)]
    df = spark.createDataFrame(rows, "query_id bigint, strategy string, hyp_id int, logprob_sum double, len int")
    got = {r.query_id: (r.hyp_id, r.avg_logprob) for r in hypotheses.best_hypothesis(df).collect()}
    assert got == {1: (1, -0.5), 2: (0, -1.0)}


def test_cut_at_eos(spark):
    steps = [(1, 0, 7, -1.0), (1, 1, 9, -2.0), (1, 2, 2, -3.0), (1, 3, 8, -99.0),
             (2, 0, 5, -1.0), (2, 1, 6, -2.0)]
    df = spark.createDataFrame(steps, "query_id bigint, pos int, token_id int, logprob double")
    got = {r.query_id: (r.n_tokens, r.avg_logprob) for r in hypotheses.cut_at_eos(df).collect()}
    assert got == {1: (2, -2.0), 2: (2, -1.5)}
    arrays = spark.createDataFrame([([7, 9, 2, 8], [-1.0, -2.0, -3.0, -99.0])],
                                   "ids array<int>, lp array<double>")
    row = arrays.select(hypotheses.cut_arrays_at_eos(F.col("ids"), F.col("lp")).alias("c")).first().c
    assert (row.ids, row.avg_logprob) == ([7, 9], -2.0)


def test_gate_rates(spark):
    df = spark.createDataFrame([(True, True), (True, False), (True, True), (False, False)],
                               "in_domain boolean, in_scope boolean")
    assert tuple(gate.gate_rates(df).first()) == (0.6667, 1.0)


def test_answers(spark, lexicon):
    vocab = spark.createDataFrame([("hello", 4, 9), ("<ph_order_number>", 5, 3), (".", 6, 3)],
                                  "token string, id int, n bigint")
    queries = spark.createDataFrame([
        (1, "pls cancel order 12345"), (2, "joke about penguins"), (3, "  "), (4, "refund")],
        "query_id bigint, query string")
    candidates = spark.createDataFrame([
        (1, "beam", 0, [4, 5, 6, 2], -1.0, 4), (1, "beam", 1, [4, 2], -9.0, 2),
        (2, "beam", 0, [4, 2], -0.1, 2), (3, "beam", 0, [4, 2], -0.1, 2)],
        "query_id bigint, strategy string, hyp_id int, token_ids array<int>, logprob_sum double, len int")
    slots = {"Order No": "<ph_order_number>"}
    out = answer_batch(queries, candidates, lexicon, vocab, slots)
    rows = {r.query_id: r for r in out.collect()}
    assert rows[1].response == "Hello {{Order No}}." and rows[1].in_scope
    assert rows[1].query_tokens == ["please", "cancel", "order", "<ph_order_number>"]
    assert rows[1].avg_logprob == -0.25 and rows[1].beam_size == 3
    assert rows[2].response == fixed.REFUSAL and not rows[2].in_scope
    assert rows[3].response == fixed.REFUSAL and rows[3].reason == gate.EMPTY_REASON
    assert rows[4].response == fixed.REFUSAL        # nothing drafted
    free = {r.query_id: r for r in answer_batch(queries, candidates, lexicon, vocab, slots,
                                                apply_gate=False, limit=2).collect()}
    assert set(free) == {1, 2} and free[2].response == "Hello." and not free[2].in_scope
    assert batch_summary(out).first().out_of_scope == 3


def test_join_path_equals_set_path_with_small_bounds(asked, lexicon):
    tiny = replace(Settings(), broadcast_rows=1, hot_keys=1, hot_min_rows=1)
    a = gate.verdict(gate.scope_signals(asked, lexicon))
    b = gate.verdict(gate.scope_signals(asked, lexicon, settings=tiny, always_join=True))
    assert a.exceptAll(b.select(*a.columns)).count() == 0
