"""Slot tables of any size, and the cut-off of the gate."""

import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pairmill.catalog.gating import slot_answers
from pairmill.functions.render import render
from pairmill.operators import gate, quantiles, slots
from pairmill.settings import Settings

TINY = replace(Settings(), literal_entries=0, broadcast_rows=0, hot_keys=1, hot_min_rows=1)
SLOTS = [("ORDER No", "<ph_order_no>", 9), ("order no", "<ph_order_no>", 30), ("Other", "<ph_details>", 99),
         ("E-mail", "<ph_e_mail>", 25)]


@pytest.mark.parametrize("settings", [Settings(), TINY])
def test_render_df(spark, settings):
    mapping = spark.createDataFrame(SLOTS, "raw string, slot string, n bigint")
    rows = [(1, 1, "your <ph_order_no> , \" <ph_e_mail> \" or <ph_order_no>".split(), ["<ph_unseen_name>"]),
            (1, 2, [], "<ph_e_mail> i".split()), (2, 1, ["no", "slot"], None), (2, 2, ["<ph_details>"], [])]
    df = spark.createDataFrame(rows, "a int, b int, one array<string>, two array<string>")
    got = {(r.a, r.b): (r.x, r.y) for r in slots.render_df(df, {"one": "x", "two": "y"}, mapping, ["a", "b"],
                                                          settings).collect()}
    assert got[1, 1] == ('Your {{order no}}, "{{E-mail}}" or {{order no}}.', "{{Unseen Name}}.")
    assert got[1, 2] == ("", "{{E-mail}} I.")
    assert got[2, 1][0] == "No slot." and got[2, 2] == ("{{Details}}.", "")


def test_bounds_of_the_map_change_no_answer(spark):
    """Constant or join, in the plan or beyond every bound: the same answers."""
    sf = "/root/testdata/sf0.01"
    few = lambda s: slot_answers(spark, sf, s).select("query_id", "response", "reason", "oov_ratio")
    one, other = few(Settings()).collect(), few(TINY).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other)) and len(one) > 1000
    assert any("{{BRAND#" in r.response or "{{Brand#" in r.response for r in one)


def test_map_too_large_for_the_plan(spark):
    mapping = spark.createDataFrame(SLOTS, "raw string, slot string, n bigint")
    assert not slots.fits_in_plan(mapping, TINY) and slots.fits_in_plan(mapping)
    with pytest.raises(ValueError):
        slots.small_map(mapping, TINY)


def test_names_in_order(values):
    got = values(lambda t: render(t, None, F.array(F.lit("A b"), F.lit(None), F.lit("C#"))),
                 [("<ph_x> to <ph_y_z> by <ph_w>".split(),)], "t array<string>")
    assert got == ["{{A b}} to {{Y Z}} by {{C#}}."]


@pytest.mark.parametrize("kind", ["even", "ties", "one"])
def test_exact_quantile(spark, monkeypatch, kind):
    monkeypatch.setattr(quantiles, "LAST_ROWS", 60)
    r = random.Random(8)
    rows = {"even": [r.gauss(0, 3) for _ in range(3000)], "ties": [1.0] * 500 + [2.0] * 500, "one": [5.0]}[kind]
    df = spark.createDataFrame([(x,) for x in rows] + [(None,)], "x double").coalesce(2).cache()
    for share in (0.05,) if kind != "one" else (1.0,):
        want = sorted(rows)[max(1, math.ceil(share * len(rows))) - 1]
        assert quantiles.exact_quantile(df, "x", share) == want
        assert gate.logprob_cutoff(df, share, "x", exact=True) == round(want, 6)
        if kind == "even":
            rank = sum(x <= quantiles.sketched_quantile(df, "x", share) for x in rows) / len(rows)
            assert abs(rank - share) <= quantiles.RANK_ERROR
    if kind == "one":
        assert gate.logprob_cutoff(df.where("x < -1e9"), column="x") is None
