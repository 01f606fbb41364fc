from fractions import Fraction

import numpy as np
import pytest

from pairmill.llm import whitening
from pairmill.llm.whitening import by_component, cross_products, whitened


def brute(vectors, components=32):
    """Deviation and scores of usable vectors of one length, with plain loops over fractions."""
    x = [[int(np.floor(64.0 * float(c))) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    mean = [Fraction(s, n) for s in sums]
    cov = np.array([[float(sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n) for j in range(d)]
                    for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    centred = np.array([[float(r[i] - mean[i]) for i in range(d)] for r in x])
    return ([sum((n * r[i] - sums[i]) ** 2 for i in range(d)) for r in x], centred @ axes / np.sqrt(values),
            values / np.trace(cov))


def compared(got, want):
    deviations, scores, explained = want
    assert [r.deviation for r in got] == deviations
    found = np.array([r.whitened for r in got])
    signs = np.sign((found * scores).sum(0))
    assert np.abs(found - scores * signs).max() < 1e-7
    assert np.abs(np.array(got[0].explained) / explained - 1).max() < 1e-9
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize("span", [1, 100, 1 << 20, 1 << 40, 1 << 62])
def test_cross_products(span):
    r = np.random.default_rng(span % 97)
    x = r.integers(-span, span, (130, 7))
    x[:, 3] = 5
    want = x.astype(object).T @ x.astype(object)
    assert (cross_products(x) == want).all()


def test_against_fractions(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = sorted(whitened(rows).collect(), key=lambda r: r.vec_id)
    given = sorted(rows.select("vec_id", "embedding").collect(), key=lambda r: r.vec_id)
    assert [r.vec_id for r in got] == [r.vec_id for r in given]
    compared(got, brute([r.embedding for r in given]))


def test_awkward_rows(spark):
    r = np.random.default_rng(3)
    good = [[float(v) for v in x] for x in r.normal(size=(40, 5))]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [1.0, float("inf"), 0.0, 0.0, 0.0]]
    rows = [(i % 30, v, 7, 7, 7) for i, v in enumerate(good)] + [(None, good[0], 7, 7, 7)]
    table = spark.createDataFrame(rows + [(90 + i, v, 7, 7, 7) for i, v in enumerate(bad)],
                                  "vec_id long, embedding array<double>, n int, dims int, whitened int")
    got = whitened(table).collect()
    assert len(got) == 41 and sum(r.vec_id is None for r in got) == 1
    order = {}
    for v, (d, s) in zip([v for _, v, *_ in rows], zip(*brute([v for _, v, *_ in rows])[:2], strict=True),
                         strict=True):
        order[tuple(v)] = (d, s)
    assert {r.n for r in got} == {41}
    assert sorted(r.deviation for r in got) == sorted(order[tuple(v)][0] for _, v, *_ in rows)
    assert by_component(whitened(table)).count() == 41 * 5
    assert whitened(table.where("false")).count() == 0
    assert whitened(table.where("vec_id >= 90")).count() == 0


def test_lengths_ties_and_huge_entries(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [5.0]), (4, [1e300, -1e300, 0.0]), (5, [0.0, 1.0, 2.0]),
            (6, [2.0]), (7, [9.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in whitened(table).collect()}
    assert {i: (r.dims, r.n) for i, r in got.items()} == {
        1: (2, 2), 2: (2, 2), 3: (1, 3), 4: (3, 2), 5: (3, 2), 6: (1, 3), 7: (1, 3)}
    assert got[1].whitened == [None, None] and got[1].deviation == 0  # equal rows have no variance
    assert got[4].deviation is None and got[4].deviation_wide == got[5].deviation_wide
    x = [64 * v + 1_000_000 for v in (5, 2, 9)]
    assert [got[i].deviation for i in (3, 6, 7)] == [(3 * v - sum(x)) ** 2 for v in x]


def test_more_tasks_and_blocks_change_nothing(spark, monkeypatch):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    one = {r.vec_id: r.deviation for r in whitened(rows.coalesce(1)).collect()}
    monkeypatch.setattr(whitening.vectors, "__defaults__", (7,))
    assert one == {r.vec_id: r.deviation for r in whitened(rows.repartition(9)).collect()}
