import hashlib
import random

import numpy as np
import pytest

from pairmill.llm import repeats
from pairmill.llm.suffixes import sort_suffixes


def brute(rows, size):
    """Removal by a table of all windows. Rows of one id are one document."""
    first = {}
    for d, t in rows:
        t = t.encode()
        for i in range(len(t) - size + 1):
            place = (-(1 << 63) if d is None else d, i)
            w = t[i:i + size]
            first[w] = min(first.get(w, place), place)
    out = []
    for d, t in rows:
        t = t.encode()
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if first[t[i:i + size]] < (-(1 << 63) if d is None else d, i):
                gone[i:i + size] = b"\1" * size
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = bytes(gone).decode("latin-1").split("\0")
        out.append((d, len(t), sum(gone), sum(map(bool, runs)), hashlib.sha256(kept).hexdigest()))
    return out


def check(got, rows, size):
    def key(r):
        return r[0] is not None, r[0] or 0, r[1:]
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(brute(rows, size), key=key)


def test_sort_suffixes():
    r = random.Random(8)
    for letters, n in (("ab", 400), ("abcdefgh", 300), ("a", 200)):
        data = "".join(r.choice(letters) for _ in range(n)).encode()
        data += data[50:200] + b"xyz" + data[20:180]
        at = np.arange(len(data) - 100)
        r.shuffle(at)
        group = np.array([r.randrange(3) for _ in at])
        order, equal = sort_suffixes(data, at, group, 100)
        got = [(group[i], data[at[i]:at[i] + 100]) for i in order]
        assert got == sorted(got) and sorted(order) == list(range(len(at)))
        assert equal.tolist() == [i > 0 and got[i] == got[i - 1] for i in range(len(got))]


def shared_rows():
    """Copies, near copies, shared passages, runs of one letter, repeats within a text."""
    r = random.Random(11)

    def text(n):
        return "".join(r.choice("abcdefghij klmnop\n") for _ in range(n))

    passage, line, base = text(400), text(70), text(3000)
    rows = [(0, base), (1, base), (2, "x" + base[:1500] + "edit" + base[1500:]), (3, "a" * 700), (4, "a" * 350),
            (5, passage + text(50) + passage), (6, "ab" * 300), (7, passage[:99]), (8, passage[:100])]
    for i in range(9, 60):
        t = text(r.randint(50, 600))
        at = r.randint(0, len(t))
        rows.append((i, t[:at] + r.choice([passage, passage[100:250], line, base[200:900], ""]) + t[at:]))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("group_rows", [20_000, 3])
@pytest.mark.parametrize("block", [4 << 20, 500])
def test_shared(spark, monkeypatch, group_rows, block):
    monkeypatch.setattr(repeats, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(repeats, "BLOCK", block)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        rows = shared_rows()
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        check(repeats.without_repeats(df).collect(), rows, 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_awkward(awkward, texts_of):
    check(repeats.without_repeats(awkward, size=70).collect(), texts_of, 70)


def test_sample(sample):
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    check(repeats.without_repeats(sample).collect(), rows, 100)


def test_empty(empty):
    assert repeats.without_repeats(empty).count() == 0


def kept_by_stage(monkeypatch, names):
    """Rows of the staged tables of these names, as the operator runs."""
    found, stage = {}, repeats.stage

    def record(df, name):
        out = stage(df, name)
        if name in names:
            found[name] = out.collect()
        return out

    monkeypatch.setattr(repeats, "stage", record)
    return found


def test_sides(spark, monkeypatch):
    """Texts that share a long gram but no side of it are not read again; those that share one side are."""
    r = random.Random(5)

    def text(n):
        return "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))

    gram, side = text(60), text(30)
    apart = [(i, text(200) + gram + text(200)) for i in range(8)]
    beside = [(i, text(200) + side + gram + side + text(200)) for i in (10, 11)]
    found = kept_by_stage(monkeypatch, {"places"})
    for rows, keys in ((apart, set()), (apart + beside, {10, 11})):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        check(repeats.without_repeats(df).collect(), rows, 100)
        assert {p.key for p in found["places"]} == keys


@pytest.mark.parametrize("size", [64, 65, 100, 127, 158])
@pytest.mark.parametrize("group_rows", [20_000, 5])
def test_shared_by_a_little(spark, monkeypatch, size, group_rows):
    """Strings about as long as ``size`` stand in other texts, at a text's ends and after one another."""
    monkeypatch.setattr(repeats, "GROUP_ROWS", group_rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 29)
    try:
        r = random.Random(size)

        def text(n):
            return "".join(r.choice("ab cd") for _ in range(n))

        base, rows = text(400), []
        for i in range(90):
            at, n = r.randrange(300), r.randint(size - 2, size + 3)
            rows.append((i, text(r.choice([0, 1, 150])) + base[at:at + n] + text(r.choice([0, 1, 40]))
                         + base[at // 2:at // 2 + r.choice([0, size])]))
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
        check(repeats.without_repeats(df, size).collect(), rows, size)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("bound", [1 << 25, 0])
def test_other_texts_stay_in_place(spark, monkeypatch, bound):
    """Only texts of which something is found are shuffled, whatever a broadcast may take."""
    from pairmill.llm import common
    monkeypatch.setattr(common, "BROADCAST_BYTES", bound)
    rows = shared_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = repeats.without_repeats(df)
    check(out.collect(), rows, 100)
    for table in (out, repeats.without_passages(df)):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftAnti" in plan and "Join LeftSemi" in plan and "LeftOuter" not in plan
    before = {r.doc_id: r.text for r in repeats.without_passages(df).collect()}
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    assert {r.doc_id: r.text for r in repeats.without_passages(df).collect()} == before
    check(repeats.without_repeats(df).collect(), rows, 100)
