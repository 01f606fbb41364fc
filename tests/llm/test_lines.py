import random

import pytest

from pairmill.llm import lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(r, text, n):
    for _ in range(n):
        i, c = r.randrange(len(text) or 1), r.choice("abcé ")
        text = r.choice([text[:i] + c + text[i:], text[:i] + text[i + 1:], text[:i] + c + text[i + 1:]])
    return text


@pytest.mark.parametrize("distance", [0, 1, 2, 4])
def test_within(distance):
    r = random.Random(distance)
    for _ in range(1500):
        a = "".join(r.choice("ab") for _ in range(r.randint(0, 12)))
        b = changed(r, a, r.randint(0, 5)) if a and r.random() < .7 else a[::-1]
        assert lines.within(a, b, distance) == (edits(a, b) <= distance)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_keys_meet(distance):
    """Close lines share a segment at a place that the longer one probes."""
    r = random.Random(9)
    for _ in range(2000):
        a = "".join(r.choice("ab") for _ in range(r.randint(6, 20)))
        b = changed(r, a, r.randint(0, distance))
        if len(a) > len(b):
            a, b = b, a
        own = {(len(a), i, a[s:s + n]) for i, (s, n) in enumerate(lines.segments(len(a), distance))}
        assert own & {(m, i, b[s:s + n]) for m, i, s, n in lines.probes(len(b), distance, 1)}


def brute(rows, distance, least):
    places = {}
    for d, t in rows:
        for i, x in enumerate(t.split("\n")):
            if x.split():
                places.setdefault(x, []).append((d is not None, d or 0, i))
    texts = sorted(places)
    root = {x: x for x in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= distance and edits(a, b) <= distance:
                root[find(a)] = find(b)
    first = {}
    for x in texts:
        first[find(x)] = min([*places[x], *([first[find(x)]] if find(x) in first else [])])
    return sorted((p, first[find(x)], len(places[x]), p == first[find(x)]) for x in texts for p in places[x])


def rows_of(df):
    def place(d, i):
        return d is not None, d or 0, i
    return sorted((place(r.doc_id, r.line_no), place(r.class_doc, r.class_line), r.n_equal, r.kept)
                  for r in df.collect())


@pytest.mark.parametrize("group_rows", [512, 4])
def test_line_classes(spark, monkeypatch, group_rows):
    monkeypatch.setattr(lines, "GROUP_ROWS", group_rows)
    r = random.Random(2)
    base = ["".join(r.choice("abcdef é") for _ in range(r.randint(20, 40))) for _ in range(25)]
    rows = []
    for d in range(60):
        own = [changed(r, r.choice(base[:6] * 3 + base), r.randint(0, 3)) for _ in range(r.randint(0, 4))]
        rows.append((d, "\n".join([*own, ""])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert rows_of(lines.line_classes(df)) == brute(rows, 2, lines.LEAST_CHARS)


def test_awkward(awkward, texts_of):
    assert rows_of(lines.line_classes(awkward)) == brute(texts_of, 2, lines.LEAST_CHARS)


def test_without_repeated_lines(spark, awkward):
    rows = [(1, "a b\n\nsome words here\nlast", 5, 1), (2, "a b\nnew", None, 2), (3, "some words here", 1, 3),
            (4, None, 1, 4), (5, "", 0, 5), (6, "\n\n", 2, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, _x int")
    got = lines.without_repeated_lines(df).orderBy("doc_id")
    assert got.columns == df.columns and got.schema == df.schema
    assert [tuple(r) for r in got.collect()] == [rows[0], (2, "new", 3, 2), rows[3], rows[4], rows[5]]
    assert lines.without_repeated_lines(awkward).columns == awkward.columns


def test_empty(empty):
    assert lines.line_classes(empty).count() == 0 == lines.without_repeated_lines(empty).count()


def brute_left(rows, distance, least):
    """Texts without lines that equal an earlier one or are close to an earlier one that stays."""
    seen, stays, out = set(), [], []
    for d, t in rows:
        left = []
        for x in t.split("\n"):
            if x.split():
                if x in seen:
                    continue
                seen.add(x)
                if len(x) >= least:
                    if any(abs(len(x) - len(y)) <= distance and edits(x, y) <= distance for y in stays):
                        continue
                    stays.append(x)
            left.append(x)
        if left == t.split("\n") or any(x.split() for x in left):
            out.append((d, "\n".join(left)))
    return out


@pytest.mark.parametrize("group_rows", [512, 4])
def test_chains_of_close_lines(spark, monkeypatch, group_rows):
    """A line goes only for an earlier one that stays: not by way of others, nor for a later one."""
    monkeypatch.setattr(lines, "GROUP_ROWS", group_rows)
    base = "Invoice number 0000000 was paid in full"
    steps = [base[:15] + "9" * i + base[15 + i:] for i in range(8)]
    rows = [(i, steps[i] + "\nline of its own, number %d" % i) for i in (0, 4, 2, 1, 3, 6, 7, 5)]
    rows = [(d, t) for d, (_, t) in enumerate(rows)]
    r = random.Random(6)
    for d in range(8, 60):
        rows.append((d, "\n".join(changed(r, r.choice(steps), r.randint(0, 3)) for _ in range(2))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, lines.without_repeated_lines(df).collect()))
    assert got == brute_left(rows, 2, lines.LEAST_CHARS)
    assert [t.split("\n")[0] for _, t in got[:2]] == [steps[0], steps[4]]


def test_other_texts_stay_in_place(spark):
    """Only texts that lose a line are shuffled, however many lines are lost."""
    line = "a line of more than twenty-four characters"
    rows = [(i, f"text {i} of its own\n{line}") for i in range(4)] + [(9, "other\n\ntext"), (10, None), (11, line)]
    out = lines.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftAnti" in plan and "Join LeftSemi" in plan and "LeftOuter" not in plan
    assert {r.doc_id: r.text for r in out.collect()} == {
        0: rows[0][1], **{i: f"text {i} of its own" for i in (1, 2, 3)}, 9: "other\n\ntext", 10: None}
