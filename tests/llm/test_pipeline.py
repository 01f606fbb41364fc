import random

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from pairmill.llm import common, lines, repeats
from test_tokens import check_pieces


def test_stages(spark, awkward, empty):
    docs = awkward
    for name, step in corpus_pipeline.STAGES[:-1]:
        for source in (docs, empty):
            kept = step(spark, source, None)
            assert kept.columns == source.columns and kept.schema.names == source.schema.names
        docs = spark.createDataFrame(step(spark, docs, None).collect(), docs.schema)
    assert 0 < docs.count() < awkward.count()
    assert corpus_pipeline.STAGES[-1][1](spark, empty, None).count() == 0


def test_run(spark):
    rows = entry.queries()["pipeline"](spark, "/root/testdata/sf0.001").collect()
    check_pieces(rows, 4096)
    ids = {r.doc_id for r in rows}
    assert 100 < len(ids) < 200


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def rows_of_shared_ids():
    """Different texts under null and repeated ids; some have copies, lines or passages of others."""
    r = random.Random(4)

    def text(n):
        return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n))

    x, y, line, passage = text(60), text(60), text(12), text(40)
    return [(None, x), (None, y), (None, x), (None, passage + text(20)), (None, text(20) + passage + text(9)),
            (3, x), (5, text(30) + "\n" + line), (5, text(25)), (5, line + "\n" + text(31)), (5, y), (5, "12 34"),
            (6, text(22)), (None, "12 34"), (7, text(40)), (7, text(40))]


@pytest.mark.parametrize("stage", range(4))
def test_shared_ids(spark, stage):
    """Every row is judged as under an id of its own."""
    rows = rows_of_shared_ids()
    order = [t for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]

    def run(data):
        labelled = [(100 + i, t, t[:2], len(t)) for i, t in enumerate(["ab cd ef gh ij kl mn op", "xy zw vu"] * 9)]
        df = spark.createDataFrame([(i, t, None, len(t)) for i, t in data] + labelled * (stage == 0),
                                   "doc_id long, text string, lang string, n_chars int").coalesce(1)
        return sorted((r.text, r.n_chars) for r in corpus_pipeline.STAGES[stage][1](spark, df, None).collect())

    got = run(rows)
    assert got == run(list(enumerate(order))) and got
    assert got != sorted((t, len(t)) for _, t in rows)


@pytest.mark.parametrize("stage", range(4))
@pytest.mark.parametrize("shuffled", [False, True])
def test_clashing_columns_and_no_broadcast(spark, monkeypatch, stage, shuffled):
    """Columns with the names of helper columns come through, on either path of the joins."""
    if shuffled:
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rows = rows_of_shared_ids()
    names = "row _row gone _gone _kept kept spans key at row_at places".split()
    labelled = [(100 + i, t, t[:2], len(t), *[7] * len(names))
                for i, t in enumerate(["ab cd ef gh ij kl mn op", "xy zw vu"] * 9)] * (stage == 0)
    data = [(i, t, None, len(t), *range(77, 77 + len(names))) for i, t in rows] + labelled
    schema = "doc_id long, text string, lang string, n_chars int, " + ", ".join(f"`{n}` int" for n in names)
    df = spark.createDataFrame(data, schema).coalesce(1)
    kept = corpus_pipeline.STAGES[stage][1](spark, df, None)
    assert kept.columns == df.columns
    got = [tuple(r) for r in kept.collect()]
    plain = [(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.STAGES[stage][1](
        spark, df.select("doc_id", "text", "lang", "n_chars"), None).collect()]
    assert sorted((r[0], r[1], r[3]) for r in got if r[0] is not None) == sorted(p for p in plain if p[0] is not None)
    assert len(got) == len(plain) and all(r[4:] in (tuple(range(77, 77 + len(names))), (7,) * len(names)) for r in got)


def test_one_long_text(spark):
    """A text of over a megabyte goes through all stages whole."""
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(30_000)]
    long = "\n".join(" ".join(r.choices(words, k=15)) for _ in range(12_000))
    rows = [(1, long, "xx", len(long)), (3, long, "xx", 1), *((10 + i, " ".join(words[9 * i:9 * i + 9]), "xx", 62) for i in range(12))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(step(spark, docs, None).collect(), docs.schema)
    assert sorted((r.doc_id, r.text == long) for r in docs.collect()) == [(1, True), *((10 + i, False) for i in range(12))]


def test_operators_of_shared_ids(spark):
    rows = rows_of_shared_ids()
    order = [t for _, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    schema = "doc_id long, text string"
    own, plain = (spark.createDataFrame(d, schema).coalesce(1) for d in (rows, list(enumerate(order))))
    cut = [sorted(r.kept_sha256 for r in repeats.without_repeats(d).collect()) for d in (own, plain)]
    assert cut[0] == cut[1]
    kept = [sorted((r.line_no, r.n_equal, r.kept) for r in lines.line_classes(d).collect()) for d in (own, plain)]
    assert kept[0] == kept[1]
