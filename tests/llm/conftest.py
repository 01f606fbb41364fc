import pytest

WORDS = "the of and rain stone river walked over under light green small house yellow bird".split()


def prose(seed, n):
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def awkward_rows():
    """Nulls, empty and blank texts, ties, repeated rows, odd characters, a long text."""
    a, b = prose(1, 80), prose(2, 120)
    long = "\n".join(prose(100 + i, 40) for i in range(300))
    rows = [(1, a, "en"), (2, None, None), (3, "", "de"), (4, " \n\t ", "en"), (5, a, "en"), (5, a, "en"),
            (7, a + " end", "fr"), (8, b, None), (9, b[:300] + " other words here " + b[300:], "en"),
            (10, "é" * 500 + " ñandú \U0001f600 x\x00y", "es"), (11, long, "en"), (12, long + "\nmore", "en"),
            (13, "x", "en"), (14, "a" * 900, "en"), (15, "1 2 3 $$ ##", "en"), (16, b.upper(), "en"),
            (17, a + "\n" + a + "\n" + a, "en"), (-4, "Straße " * 60, "de"), (None, "no id at all", None)]
    clash = "kept fingerprint sequence_id row size n part root key"
    return [(i, t, lang, "src", len(t or ""), *([7] * 9)) for i, t, lang in rows], (
        "doc_id long, text string, lang string, source string, n_chars long, "
        + ", ".join(f"{c} int" for c in clash.split()))


@pytest.fixture(scope="session")
def awkward(spark):
    rows, schema = awkward_rows()
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def texts_of():
    return [(r[0], r[1] or "") for r in awkward_rows()[0]]


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
