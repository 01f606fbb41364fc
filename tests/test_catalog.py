"""The registered queries: bookkeeping, and a sample against their SQL forms."""

import math
import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SAMPLE = ["clean_pages", "fill_slots_by_join", "render_documents", "capped_replies", "exact_split",
          "shared_between_splits", "training_batches", "scope_signals_by_join", "cut_at_eos",
          "corpus_bleu", "corpus_chrf", "perplexity", "answers", "live_refusal_rate", "transcripts", "split_csv", "query_csv"]

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_names():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 80
    own = {n for n in queries if n != "pipeline" and not n.startswith("op")}
    assert own - set(sql) == {"evaluation_report"}


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert int(out.stdout) > 80, out.stderr


def shown(v):
    return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)


@needs_data
@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(shown, r)) for r in df.select(*cols).collect())
    res = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in res.fetchall())


@needs_data
def test_entry(spark):
    assert {r.split for r in entry.entry(spark).collect()} <= {"train", "valid", "test"}


@needs_data
def test_report(spark):
    rows = {(r.strategy, r.metric): r.value for r in entry.queries()["evaluation_report"](spark, SF).collect()}
    assert rows["copy", "bleu"] == pytest.approx(100) and rows["copy", "rougeL"] == 1.0
    assert 0 <= rows["echo", "chrf"] < 100 and rows["all", "perplexity_valid"] > 1
