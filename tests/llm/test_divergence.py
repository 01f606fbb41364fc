import random
import re
from collections import Counter, defaultdict

import pytest

from pairmill.llm import divergence
from pairmill.llm.divergence import audited, terms

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=3, top=200, scale=10 ** 9):
    """The audit over (text, lang, source), term by term."""
    count, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall(lowered(text or ""))
        count[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        groups = {s: c for (own, s), c in count.items() if own == lang}
        share = {}
        for name, c in [*groups.items(), (None, sum(groups.values(), Counter()))]:
            total = sum(c[t] for t in kept)
            share[name] = {t: 1 + scale * (c[t] + 1) // (total + len(kept)) for t in kept}
        for s, c in groups.items():
            pairs = [(-sum((share[s][t] - share[o][t]) ** 2 // share[o][t] for t in kept), o)
                     for o in groups if o != s]
            p, q = share[s], share[None]
            single = [(-((p[t] - q[t]) ** 2 // q[t]), t) for t in kept if c[t] and p[t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", single, top)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -v, i) for i, (v, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def got(table, **more):
    return sorted(tuple(r) for r in audited(table, **more).collect())


def test_terms_of_pieces(monkeypatch):
    text = "Ab1cD é-ÀB\x00zz\x7fq " + "x" * 300 + " " + " ".join(f"wörd{'abc'[i % 3]}" for i in range(400))
    whole = [t.encode() for t in TERM.findall(lowered(text))]
    for size in (7, 64, 1 << 20):
        monkeypatch.setattr(divergence, "PIECE_BYTES", size)
        assert [t for part in terms(text.encode()) for t in part] == whole
    assert list(terms(b"")) == []


@pytest.mark.parametrize("bounds", [{}, {"HELD_TERMS": 5, "PAIRS": 7, "HELD_PAIRS": 3}])
def test_against_brute_force(spark, sample, awkward, monkeypatch, bounds):
    from pairmill.llm import skew
    for name, v in bounds.items():
        monkeypatch.setattr(divergence, name, v)
    if bounds:
        monkeypatch.setattr(skew, "HOT_LEAST", 1)
    rows = [(r.text, r.lang, r.source) for r in awkward.collect()]
    assert got(awkward) == brute(rows)
    assert got(awkward, least_docs=1, top_terms=3) == brute(rows, 1, 3)
    rows = [(r.text, r.lang, r.source) for r in sample.collect()]
    assert got(sample) == brute(rows)


def test_hot_source_nulls_and_groups_without_terms(spark):
    r = random.Random(5)
    words = "alpha beta Gamma delta épsilon zeta eta".split()
    rows = [(" ".join(r.choices(words, k=9)), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(120)]
    rows += [(None, "en", "empty"), ("12 34", "xx", "a"), (None, "xx", None), ("one", None, None), ("", None, "b")]
    table = spark.createDataFrame([(*x, 1, 1) for x in rows], "text string, lang string, source string, n int, gid int")
    assert got(table) == brute(rows)
    assert got(table.where("false")) == []


def test_share_of_large_counts(spark):
    for count, total in ((0, 5), (1 << 33, 1 << 34), ((1 << 33) - 1, 1 << 50), (10 ** 13, 10 ** 15)):
        row = spark.sql(f"select {count}L as c, {total}L as t, 7L as v").select(
            divergence.share("c", "t", "v", 10 ** 9).alias("p")).first()
        assert row.p == 1 + 10 ** 9 * (count + 1) // (total + 7)
