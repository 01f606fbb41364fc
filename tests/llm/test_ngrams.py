import random
import re

import numpy as np
import pytest

from pairmill.llm import ngrams, skew
from pairmill.llm.ngrams import Hashes, linked, near_documents, overlaps, shingles


def set_of(text, words=4):
    own = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[i:i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()


def brute(rows, percent=85):
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
                  key=str)


def got(table):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_documents(table).collect()), key=str)


def family(n, seed, length=90):
    """Variants of one text, of variants of it, and so on: links at every distance from the threshold."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    texts = [[r.choice(words) for _ in range(length)]]
    while len(texts) < n:
        new = list(r.choice(texts))
        for _ in range(r.choice([1, 1, 2, 3])):
            new[r.randrange(len(new))] = r.choice(words)
        texts.append(new[:length - r.choice([0, 0, 5])])
    return [" ".join(t) for t in texts]


def test_shingles_of_pieces(monkeypatch):
    text = ("Ab c\x0bd \té é b c " * 40 + "ab c d").encode()
    known = Hashes()
    whole = shingles(text, 4, known)
    assert len(whole) == len(set_of(text.decode()))
    for size in (1, 10, 33):
        monkeypatch.setattr(ngrams, "PIECE_BYTES", size)
        assert (shingles(text, 4, known) == whole).all()
        assert len(shingles(b" a b  c ", 4, known)) == 1
    assert len(shingles(b" \n", 4, known)) == 0
    assert shingles(b"a b", 4, known) != shingles(b"a b c", 4, known)


@pytest.mark.parametrize("few", [0, 3, 100])
def test_overlaps(monkeypatch, few):
    monkeypatch.setattr(ngrams, "FEW", few)
    monkeypatch.setattr(ngrams, "TILE", 60)
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 60, n)).astype(np.uint64) for n in (5, 30, 31, 9, 50, 1, 30)]
    want = [[len(np.intersect1d(a, b)) if i < j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    assert overlaps(sets).tolist() == want


def test_sizes_too_far_apart_are_not_multiplied(monkeypatch):
    seen = []
    real = ngrams.overlaps
    monkeypatch.setattr(ngrams, "overlaps", lambda s: seen.append([len(x) for x in s]) or real(s))
    sets = [np.arange(n, dtype=np.uint64) for n in (100, 10, 90, 11, 85, 50)]
    assert sorted(map(sorted, linked(sets, 85))) == [[0, 4], [1, 3], [2, 4]]
    assert seen == [[10, 11], [85, 90, 100]]


@pytest.mark.parametrize("bounds", [{}, {"BLOCK_NODES": 4, "GROUP_ROWS": 3, "HELD_PAIRS": 10, "BROADCAST_NODES": 0}])
def test_against_brute_force(spark, sample, awkward, monkeypatch, bounds):
    for name, v in bounds.items():
        monkeypatch.setattr(ngrams, name, v)
    if bounds:
        monkeypatch.setattr(skew, "HOT_LEAST", 1)
    assert got(awkward) == brute([(r.doc_id, r.text) for r in awkward.collect()])
    rows = [(i, t) for i, t in enumerate(family(150, 1) + family(40, 2, 12) + family(20, 3, 4))]
    rows += [(None, rows[3][1]), (None, "one two"), (None, "one two"), (900, rows[4][1]), (900, "other text"), (901, "a b c")]
    table = spark.createDataFrame([(*x, 1, 2, 3) for x in rows], "doc_id long, text string, number int, key int, prefix int")
    assert got(table) == brute(rows)
    if not bounds:
        assert got(sample) == brute([(r.doc_id, r.text) for r in sample.collect()])
        assert got(table.where("false")) == []


def test_pairs_beyond_blocks_are_found(spark, monkeypatch):
    """With no block at all, the product over rare columns finds every link."""
    monkeypatch.setattr(ngrams, "block_links", lambda m, s, p: m.sparkSession.createDataFrame([], "a long, b long"))
    rows = [(i, t) for i, t in enumerate(family(80, 7) + family(40, 8, 30))]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_parities_are_a_bound():
    r = np.random.default_rng(2)
    for n in (3, 60, 3000):
        a, b = (np.unique(r.integers(0, 1 << 63, n)).astype(np.uint64) for _ in range(2))
        b = np.unique(np.concatenate([a[n // 3:], b[:n // 4]]))
        x, y = (np.frombuffer(ngrams.parities(s), np.uint64) for s in (a, b))
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_blocks_with_the_same_nodes_are_multiplied_once(spark):
    nodes = spark.createDataFrame([(1, 9, 5, 6), (2, 9, 5, 6), (3, 9, 5, 6), (4, 9, 7, 8), (5, 9, 7, 80), (6, 9, 70, 8)],
                                  "node long, size long, min_a long, min_b long")
    found = {}
    for r in ngrams.blocks_of(nodes).collect():
        found.setdefault(r.block, set()).add(r.node)
    assert sorted(map(sorted, found.values())) == [[1, 2, 3], [4, 5], [4, 6]]


def test_sets_are_read_in_place(spark):
    """Texts and their sets are not shuffled to meet the blocks."""
    rows = spark.createDataFrame([(i, i, t) for i, t in enumerate(family(12, 3))], "key long, doc_id long, text string")
    seen = []

    def sets(named):
        seen.append(ngrams.sets_of(rows, named, 4))
        return seen[0]

    member = spark.createDataFrame([(7, 1), (7, 2), (8, 2), (8, 3)], "block long, node long")
    found = ngrams.block_links(member, sets, 85).collect()
    assert {(r.a, r.b) for r in found} <= {(1, 2), (2, 1), (2, 3), (3, 2)}
    assert "BroadcastHashJoin" in (plan := seen[0]._jdf.queryExecution().executedPlan().toString()) and "Exchange hash" not in plan
