import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from pairmill.llm import exact, simhash, skew


def brute_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ")
             .replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_components(rows):
    """Smallest id reachable, for (id, fingerprint) rows."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{fp:016x}", least.get(find(i))) for i, (d, fp) in enumerate(rows)]


def key(r):
    return tuple((x is not None, x) for x in r)


def test_near_duplicates(awkward, texts_of):
    want = brute_components([(d, brute_fingerprint(t)) for d, t in texts_of])
    got = [tuple(r) for r in simhash.near_duplicates(awkward).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_near_duplicates_sample(sample):
    rows = sample.select("doc_id", "text").collect()
    want = brute_components([(r.doc_id, brute_fingerprint(r.text)) for r in rows])
    assert sorted(map(tuple, simhash.near_duplicates(sample).collect())) == sorted(want)


def test_near_duplicates_empty(empty):
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("group_rows", [1024, 8])
def test_links(spark, monkeypatch, group_rows):
    """A dense ball, chains and strangers, with ordinary and with dealt groups."""
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    r = random.Random(4)
    fps = {r.getrandbits(64) for _ in range(150)}
    for centre in list(fps)[:3]:
        for _ in range(60):
            x = centre
            for _ in range(r.randint(1, 5)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    chain = r.getrandbits(64)
    for i in range(0, 60, 4):
        chain ^= 0b1111 << i
        fps.add(chain)
    rows = list(enumerate(sorted(fps)))
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for _, f in rows], "fp long")
    found = skew.components(simhash.links(df, df.count()))
    back = {int(np.int64(f.node).view(np.uint64)): f.root for f in found.collect()}
    groups = {}
    for d, f in rows:
        groups.setdefault(back.get(f, ("alone", f)), set()).add(d)
    want = {}
    for d, _, c in brute_components(rows):
        want.setdefault(c, set()).add(d)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_LEAST", 3)
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(139, 200), (7, 7)]
    got = dict(map(tuple, skew.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), 200: 100}


@pytest.mark.parametrize("bits", [1 << 27, 64])
def test_exact(awkward, texts_of, bits):
    from hashlib import sha256
    got = exact.exact_groups(awkward, filter_bits=bits).collect()
    want = []
    for d, t in texts_of:
        same = [x for x, u in texts_of if u == t]
        keep = max((x for x in same if x is not None), default=None)
        want.append((d, keep, len(same), d == keep, sha256(t.encode()).hexdigest()))
    assert sorted((key(r[:3]) for r in got)) == sorted(key(r[:3]) for r in want)
    assert {r.text_sha256 for r in got} == {r[4] for r in want}
    assert sum(r.kept for r in got) == len({r[4] for r in want})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_empty(empty):
    assert exact.exact_groups(empty).count() == 0


def test_exact_native(awkward):
    plan = exact.exact_groups(awkward)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
