import random
import zlib

import numpy as np
import pytest

from pairmill.llm import idfiles, packing
from pairmill.llm.tokens import Encoder, tokenizer_path

ODD = ["", " ", "It's don't THEY'LL O'Neil's 's", "H̱ İ é", "<|endoftext|>Ab<|ENDOFTEXT|> x",
       "x\x1cy\x85z\xa0w　v", "ªº µ ² ½ 3rd a1b2", "ΑΣ Σ ΌΣ", "日本語 text", "a,b.c!! ...((x)) $$%",
       "Straße ÀÉÎ ÿ ÷×", "word's, word's", "a​b", "\U0001f600\U0001f600 ok"]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    return lambda x: t.encode(x, add_special_tokens=False).ids


def test_encoder(whole, sample):
    coder = Encoder(tokenizer_path(), cached=200)
    for text in ODD + [r.text for r in sample.select("text").collect()]:
        assert np.frombuffer(coder.encode(text.encode()), "<u4").tolist() == whole(text)


def test_encoder_random(whole):
    coder, r = Encoder(tokenizer_path()), random.Random(5)
    letters = "aB'stRe.,#é́ßÉ9² \n<|>ıİ"
    for _ in range(1500):
        text = "".join(r.choice(letters) for _ in range(r.randint(1, 25)))
        assert np.frombuffer(coder.encode(text.encode()), "<u4").tolist() == whole(text), repr(text)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("ends", [[], [0], [5], [0, 0, 3, 3, 900], [2**33, 2**33 + 1],
                                  np.cumsum(np.arange(500) % 37).tolist()])
def test_boundaries(ends):
    code = idfiles.Boundaries.of(np.array(ends, np.int64))
    assert code.all().tolist() == list(ends)
    assert [code.end(i) for i in range(len(ends))] == list(ends)
    if len(ends) > 100:
        size = sum(map(len, code[2:]))
        assert size < len(ends) * 2 and code.span(3) == (ends[2], ends[3])


def test_id_files(spark, awkward, texts_of, whole, tmp_path):
    idfiles.write_ids(awkward, f"{tmp_path}/ids")
    got = idfiles.read_ids(spark, f"{tmp_path}/ids", with_ids=True).orderBy("start").collect()
    want = sorted(texts_of, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start = 0
    for row, (doc_id, text) in zip(got, want, strict=True):
        ids = [*whole(text), 1]
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), crc(ids))
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)


def test_id_files_empty(spark, empty, tmp_path):
    idfiles.write_ids(empty, f"{tmp_path}/none")
    assert idfiles.read_ids(spark, f"{tmp_path}/none").count() == 0


def test_fill():
    from collections import Counter
    from itertools import product
    r = random.Random(3)
    for _ in range(300):
        counts = Counter(r.choices(range(1, 15), k=r.randint(0, 8)))
        capacity = r.randint(0, 40)
        best = max(s for c in product(*(range(n + 1) for n in counts.values()))
                   if (s := sum(k * x for k, x in zip(c, counts))) <= capacity)
        got = packing.fill(counts, capacity)
        assert sum(n * k for n, k in got.items()) == best and all(got[n] <= counts[n] for n in got)


def check_pieces(rows, capacity):
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        total = sum(n for _, n in own)
        assert total == capacity or total < capacity and total & total - 1 == 0


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packed(awkward, texts_of, whole, capacity):
    rows = packing.packed(awkward, capacity=capacity, with_ids=True).collect()
    check_pieces(rows, capacity)
    held = {}
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        held.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts_of:
        ids = [*whole(text), 2]
        own = sorted(held[doc_id], key=lambda r: r.start)
        assert {r.doc_tokens for r in own} == {len(ids)}
        copies = sum(d == doc_id for d, _ in texts_of)
        assert sum(r.length for r in own) == copies * len(ids)
        if copies == 1:
            assert np.frombuffer(b"".join(r.ids for r in own), "<u4").tolist() == ids
            assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]


def test_packed_empty(empty):
    assert packing.packed(empty).count() == 0
