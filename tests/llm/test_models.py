import random
from collections import Counter

import numpy as np
import pytest

from pairmill.llm import grading, language, pieces, quality
from pairmill.llm.queries import language_training
from pairmill.llm.tokens import tokenizer_path


def brute_measures(text):
    import re
    words = re.findall("[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    dup = sum(bool(re.search("[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_quality(spark, awkward, texts_of):
    got = {(r.doc_id, r.n_words): r for r in quality.judged(awkward).collect()}
    for d, t in texts_of:
        want = brute_measures(t)
        r = got[d, want[0]]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_sample(spark, sample):
    for r in sample.select("text").collect():
        assert quality.measures(r.text.encode())[:5] == brute_measures(r.text)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    rows = quality.judged(sample).join(labels.withColumnRenamed("quality", "label"), "doc_id").collect()
    good = [r.kept for r in rows if r.label == 1 and not r.base_failed]
    assert sum(good) >= 0.98 * len(good)


def test_rules_weighed():
    """The posterior separates two kinds of texts by noisy votes, whose accuracies are not given."""
    r = random.Random(1)
    accuracy, seen = [0.9, 0.8, 0.75, 0.6, 0.85], Counter()
    truth = []
    for _ in range(6000):
        y = r.random() < 0.7
        own = [2 if r.random() < .2 else int(y if r.random() < a else not y) for a in accuracy]
        p = sum(v * 3 ** j for j, v in enumerate(own))
        seen[p] += 1
        truth.append((p, y))
    post = quality.fit(seen, 5)
    assert sum((post[p] >= .5) == y for p, y in truth) > 0.9 * len(truth)
    assert quality.fit({}, 5) == {}


def brute_viterbi(scores, penalty):
    n = scores.shape[1]
    value, path = scores[0].copy(), [[i] for i in range(n)]
    for row in scores[1:]:
        steps = [max(range(n), key=lambda k: value[k] - penalty * (k != i)) for i in range(n)]
        value, path = np.array([value[k] - penalty * (k != i) for i, k in enumerate(steps)]) + row, \
            [path[k] + [i] for i, k in enumerate(steps)]
    return value.max()


def test_viterbi():
    r = np.random.default_rng(3)
    scores = -r.random((50, 3)) * 4
    ids = [r.integers(0, 50, n) for n in (7, 0, 30, 1, 30, 12)]
    for own, labels in zip(ids, language.viterbi(ids, scores, 2.5), strict=True):
        assert len(own) == len(labels)
        if len(own):
            value = scores[own, labels].sum() - 2.5 * (labels[1:] != labels[:-1]).sum()
            assert value == pytest.approx(brute_viterbi(scores[own], 2.5))


def test_language(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identified(docs, language_training(docs)).join(docs.select("doc_id", "lang"), "doc_id").where(
        "crc32(cast(doc_id as string)) % 3 = 1").collect()
    assert sum(r.lang == r.lang_pred for r in got) > 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    mixed = spark.createDataFrame([(1, "der und die verpf cherschü heit " * 9 + "the and of tion hing with " * 9),
                                   (2, None), (3, "12 %$"), (4, "привет мир")], "doc_id long, text string")
    rows = {r.doc_id: r for r in language.identified(mixed, docs).collect()}
    assert [s.lang for s in rows[1].spans] == ["de", "en"] and (rows[2].lang_pred, rows[3].score) == ("und", 0)
    assert rows[4].lang_pred in ("en", "de", "fr", "es") and rows[4].score == 0
    assert language.identified(awkward, docs).count() == awkward.count()
    assert language.identified(empty, docs).count() == 0
    assert {r.lang_pred for r in language.identified(awkward, empty).collect()} == {"und"}


def test_scripts(spark):
    rows = [("hello there world", "en"), ("привет мир дорогой", "ru"), ("γεια σου κόσμε", "el")] * 3
    training = spark.createDataFrame(rows, "text string, lang string")
    asked = spark.createDataFrame([(1, "мир"), (2, "κόσμε"), (3, "world")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.identified(asked, training).collect()}
    assert got == {1: "ru", 2: "el", 3: "en"}


def test_grading(spark, awkward, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr(
        "doc_id", "case when toxic = 1 then 0 else 1 + quality end as grade")
    known = labels.where("doc_id % 3 <> 0")
    got = grading.graded(docs, known).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    assert sum(r.selected == (r.grade == 2) for r in got) > 0.85 * len(got)
    mean = [np.mean([r.expected_grade for r in got if r.grade == g]) for g in range(3)]
    assert max(mean[:2]) < mean[2]
    assert grading.graded(awkward, known).count() == awkward.count()
    assert not any(r.selected for r in grading.graded(awkward, labels.where("false")).collect())
    assert grading.graded(empty, known).count() == 0


def test_grading_slopes():
    """The fitted model has no better neighbour."""
    data = [b"good fine text", b"bad text", b"fine good", b"bad awful", b"awful", b"good"] * 5
    model = grading.fit(data, [2, 1, 2, 0, 0, 2] * 5, 3, rounds=400, decay=1e-2)
    assert model.thresholds[0] < model.thresholds[1]
    assert model.tails(b"good")[1] > 0.5 > model.tails(b"awful")[0]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(tokenizer_path("piece_bpe_32k.model"))


def brute_segmentations(v, unit):
    if not unit:
        return [(0.0, ())]
    out = []
    for n in range(1, min(len(unit), v.longest) + 1):
        head, i = unit[:n], v.ids.get(unit[:n])
        ways = [] if i is None else [(v.scores[i], (i,))]
        if n == 1 and i is None:
            ways.append((v.unknown, tuple(v.bytes_at + b for b in head.encode())))
        out += [(s + t, w + x) for s, w in ways for t, x in brute_segmentations(v, unit[n:])]
    return out


@pytest.mark.parametrize("unit", ["▁the", "▁▁▁river", "▁ünder", "日本x", "▁a\nb", "▁"])
def test_n_best(vocabulary, unit):
    want = sorted((s for s, _ in brute_segmentations(vocabulary, unit)), reverse=True)[:6]
    got = vocabulary.n_best(unit, 6)
    assert [s for s, _ in got] == want and len({p for _, p in got}) == len(got)


def test_segmented_text(vocabulary):
    text = "in ab of it"
    ids, scores, changed, own = vocabulary.text(text, 5)
    assert np.frombuffer(own, "<u4").tolist() == vocabulary.library.encode(text)
    want = sorted((s for s, _ in brute_segmentations(vocabulary, "▁" + text.replace(" ", "▁"))), reverse=True)
    assert scores == want[:5] and changed[0] == []
    assert vocabulary.decode(np.frombuffer(ids, "<u4").tolist()) == text


def test_segmented(awkward, empty, texts_of):
    rows = pieces.segmented(awkward, with_ids=True).collect()
    assert len(rows) == len(texts_of) and all(r.round_trip for r in rows)
    assert all(len(r.ids) == 4 * r.n_pieces and list(r.scores) == sorted(r.scores, reverse=True) for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (2, 3)} == {0}
    assert pieces.segmented(empty).count() == 0


@pytest.mark.parametrize("unit", ["▁river,", "▁a\nb", "▁Shtint$$$", "▁éreé.&&&"])
def test_parts_of_a_unit(vocabulary, unit):
    (score, ids), (second, _) = vocabulary.n_best(unit, 2)
    own, total, loss, n = vocabulary._unit(unit)
    assert (total, loss, n) == (score, score - second, len(ids)) and own == np.array(ids, "<u4").tobytes()


def test_forward_pass_of_many_units(vocabulary):
    """The common pass gives what the search gives unit by unit."""
    r = random.Random(11)
    units = ["▁" * r.randint(0, 2) + "".join(r.choice("aeinrstlhd,.é日\n\U0001f600$") for _ in range(r.randint(1, 14)))
             for _ in range(400)] + ["▁river,", "x", "▁", "▁▁▁"]
    ids, sizes, scores, losses = vocabulary.forward(units)
    ends = np.cumsum(sizes)
    for unit, end, n, score, loss in zip(units, ends, sizes, scores, losses, strict=True):
        ways = vocabulary.n_best(unit, 2)
        assert (score, tuple(ids[end - n:end])) == ways[0]
        assert loss == (ways[0][0] - ways[1][0] if len(ways) > 1 else np.inf)


def test_library_and_number_of_pieces(vocabulary, texts_of, sample, monkeypatch):
    """The own rules' ids are the library's; the search takes one piece in fifty more at most."""
    monkeypatch.setattr(vocabulary, "cached", 300)
    texts = [t for _, t in texts_of] + [r.text or "" for r in sample.collect()]
    found = [vocabulary.text(t, 2) for t in texts]
    assert [np.frombuffer(own, "<u4").tolist() for *_, own in found] == [vocabulary.library.encode(t) for t in texts]
    assert sum(len(ids) for ids, *_ in found) <= 1.02 * sum(len(own) for *_, own in found)
    the = "".join(vocabulary.names[i] + " " for i in np.frombuffer(vocabulary.text("the river", 1)[0], "<u4"))
    assert the == "▁the ▁river "


def test_unit_of_one_repeated_letter(vocabulary):
    got = vocabulary.n_best("a" * 20_001, 3)
    assert len({p for _, p in got}) == 3 and got[0][0] >= got[1][0] >= got[2][0]


def test_letters_and_grams():
    assert [language.letters_of(p.encode()) for p in ("Don't!", "12%", "ÄB", "")] == ["dont", "", "äb", ""]
    ids, sizes, scripts = language.grams(["ab", "мир", "x" * 90])
    assert sizes.tolist() == [6, 8, 82] and len(ids) == 96 and scripts.tolist() == [1, 3, 1]
    again = language.grams(["x" * 90, "ab"])[0]  # a word's grams don't hang on its neighbours
    assert sorted(again[82:]) == sorted(ids[:6]) and sorted(again[:82]) == sorted(ids[14:])


def test_chunks():
    word = "x" * 90 + "мир" + "ab" + "об\u02bcєкт" + "日本" + "ア" * 41
    assert language.chunks(word) == ["x" * 40, "x" * 40, "x" * 10, "мир", "ab", "об\u02bcєкт", "日本", "ア" * 40, "ア"]
    assert language.chunks("") == [] and language.chunks("été") == ["été"]


def test_language_of_unspaced_text(spark):
    """Each letter of a long run counts, for the label and in training; a change within it is a span."""
    r = random.Random(5)

    def run(letters, n):
        return "".join(r.choice(letters) for _ in range(n))

    training = spark.createDataFrame([(run("abcdef", 400), "aa") for _ in range(8)]
                                     + [("z" * 40 + run("ghijkl", 400), "gg") for _ in range(8)]
                                     + [(run("日本語中文字", 400), "zh") for _ in range(8)], "text string, lang string")
    asked = spark.createDataFrame([(1, "abc " + run("abcdef", 80) + run("ghijkl", 4920)), (2, run("ghijkl", 400)),
                                   (3, run("abcdef", 120) + run("日本語中文字", 400) + " 日本")], "doc_id long, text string")
    rows = {x.doc_id: x for x in language.identified(asked, training).collect()}
    assert [tuple(s) for s in rows[1].spans] == [("aa", 0, 2, 0, 83), ("gg", 1, 1, 80, 4920)]
    assert (rows[1].lang_pred, rows[1].score) == ("gg", 4920 / 5003)
    assert [tuple(s) for s in rows[2].spans] == [("gg", 0, 1, 0, 400)]
    assert [tuple(s) for s in rows[3].spans] == [("aa", 0, 1, 0, 120), ("zh", 0, 2, 120, 402)]


def test_scripts_leave_candidates(spark):
    """A script's words go to languages that use it, whatever the cost of a change."""
    training = spark.createDataFrame(
        [("hello there my world of rain and stone", "en"), ("привет мир дорогой друг и вода", "ru"),
         ("γεια σου κόσμε και νερό", "el")] * 3, "text string, lang string")
    texts = ["hello there мир дорогой world", "hello there привет мир дорогой друг world", "мир world κόσμε"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.lang, s.first, s.n) for s in r.spans] for r in language.identified(docs, training).collect()}
    assert found == {0: [("en", 0, 2), ("ru", 2, 2), ("en", 4, 1)], 1: [("en", 0, 2), ("ru", 2, 4), ("en", 6, 1)],
                     2: [("ru", 0, 1), ("en", 1, 1), ("el", 2, 1)]}


def test_training_sample_holds_its_bound(spark):
    """Copies count once, and a large language leaves a small one its share."""
    rows = [("one text that comes again and again", "en")] * 3000 + [(f"text number {i} of many", "en") for i in range(500)]
    rows += [(f"ein kleiner satz {i}", "de") for i in range(7)] + [(None, "en"), ("no language", None)]
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, h long, rank int").repartition(5)
    got = [tuple(r) for r in language.training_sample(table, 153).collect()]
    assert len(got) == len(set(got)) == 153
    assert sum(lang == "de" for lang, _ in got) == 7
    assert language.training_sample(table.where("false"), 153).count() == 0
    assert len(language.learned(table, 20).languages) == 2
    assert language.learned(table, 20).common == 1


def test_only_one_language(spark):
    training = spark.createDataFrame([("some words here", "en")], "text string, lang string")
    docs = spark.createDataFrame([(1, "words"), (2, "мир")], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identified(docs, training).collect()}
    assert got == {1: ("en", 1.0), 2: ("en", 0.0)}
