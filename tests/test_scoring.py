"""Metrics against hand-worked rows and plain brute force."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairmill.functions import arrays, scoring
from pairmill.operators import lm, metrics
from pairmill.plans.evaluate import top_replies


def grams(items, n):
    return [tuple(items[i:i + n]) for i in range(len(items) - n + 1)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], (prev + 1 if x == y else max(row[j + 1], row[j]))
    return row[-1]


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(5)
    words = ["a", "bb", "c.", "dd,", "e", "f-1", "\U0001F600x"]
    out = [([rng.choice(words) for _ in range(rng.randint(0, 25))],
            [rng.choice(words) for _ in range(rng.randint(0, 25))]) for _ in range(60)]
    return out + [([], []), (["a"] * 9, ["a"] * 4)]


def test_clipped_matches(values, pairs):
    for n in (1, 2, 3):
        got = values(lambda a, b: arrays.clipped_matches(
            arrays.ngram_keys(a, n), arrays.ngram_keys(b, n)), pairs, "a array<string>, b array<string>")
        assert got == [sum((Counter(grams(a, n)) & Counter(grams(b, n))).values()) for a, b in pairs]


def test_char_ngrams(values, pairs):
    texts = ["".join(a) for a, _ in pairs]
    for n in (1, 2, 6):
        got = values(lambda c: arrays.char_ngrams(c, n), texts)
        assert got == [["".join(g) for g in grams(t, n)] for t in texts]


def test_lcs(values, pairs):
    got = values(scoring.lcs_length, pairs, "a array<string>, b array<string>")
    assert got == [lcs(a, b) for a, b in pairs]


def test_tokens_13a(values):
    rows = [("Hello, world. It costs 3.50-4, ok?", "Hello , world . It costs 3.50 - 4 , ok ?"),
            ("<ph_x> &quot;a&amp;b&quot;", '< ph _ x > " a & b "'),
            ("end-\nof line<skipped>", "endof line"), ("", "")]
    assert values(scoring.tokens_13a, [r for r, _ in rows]) == [w.split() for _, w in rows]


def score_frame(spark, rows):
    df = spark.createDataFrame([("s", h, r) for h, r in rows], "strategy string, hyp string, ref string")
    return df, metrics.row_scores(df)


def test_bleu_by_hand(spark):
    _, scores = score_frame(spark, [("the cat sat on mat", "the cat sat on the mat")])
    # matches 5/5, 3/4, 2/3, 1/2; brevity exp(1 - 6/5)
    want = 100 * math.exp(1 - 6 / 5) * math.exp(
        (math.log(1) + math.log(3 / 4) + math.log(2 / 3) + math.log(1 / 2)) / 4)
    row = metrics.corpus_bleu(scores, ["strategy"]).first()
    assert row.bleu == pytest.approx(want)
    assert [row.p1, row.p2, row.p3, row.p4] == pytest.approx([100, 75, 200 / 3, 50])


def test_bleu_smoothing_and_edges(spark):
    _, scores = score_frame(spark, [("a b c d e", "a x b y c")])
    # 3/5, then 0 of 4, 3, 2 -> 1/(2*4), 1/(4*3), 1/(8*2)
    want = 100 * math.exp(sum(map(math.log, [3 / 5, 1 / 8, 1 / 12, 1 / 16])) / 4)
    assert metrics.corpus_bleu(scores, ["strategy"]).first().bleu == pytest.approx(want)
    _, short = score_frame(spark, [("a b", "a b")])
    assert metrics.corpus_bleu(short, ["strategy"]).first().bleu == 0.0
    assert metrics.mean_sentence_bleu(short, ["strategy"]).first().sentence_bleu == pytest.approx(100)
    _, none = score_frame(spark, [("x y", "a b"), ("", "a")])
    assert metrics.mean_sentence_bleu(none, ["strategy"]).first().sentence_bleu == 0.0


def test_identity_scores(spark):
    text = "We will refund the order within five days, promise."
    df, scores = score_frame(spark, [(text, text)])
    report = {r.metric: r.value for r in metrics.report(df, scores).collect()}
    assert report == {r.metric: r.value for r in metrics.report(df).collect()}
    for name in ("bleu", "sentence_bleu", "chrf", "p4"):
        assert report[name] == pytest.approx(100)
    for name in ("rouge1", "rouge2", "rougeL", "distinct_1"):
        assert report[name] == 1.0
    assert report["unique_responses"] == 1 and report["repeated_response_rate"] == 0


def test_chrf_by_brute_force(spark):
    rows = [("abc abd", "abd abc x"), ("zz", "z"), ("", "q")]
    _, scores = score_frame(spark, rows)
    p = r = k = 0
    for n in range(1, 7):
        m = h = f = 0
        for hyp, ref in rows:
            a, b = (Counter(grams(x.replace(" ", ""), n)) for x in (hyp, ref))
            m += sum((a & b).values())
            h += sum(a.values()) if b else 0
            f += sum(b.values())
        if h and f:
            p, r, k = p + m / h, r + m / f, k + 1
    p, r = p / k, r / k
    got = metrics.corpus_chrf(scores, ["strategy"]).first().chrf
    assert got == pytest.approx(100 * 5 * p * r / (4 * p + r))


def test_rouge(spark):
    df, scores = score_frame(spark, [("The cat, the DOG", "the dog the cat sat")])
    row = metrics.mean_rouge_n(scores, ["strategy"]).first()
    assert row.rouge1 == pytest.approx(8 / 9) and row.rouge2 == pytest.approx(4 / 7)
    assert metrics.rouge_l(df).first().rougeL == pytest.approx(2 * 2 / 9)


def test_distinct_and_genericity(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b"],), ([],)], "t array<string>")
    assert metrics.distinct_n(df, "t", 2).first()[0] == pytest.approx(2 / 3)
    assert metrics.distinct_n(df, "t", 9).first()[0] == 0.0
    replies = spark.createDataFrame([("x",), ("X ",), ("y",)], "r string")
    row = metrics.genericity(replies, "r").first()
    assert (row.unique_responses, row.repeated_response_rate) == (2, 0.6667)
    assert [tuple(r) for r in metrics.most_common(replies, "r", 1).collect()] == [(2, "x")]


def test_repeat_rules(spark, values):
    assert values(lambda a: arrays.repeat_completions(a, 3), [([5, 6, 7, 5, 6],), ([1, 2],)],
                  "a array<int>") == [[7], []]
    assert values(lambda a: arrays.repeat_completions(a, 1), [([5, 6],)], "a array<int>") == [[5, 6]]
    assert values(lambda a: arrays.has_repeat(a, 2), [([1, 2, 1, 2],), ([1, 2, 3],)],
                  "a array<int>") == [True, False]


def test_ids(values):
    kind = "a array<int>"
    assert values(arrays.until_eos, [([1, 7, 9, 2, 0, 0],), ([7, 0],)], kind) == [[7, 9], [7]]
    assert values(lambda a: arrays.frame_ids(a, 5), [([4, 5, 6, 7, 8],), ([],)], kind) == [
        [1, 4, 5, 6, 2], [1, 2, 0, 0, 0]]
    assert values(lambda a: arrays.frame_ids(a, 3, False, False), [([4],)], kind) == [[4, 0, 0]]
    assert values(arrays.decoder_input, [([1, 4, 2],)], kind) == [[1, 4]]
    assert values(arrays.decoder_labels, [([1, 4, 2],), ([],)], kind) == [[4, 2], []]


def test_reply_model(spark):
    train = spark.createDataFrame([(["a", "b"],), (["a", "c"],)], "response_tokens array<string>")
    model = lm.train_reply_model(train, weight=0.5)
    # words: a2 b1 c1 <eos>2 -> 6 tokens, 4 types + <unk>
    assert (model.total, model.types) == (6, 5)
    df = spark.createDataFrame([(1, ["a", "zzz"])], "row_id bigint, response_tokens array<string>")
    got = {r.pos: r.logprob for r in lm.reply_logprobs(df, model).collect()}
    assert got[0] == pytest.approx(math.log(0.5 * 2 / 2 + 0.5 * 3 / 11))
    assert got[1] == pytest.approx(math.log(0.5 * 1 / 11))
    assert got[2] == pytest.approx(math.log(3 / 11))
    mean = lm.mean_reply_logprob(df, model).first().avg_logprob
    assert mean == pytest.approx(sum(got.values()) / 3)
    ppl = lm.corpus_perplexity(df, model, ["row_id"]).first()
    assert ppl.perplexity == pytest.approx(math.exp(-mean)) and ppl.n_tokens == 3


def test_model_probabilities_sum_to_one(spark):
    train = spark.createDataFrame([(["a", "b", "a"],), (["b"],)], "response_tokens array<string>")
    model = lm.train_reply_model(train)
    words = ["a", "b", "<eos>", "unseen"]
    grams_ = spark.createDataFrame([(v, w) for v in ["<sos>", "a", "b", "never"] for w in words],
                                   "v string, w string")
    sums = lm.score_bigrams(grams_, model).groupBy("v").agg(F.sum(F.exp("logprob")).alias("s"))
    assert [r.s for r in sums.collect()] == pytest.approx([1.0] * 4)


def test_most_common_by_group(spark):
    rows = [("a", " Yes "), ("a", "yes"), ("a", "no"), ("a", "b"), ("b", "No"), ("b", None), ("b", None)]
    df = spark.createDataFrame(rows, "strategy string, hyp string")
    got = sorted(map(tuple, top_replies(df, 2).collect()))
    assert got == [("a", 1, 2, "yes"), ("a", 2, 1, "b"), ("b", 1, 2, None), ("b", 2, 1, "no")]
    assert top_replies(df.where("false")).count() == 0
