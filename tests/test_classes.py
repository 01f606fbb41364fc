"""Character classes that are spelled out for speed, against the ones that decide the results."""

import random

from pyspark.sql import functions as F

from pairmill.functions import fixed, scoring, text
from pairmill.operators import filters
from pairmill.settings import Settings


def test_every_character(spark):
    chars = spark.range(1, 0x20000).where("id not between 55296 and 57343").select(
        F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    ours = [(text.SPACE, f"[{fixed.SPACE}]"), (text._NO_SPACE, f"[^{fixed.SPACE}]"),
            (text._TOKEN, fixed.TOKEN), (f"[{text.one_of('az09')}]", "[a-z0-9]")]
    assert chars.count() == 0x20000 - 1 - 2048
    for new, old in ours:
        assert chars.where(F.col("c").rlike(new) != F.col("c").rlike(old)).count() == 0
    steps = [(text.strip_zero_width, lambda c: F.regexp_replace(c, fixed.ZERO_WIDTH, " ")),
             (text.strip_emoji, lambda c: F.regexp_replace(c, fixed.EMOJI, " ")),
             (text.plain_quotes, lambda c: F.translate(c, "’‘“”–—", "''\"\"--"))]
    for new, old in steps:
        assert chars.where(new(F.concat(F.lit("a"), "c")) != old(F.concat(F.lit("a"), "c"))).count() == 0


def test_random_texts(spark):
    rng = random.Random(4)
    letters = ["a", "b", "-", "'", "’", "1", "23", ".", ",", "!", "<", ">", "_", " ", "\t", "　", "\xa0", "é", "&", "w", "W"]
    rows = [("".join(rng.choice(letters) for _ in range(rng.randint(0, 30))),) for _ in range(3000)]
    df = spark.createDataFrame(rows, "c string")
    old_squeeze = F.trim(F.regexp_replace("c", f"[{fixed.SPACE}]+", " "))
    assert df.where(text.squeeze(F.col("c")) != old_squeeze).count() == 0
    assert df.where(text.tokenize(F.col("c")) != F.regexp_extract_all("c", F.lit(fixed.TOKEN), F.lit(0))).count() == 0
    assert df.where(text.mask_urls(F.col("c")) != F.regexp_replace("c", fixed.URL, " <url> ")).count() == 0
    assert df.where(text.collapse_punctuation(F.col("c")) != F.regexp_replace("c", fixed.PUNCT_RUN, "$1")).count() == 0
    slotted = text.slot_reference_numbers(text.tokenize(F.col("c")), F.col("c"))
    assert df.where(text.query_tokens(F.col("c")) != slotted).count() == 0
    old = F.concat(F.lit(" "), F.replace("c", F.lit("&amp;"), F.lit("&")), F.lit(" "))
    for pattern, by in ((r"([\{-~\[-`!-&\(-\+:-@/])", " $1 "), (r"([^0-9])([.,])", "$1 $2 "),
                        (r"([.,])([^0-9])", " $1 $2"), (r"([0-9])(-)", "$1 $2 ")):
        old = F.regexp_replace(old, pattern, by)
    assert df.where(scoring.tokens_13a(F.col("c")) != F.regexp_extract_all(
        old, F.lit(f"[^{fixed.SPACE}]+"), F.lit(0))).count() == 0


def test_word_counts(spark):
    rows = [(" ".join("a" * n), " ".join("b" * m)) for n in range(0, 35) for m in range(0, 6)]
    df = spark.createDataFrame(rows, "query_clean string, response_clean string")
    kept = df.where(filters.proper_length()).collect()
    s = Settings()
    assert {(r[0], r[1]) for r in kept} == {
        (q, r) for q, r in rows if s.min_query_words <= len(q.split()) <= s.max_query_words
        and len(r.split()) >= s.min_reply_words}


def test_table_classes():
    """Ranges inside a class are a call each; the hot classes have none below the table."""
    assert "-" not in text.one_of("az") and not text.SPACE.startswith(r"[\t-") and text.SPACE.startswith(r"[\x09\x0a")
