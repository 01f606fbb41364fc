"""Hand-worked rows for the text operators, one group per step."""

import pytest
from pyspark.sql import functions as F

from pairmill.functions import fixed, text

SLOTS = {"Order Number": "<ph_order_number>", "Invoice Number": "<ph_invoice_number>"}


QUERIES = [
    ("<p>Where is my order 4471902?</p>", "where is my order <ph_order_number> ?"),
    ("There is a wrong charge on my invoice 88231",
     "there is a wrong charge on my invoice <ph_invoice_number>"),
    ("pls help me track my parcel AB-99213",
     "please help me track my parcel ab - <ph_tracking_number>"),
    ("i want a refund of 12345 now", "i want a refund of <ph_refund_amount> now"),
    ("cancel purchase370795561790", "cancel purchase <ph_order_number>"),
    ("cancel order 100000", "cancel order 100"),
    ("24/7 for 30 days", "24 / 7 for 30 days"),
    ("my {{Order Number}} and {{ Unknown Thing }}!", "my <ph_order_number> and <ph_details> !"),
    ("user info?", "user info ?"),
    ("u guys cant", "you guys can not"),
    ("", ""),
    ("   ​ ", ""),
    ("already <ph_order_number> here", "already <ph_order_number> here"),
    ("don’t step-by-step café", "don't step-by-step caf é"),
]


def test_prepare_query(values):
    got = values(lambda c: text.prepare_query(c, SLOTS), [raw for raw, _ in QUERIES])
    assert got == [tokens.split() for _, tokens in QUERIES]


CLEANED = [
    ("Heyyy!!! ???", "heyy! ?"),
    ("see https://shop.example.com/a?b=1, thx", "see <url> thx"),
    ("WWW.Example.com now", "<url> now"),
    ("mail jo.doe+x@mail.co.uk. ok", "mail <email> . ok"),
    ("hi @sam and é@sam", "hi <user> and é@sam"),
    ("@a @ab", "@a <user>"),
    ("#refund x#y", "refund x#y"),
    ("bad \U0001F621\U0001F621 day ☀", "bad day"),
    ("a <b>c</b> <ph_x> <url> <script src='0123456789012345678901234567890123456789'>",
     "a c <ph_x> <url> <script src='0123456789012345678901234567890123456789'>"),
    ("“Hi” – it’s", '"hi" - it\'s'),
    ("tab\tand nbsp line", "tab and nbsp line"),
    ("a.@b2 a_@b2", "a. <user> a_@b2"),
]


def test_clean_text(values):
    got = values(lambda c: text.clean_text(c, SLOTS), [raw for raw, _ in CLEANED])
    assert got == [cleaned for _, cleaned in CLEANED]


def test_chat_words_only_on_request(value):
    assert value(lambda c: text.clean_text(c), c="pls u") == "pls u"
    assert value(lambda c: text.clean_text(c, chat=True), c="pls u") == "please you"


AUTOMATED = [
    ("This is an automated message, please do not reply to this email.", True),
    ("Your ticket has been created automatically. Out of office until Monday.", True),
    ("AUTOGENERATED RESPONSE", True),
    ("I understand you would like to cancel your order.", False),
]


def test_automated(values):
    got = values(text.is_automated, [raw for raw, _ in AUTOMATED])
    assert got == [flag for _, flag in AUTOMATED]


@pytest.mark.parametrize("tokens, limit, kept", [
    ("a . b c", 3, "a ."), ("a b c d", 3, "a b c"), ("a b", 3, "a b"),
    ("a ! b ? c d", 5, "a ! b ?"),
])
def test_truncate(value, tokens, limit, kept):
    out = value(lambda t: text.truncate_at_sentence(t, limit), t=tokens.split())
    assert out == kept.split()


SLUGS = [
    ("Order Number", "<ph_order_number>"), ("  A--b c ", "<ph_a_b_c>"),
    ("§§", fixed.GENERIC_SLOT), ("", fixed.GENERIC_SLOT),
]


def test_slug(values):
    got = values(text.slug, [name for name, _ in SLUGS])
    assert got == [slot for _, slot in SLUGS]


def test_slots_need_no_map(value):
    assert value(lambda c: text.apply_slots(c, None), c="x{{A}}y") == "x <ph_details> y"


def test_content_words(value):
    toks = ["the", "order", "is", "ab", "don't", "refund", "?", "order", "<ph_x>"]
    assert value(text.content_words, t=toks) == ["order", "refund", "order"]


def test_reference_slot_needs_a_word_start(value):
    assert value(text.reference_slot, c="handbill 123") == fixed.ORDER_SLOT
    assert value(text.reference_slot, c="my Billing") == fixed.INVOICE_SLOT
    assert value(text.reference_slot, c="money back please") == fixed.REFUND_SLOT


def test_reference_numbers_with_dashes(value):
    out = value(lambda t: text.slot_reference_numbers(t, F.lit("order")),
                t=["#12-34", "123", "12-3", "-1234-", "x1234"])
    assert out == [fixed.ORDER_SLOT, "123", "12-3", fixed.ORDER_SLOT, "x1234"]


def test_words_and_lines(value):
    assert value(text.words, c="  a  b\n") == ["a", "b"]
    assert value(text.word_count, c="") == 0
    assert value(text.lines, c=" a \n\n b\r\n") == ["a", "b"]


def test_fixed_lists():
    assert len(fixed.CHAT_WORDS) == 50
    assert len(set(fixed.STOPWORDS)) == 137


def test_slot_map_size_changes_no_result(spark):
    """As a constant or through a join, and beyond the constant's bound, slots stay typed."""
    from dataclasses import replace

    from pairmill.operators import slots
    from pairmill.plans.prepare import clean_pairs
    from pairmill.settings import Settings

    rows = [(i, f"my {{{{Slot {i % 1001}}}}} is late", f"your {{{{Slot {i % 7}}}}} came") for i in range(2002)]
    pairs = spark.createDataFrame(rows, "row_id long, query string, response string")
    mapping = slots.slot_map(pairs, ["query", "response"], min_freq=2).cache()
    got = [sorted(tuple(r) for r in clean_pairs(pairs, mapping, replace(Settings(), literal_entries=n))
                  .select("row_id", "query_clean", "response_clean").collect()) for n in (0, 1000, 1001)]
    assert got[0] == got[1] == got[2]
    assert not any("ph_details" in r[1] for r in got[0])


def test_staging_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from pairmill.sources.staging import shared_dir

    def session(master, folder=None, given=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(
            master=master, applicationId="app-1", getCheckpointDir=lambda: given))

    assert shared_dir(session("yarn", "hdfs:///a/")) == "hdfs:///a"
    assert shared_dir(session("yarn", None, "hdfs:///b")) == "hdfs:///b"
    assert shared_dir(session("local[4]"))
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(ValueError):
            shared_dir(session(master))
