import unicodedata

import pytest
from pyspark.sql import functions as F

from murmuration.functions import text
from murmuration.operators.cleaning import clean_posts



def apply(spark, expression, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, content string")
    return [r[1] for r in df.select("i", expression(F.col("content")).alias("out")).orderBy("i").collect()]


def clean(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, content string")
    return {r["i"]: r["content_clean"] for r in clean_posts(df).collect()}


def test_nfkc_matches_the_standard_for_every_character(spark):
    chars = [chr(c) for c in range(0x20, 0x30000) if unicodedata.category(chr(c)) not in ("Cs", "Cn")]
    chunks = ["x".join(chars[i : i + 500]) for i in range(0, len(chars), 500)] + [None, "plain", ""]
    expected = [t if t is None else unicodedata.normalize("NFKC", t) for t in chunks]
    assert apply(spark, text.nfkc, chunks) == expected


def test_nfkc_examples(spark):
    assert apply(spark, text.nfkc, ["a™", "Ⓜ", "ﬁne", "ａｂ", "é"]) == [
        "aTM", "M", "fine", "ab", "é",
    ]


def test_nfkc_never_creates_an_emoji():
    import regex

    marks = regex.compile(r"[\p{Emoji}\p{Regional_Indicator}\uFE0E\uFE0F\u20E3--[0-9#*]]", regex.V1)
    for c in range(0x80, 0x110000):
        char = chr(c)
        if unicodedata.category(char) != "Cs" and not marks.search(char):
            assert not marks.search(unicodedata.normalize("NFKC", char)), hex(c)


def test_emojis_are_single_code_points_in_order(spark):
    values = ["go 🚀🚀 then 📉", "none", "é only", "❤️‍🔥", "👍🏽", "©2024", "1️⃣ #", "🇮🇳", None]
    assert apply(spark, text.extract_emojis, values) == [
        ["🚀", "🚀", "📉"], [], [], ["❤", "🔥"], ["👍", "🏽"], ["©"], [], [], None or [],
    ]


def test_cleaning_removes_urls_and_emoji_sequences(spark):
    cleaned = clean(
        spark,
        [
            "Copper 🚀 moved 🚀🚀 see https://t.co/q1 later",
            "see www.example.com now",
            "flag 🇮🇳 family 👨‍👩‍👧 key 1️⃣ tone 👍🏽 heart ❤️ end",
            "  spaced \t\n  out　 ",
            "🚀🚀",
            "ab",
            "abc",
            "#tag @user $CASH stay",
            None,
            "बाजार आज",
            "™ and Ⓜ",
        ],
    )
    assert cleaned == {
        0: "Copper moved see later",
        1: "see now",
        2: "flag family key tone heart end",
        3: "spaced out",
        6: "abc",
        7: "#tag @user $CASH stay",
        9: "बाजार आज",
        10: "TM and M",
    }


def test_cleaning_calls_python_once(spark, plan_of):
    df = spark.createDataFrame([("1", "x")], "post_id string, content string")
    plan = plan_of(clean_posts(df))
    assert plan.count("ArrowEvalPython") == 1
    assert "char_length(trim" not in plan.replace(" ", "")


def test_script(spark):
    values = ["सोना महँगा", "gold महँगा", "plain words", "été", "।"]
    assert apply(spark, text.script_of, values) == [
        "devanagari", "devanagari_mixed", "latin", "latin", "devanagari",
    ]


def test_cashtags_need_two_to_ten_letters_and_a_boundary(spark):
    values = ["$NIFTY $a $ABCDEFGHIJK $bank. $SBI_X $tcs$INFY $abé", "no dollar"]
    assert apply(spark, text.cashtags, values) == [["nifty", "bank", "tcs", "infy"], []]


def test_entities_keep_order_and_repeats(spark):
    values = ["#Nifty50 @User_1 #BANK #nifty50", "#बाजार", "plain"]
    assert apply(spark, text.hashtags, values) == [["nifty50", "bank", "nifty50"], ["ब"], []]
    assert apply(spark, text.mentions, values) == [["user_1"], [], []]


def test_reply_flag_ignores_leading_space(spark):
    assert apply(spark, text.is_reply, ["@a hi", " \n @a", "hi @a", ""]) == [
        True, True, False, False,
    ]


def test_comparable_text(spark):
    values = ["Buy NOW!!! 🚀 https://t.co/x  then", "A  b\tc", "🚀🚀", "don't_stop", "x - y"]
    assert apply(spark, text.comparable_text, values) == [
        "buy now then", "a b c", "", "don t_stop", "x y",
    ]


def test_labels_and_links(spark):
    labels = ["1,234 Likes. Like", "Reply", "12 replies, 7 more", ",", "१२ likes", None]
    assert apply(spark, text.count_from_label, labels) == [1234, 0, 12, 0, 12, 0]
    links = ["/a/status/99?s=20", "https://h/b/status/7", "/a/photo/1", None]
    assert apply(spark, text.post_id_from_link, links) == ["99", "7", None, None]


@pytest.mark.parametrize("symbol", ["🚀", "☎", "〰", "㊗", "🥲", "🫨"])
def test_emoji_class_holds_typical_members(spark, symbol):
    assert apply(spark, text.extract_emojis, [f"a{symbol}b"]) == [[symbol]]


def test_nfkc_brings_back_only_changed_texts():
    """A worker holds no second copy of a batch: texts that are in the form already return as null."""
    import pyarrow as pa

    wrapped = {}
    udf, text_module = F.arrow_udf, text
    try:
        F.arrow_udf = lambda kind: lambda f: wrapped.setdefault("f", f) and (lambda c: c)
        text_module.nfkc(F.lit("x"))
    finally:
        F.arrow_udf = udf
    assert wrapped["f"](pa.array(["é", "ﬁ", None, "शेयर"])).to_pylist() == [None, "fi", None, None]


def test_one_cleaning_pass_equals_its_steps(spark):
    """Every sequence of odd characters comes out as from the four separate expressions; the plan has no other regular expression."""
    import random

    odd = ["a", "1", "#", " ", "  ", "\n", "\x1c", "\x85", "\xa0", " ", "　", "​", "⃣", "️", "︎", "‍", "🇮", "🇳", "🏴", "\U000e0067", "\U000e007f",
           "❤", "🔥", "👍", "🏽", "©", "™", "ﬁ", "ｈｔｔｐ", "http", "www.", "ｗｗｗ.", "é", "é", "İ", "K", "शे", "漢"]
    chosen = random.Random(3)
    values = ["".join(chosen.choices(odd, k=chosen.randint(0, 12))) for _ in range(4000)] + [None, ""]

    def steps(content):
        guard = text.may_have_emoji(content)
        return text.squeeze_space(text.strip_emoji(text.strip_urls(text.nfkc(content)), guard))

    assert apply(spark, lambda c: text.cleaned(c)["clean"], values) == apply(spark, steps, values)
    assert apply(spark, lambda c: text.cleaned(c)["near_emoji"], values) == apply(spark, text.may_have_emoji, values)
    rows = spark.createDataFrame([(1, "x")], "i int, content string")
    plan = clean_posts(rows).select("content_clean")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp_replace" not in plan
