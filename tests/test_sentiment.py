import pytest
from pyspark.sql import functions as F

from murmuration.functions import lexicon
from murmuration.operators.sentiment import count_values, with_sentiment


def score(spark, cleaned, emojis=()):
    df = spark.createDataFrame([(cleaned, list(emojis))], "content_clean string, emojis array<string>")
    row = with_sentiment(df).first()
    return row["sentiment_score"], row["sentiment_label"]


@pytest.mark.parametrize(
    "cleaned, emojis, expected, label",
    [
        ("surge and uptrend on volume", ["🟢"], 1.0, "bullish"),
        ("gap down, then more downside", ["💀"], -1.0, "bearish"),
        ("monsoon update at noon", [], 0.0, "neutral"),
        ("short from the open", [], -1.0, "bearish"),
        ("buy buy buy sell", [], 0.0, "neutral"),
        ("generally fine weather along the way", [], 1.0, "bullish"),
        ("closed over its resistance", [], -1.0, "bearish"),
        ("quiet", ["❤", "🔥"], 1.0, "bullish"),
        ("quiet", ["🚀", "🚀", "🔴"], 1 / 3, "bullish"),
        # -0.2 is still bearish, 0.2 still neutral
        ("buy", ["🚀", "🔴", "🔴", "🔴"], -0.2, "bearish"),
        ("sell", ["🔴", "🚀", "🚀", "🚀"], 0.2, "neutral"),
    ],
)
def test_score_and_label(spark, cleaned, emojis, expected, label):
    got, name = score(spark, cleaned, emojis)
    assert got == pytest.approx(expected)
    assert name == label


def test_value_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "script string")
    assert {tuple(r) for r in count_values(df, "script").collect()} == {("a", 2), ("b", 1)}


def test_terms_are_counted_as_by_contains(spark):
    """Python's search finds what ``lower`` and ``contains`` find, also beside characters that become ASCII letters; the plan tries no term byte by byte."""
    values = ["BULLISH buy BUY", "bullİsh sİgn breaKout breaKdown", "ſell İ ath", "gap  up", "gap up all time high", "Σ dump ΑΣ", "", None]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, content_clean string").withColumn("emojis", F.array().cast("array<string>"))
    lowered = F.lower("content_clean")
    by_contains = [sum((lowered.contains(t).cast("int") for t in terms), F.lit(0)) for terms in (lexicon.BULLISH_TERMS, lexicon.BEARISH_TERMS)]
    hits = lexicon.term_hits(F.col("content_clean"))
    for r in rows.select(hits["bull"].alias("a"), hits["bear"].alias("b"), by_contains[0].alias("c"), by_contains[1].alias("d")).collect():
        assert (r["a"], r["b"]) == (r["c"], r["d"])
    assert "Contains(" not in with_sentiment(rows)._jdf.queryExecution().executedPlan().toString()
