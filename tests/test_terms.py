import math

import pytest

from pyspark.sql import functions as F

from murmuration.config import TermSettings
from murmuration.operators import terms


def texts(spark, *values):
    rows = [(str(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "post_id string, content_clean string")


def test_tokens_skip_digits_underscores_stop_words_and_foreign_letters(spark):
    df = texts(spark, "The index50 RISES and a_b über x rise", None)
    found = {r["post_id"]: r["tokens"] for r in terms.tokenised(df).collect()}
    assert found == {"0": ["rises", "rise"], "1": []}


def test_bigrams_span_removed_stop_words(spark):
    counts = terms.term_counts(texts(spark, "rally of the banks", "x"))
    assert {(r["term"], r["tf"]) for r in counts.collect()} == {
        ("rally", 1), ("banks", 1), ("rally banks", 1),
    }


def test_own_stop_words_and_longer_ngrams(spark):
    df = texts(spark, "one two three four")
    counts = terms.term_counts(df, TermSettings(max_ngram=3), stop_words=["four"])
    assert {r["term"] for r in counts.collect()} == {
        "one", "two", "three", "one two", "two three", "one two three",
    }


def test_vocabulary_needs_two_posts_and_is_capped_by_frequency(spark):
    df = texts(spark, "aa aa bb cc", "aa bb dd", "bb ee")
    vocab = terms.vocabulary_of(terms.term_counts(df), TermSettings(max_features=2, max_ngram=1))
    assert [tuple(r) for r in vocab.collect()] == [("aa", 3, 2), ("bb", 3, 3)]


def test_frequencies_need_no_shuffle_by_post(spark, plan_of):
    df = texts(spark, "aa aa bb cc", "aa bb dd", "bb ee", "")
    found = terms.term_frequencies(df)
    counted = terms.term_counts(df).groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
    assert plan_of(found).count("Exchange") == 1
    assert sorted(found.collect()) == sorted(counted.collect())


def test_weights_have_unit_length_and_smoothed_idf(spark):
    df = texts(spark, "aa aa bb", "aa bb bb", "aa zz")
    weights = {
        (r["post_id"], r["term"]): r["weight"]
        for r in terms.tfidf(df, TermSettings(max_ngram=1)).collect()
    }
    idf_a, idf_b = math.log(4 / 4) + 1, math.log(4 / 3) + 1
    length = math.hypot(2 * idf_a, idf_b)
    assert weights[("0", "aa")] == pytest.approx(2 * idf_a / length)
    assert weights[("0", "bb")] == pytest.approx(idf_b / length)
    assert weights[("2", "aa")] == pytest.approx(1.0)
    assert ("2", "zz") not in weights


def test_top_terms(spark):
    df = texts(spark, "copper price jumps sharply", "copper price falls", "tea auction")
    top = terms.top_terms(terms.tfidf(df), 5).collect()
    assert {r["term"] for r in top} == {"copper", "price", "copper price"}
    assert [r["score"] for r in top] == sorted((r["score"] for r in top), reverse=True)


def test_a_single_post_has_no_terms(spark):
    weights = terms.tfidf(texts(spark, "only one text here one text"), TermSettings(min_df=1))
    assert weights.count() == 0 and terms.top_terms(weights).count() == 0


def test_counting_shuffles_token_arrays_once(spark, plan_of):
    plan = plan_of(terms.term_counts(texts(spark, "a b")))
    assert plan.count("Exchange") == 1
    assert plan.index("Generate") < plan.index("Exchange")


def test_small_vocabulary_is_broadcast(spark, plan_of):
    plan = plan_of(terms.tfidf(texts(spark, "aa bb", "aa bb")))
    assert "BroadcastHashJoin" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_large_vocabulary_is_not(spark, plan_of, monkeypatch):
    monkeypatch.setattr(terms, "MAX_BROADCAST_BYTES", -1)
    weights = terms.tfidf(texts(spark, "aa bb", "aa bb"))
    assert "ResolvedHint" not in weights._jdf.queryExecution().analyzed().toString()
    assert weights.count() == 6


def test_vocabulary_by_buckets_is_that_of_all_terms(spark):
    # words that come often in one post only fill buckets and are no terms
    rows = [(str(i), " ".join([f"w{'abcdefghij'[j]}" for j in range(10) if i % (j + 1) == 0] + [f"only{'abcdefghij'[i % 10]}{'abcdefghij'[i // 10]}"] * 60)) for i in range(100)]
    df = spark.createDataFrame(rows, "post_id string, content_clean string")
    for n in (1, 3, 1000):
        settings = TermSettings(max_features=n)
        expected = terms.most_frequent(terms.term_frequencies(df, settings), settings)
        assert sorted(terms.fitted_vocabulary(df, settings).collect()) == sorted(expected.collect())


def test_terms_outside_the_vocabulary_are_not_counted_by_post(spark, plan_of):
    plan = plan_of(terms.tfidf(texts(spark, "rally of the banks", "rally again")))
    assert "BroadcastHashJoin" in plan[plan.index("HashAggregate(keys=[post_id"):]
