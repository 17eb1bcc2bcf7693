import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from murmuration.config import SignalSettings
from murmuration.operators import signal

SCHEMA = "primary_hashtag string, timestamp timestamp, engagement_score bigint, sentiment_score double"


def at(minute, hour=10):
    return datetime(2024, 1, 1, hour, minute)


def build(spark, rows, settings=None):
    out = signal.build_signal(spark.createDataFrame(rows, SCHEMA), settings)
    return out.orderBy("symbol", "window_start").collect()


def test_weighted_mean_and_thin_interval(spark):
    rows = [("a", at(1), 10, 1.0), ("a", at(14), 0, -1.0), ("a", at(3), 99, 0.5)]
    (row,) = build(spark, rows)
    w = [math.log1p(10), 0.0, math.log1p(99)]
    mean = (w[0] * 1.0 + w[2] * 0.5) / sum(w)
    margin = 0.6 * (1 - 3 / 20) + 0.15
    assert row["window_start"] == at(0)
    assert row["sentiment_signal"] == pytest.approx(mean)
    assert row["ci_lower"] == pytest.approx(max(mean - margin, -1))
    assert row["ci_upper"] == pytest.approx(min(mean + margin, 1))
    assert (row["tweet_count"], row["total_engagement"]) == (3, 109)
    # A single bucket has no baseline.
    assert row["volume_rolling_mean"] is None and row["volume_zscore"] == 0.0
    assert row["composite_score"] == pytest.approx(0.6 * mean)


@pytest.mark.parametrize("n", [19, 20])
def test_interval_switches_at_twenty(spark, n):
    scores = [1.0 if i % 2 else -1.0 for i in range(n)]
    (row,) = build(spark, [("a", at(2), 7, s) for s in scores])
    mean = sum(scores) / n
    variance = sum((s - mean) ** 2 for s in scores) / n
    margin = 0.6 * (1 - n / 20) + 0.15 if n < 20 else 1.6448536269514722 * math.sqrt(variance / n)
    assert row["ci_upper"] - row["sentiment_signal"] == pytest.approx(margin)


@pytest.mark.parametrize("n", [3, 25])
def test_all_zero_engagement_falls_back_to_the_plain_mean(spark, n):
    (row,) = build(spark, [("a", at(2), 0, 1.0)] + [("a", at(2), -5, 0.0)] * (n - 1))
    assert row["sentiment_signal"] == pytest.approx(1 / n)
    assert row["ci_lower"] < row["sentiment_signal"] < row["ci_upper"]


def test_volume_baseline_covers_eight_non_empty_buckets(spark):
    counts = [1, 2, 3, 4, 5, 6, 7, 8, 20]
    rows = [("a", at(0, hour=h), 1, 0.0) for h, c in enumerate(counts) for _ in range(c)]
    out = build(spark, rows)
    window = counts[1:]
    mean = sum(window) / 8
    std = math.sqrt(sum((c - mean) ** 2 for c in window) / 7)
    assert out[-1]["volume_rolling_mean"] == pytest.approx(mean)
    assert out[-1]["volume_rolling_std"] == pytest.approx(std)
    assert out[-1]["volume_zscore"] == pytest.approx((20 - mean) / std)
    assert out[-1]["composite_score"] == pytest.approx(0.4 * math.tanh((20 - mean) / std / 3))
    assert all(abs(r["volume_zscore"]) <= 7 / math.sqrt(8) + 1e-9 for r in out)


def test_constant_volume_has_no_anomaly(spark):
    out = build(spark, [("a", at(0, hour=h), 1, 0.3) for h in range(5)])
    assert [r["volume_zscore"] for r in out] == [0.0] * 5


def test_rows_without_symbol_or_time_are_left_out(spark):
    rows = [(None, at(1), 1, 0.0), ("a", None, 1, 0.0), ("a", at(1), 1, 0.0)]
    assert len(build(spark, rows)) == 1


def test_bucket_length_must_divide_a_day(spark):
    with pytest.raises(ValueError):
        build(spark, [("a", at(1), 1, 0.0)], SignalSettings(bucket_minutes=7))


def test_latest_and_frame(spark):
    rows = [("a", at(0, hour=h), 1, 0.0) for h in range(3)] + [("b", at(5), 1, 1.0)]
    built = signal.build_signal(spark.createDataFrame(rows, SCHEMA))
    latest = {r["symbol"]: r["window_start"] for r in signal.latest_per_symbol(built).collect()}
    assert latest == {"a": at(0, hour=2), "b": at(0)}
    assert signal.signal_frame(built, "b").count() == 1
    assert signal.signal_frame(built).count() == 4


def test_one_shuffle_for_buckets_and_partial_sums(spark, plan_of):
    df = spark.createDataFrame([("a", at(1), 1, 0.0)], SCHEMA)
    plan = plan_of(signal.bucket_sentiment(df))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan[plan.index("Exchange") :]


def test_result_does_not_depend_on_partitions(spark):
    rows = [("a", at(i % 60), i, (i % 5 - 2) / 2) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    results = []
    for n in (1, 7):
        out = signal.build_signal(df.repartition(n))
        doubles = [F.round(c, 9).alias(c) for c in out.columns[2:]]
        results.append(sorted(map(tuple, out.select("symbol", "window_start", *doubles).collect())))
    assert results[0] == results[1]
