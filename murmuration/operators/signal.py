"""Time-bucketed signal per symbol: weighted sentiment, interval, volume anomaly, composite."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmuration.config import DEFAULT, SignalSettings
from murmuration.functions import stats

MINUTES_PER_DAY = 24 * 60


#: What a bucket's state adds up, next to its symbol and start.
STATE_SUMS = ("n", "total_engagement", "sw", "sws", "swss", "ss", "sss")


def bucket_states(
    scored: DataFrame,
    settings: SignalSettings | None = None,
    symbol: str = "primary_hashtag",
    ts: str = "timestamp",
) -> DataFrame:
    """(symbol, window_start, STATE_SUMS) per symbol and non-empty tumbling bucket; works on batch and stream alike.

    Everything is a sum, so each task reduces its posts to one partial row per
    bucket before the only shuffle: neither a loud symbol nor a busy hour can
    overload a task. States of the same bucket from different posts are merged by addition.
    """
    settings = settings or DEFAULT.signal
    minutes = settings.bucket_minutes
    if minutes <= 0 or MINUTES_PER_DAY % minutes:
        raise ValueError(f"bucket of {minutes} minutes does not divide a day")

    w, s = F.col("_w"), F.col("_s")
    sums = (
        scored.where(F.col(symbol).isNotNull() & F.col(ts).isNotNull())
        .select(
            F.col(symbol).alias("symbol"),
            F.col(ts).alias("_ts"),
            F.col("engagement_score").cast("bigint").alias("_e"),
            F.col("sentiment_score").alias("_s"),
            stats.engagement_weight(F.col("engagement_score")).alias("_w"),
        )
        .groupBy("symbol", F.window("_ts", f"{minutes} minutes").alias("_window"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("_e").alias("total_engagement"),
            F.sum(w).alias("sw"),
            F.sum(w * s).alias("sws"),
            F.sum(w * s * s).alias("swss"),
            F.sum(s).alias("ss"),
            F.sum(s * s).alias("sss"),
        )
    )
    return sums.select("symbol", F.col("_window.start").alias("window_start"), *STATE_SUMS)


def merge_states(states: DataFrame) -> DataFrame:
    """One state per bucket out of any number of partial ones."""
    return states.groupBy("symbol", "window_start").agg(*[F.sum(c).alias(c) for c in STATE_SUMS])


def sentiment_of_states(states: DataFrame, settings: SignalSettings | None = None) -> DataFrame:
    """Signal, interval and counts of whole bucket states."""
    settings = settings or DEFAULT.signal
    weighted = F.col("sw") > 0
    n = F.col("n").cast("double")
    mean = F.when(weighted, F.col("sws") / F.col("sw")).otherwise(F.col("ss") / n)
    square = F.when(weighted, F.col("swss") / F.col("sw")).otherwise(F.col("sss") / n)
    with_mean = states.withColumns({"sentiment_signal": mean, "_square": square})
    variance = F.greatest(
        F.col("_square") - F.col("sentiment_signal") * F.col("sentiment_signal"), F.lit(0.0)
    )
    with_margin = with_mean.withColumn(
        "_margin",
        stats.interval_margin(n, variance, settings.min_ci_sample, settings.confidence),
    )
    return with_margin.select(
        "symbol",
        "window_start",
        "sentiment_signal",
        stats.clamp_unit(F.col("sentiment_signal") - F.col("_margin")).alias("ci_lower"),
        stats.clamp_unit(F.col("sentiment_signal") + F.col("_margin")).alias("ci_upper"),
        F.col("n").alias("tweet_count"),
        "total_engagement",
    )


def bucket_sentiment(
    scored: DataFrame,
    settings: SignalSettings | None = None,
    symbol: str = "primary_hashtag",
    ts: str = "timestamp",
) -> DataFrame:
    """One row per symbol and non-empty tumbling bucket; works on batch and stream alike."""
    return sentiment_of_states(bucket_states(scored, settings, symbol, ts), settings)


def with_volume_baseline(buckets: DataFrame, settings: SignalSettings | None = None) -> DataFrame:
    """Mean, deviation and z-score of the volume against the latest buckets of the same symbol.

    The window runs over buckets, not posts: its partitions grow with time
    divided by the bucket length and stay small for the loudest symbol too.
    """
    settings = settings or DEFAULT.signal
    recent = (
        Window.partitionBy("symbol")
        .orderBy("window_start")
        .rowsBetween(1 - settings.baseline_buckets, 0)
    )
    enough = F.count(F.lit(1)).over(recent) >= settings.baseline_min_buckets
    count = F.col("tweet_count").cast("double")
    based = buckets.withColumns(
        {
            "volume_rolling_mean": F.when(enough, F.avg("tweet_count").over(recent)),
            "volume_rolling_std": F.when(enough, F.stddev_samp("tweet_count").over(recent)),
        }
    )
    z = (count - F.col("volume_rolling_mean")) / F.nullif(F.col("volume_rolling_std"), F.lit(0.0))
    return based.withColumn("volume_zscore", F.coalesce(z, F.lit(0.0)))


def with_composite(based: DataFrame, settings: SignalSettings | None = None) -> DataFrame:
    """Direction blended with conviction; tanh keeps the volume part inside [-1, 1]."""
    settings = settings or DEFAULT.signal
    return based.withColumn(
        "composite_score",
        F.lit(settings.sentiment_weight) * F.col("sentiment_signal")
        + F.lit(settings.volume_weight) * F.tanh(F.col("volume_zscore") / F.lit(stats.Z_SCALE)),
    )


def build_signal(
    scored: DataFrame,
    settings: SignalSettings | None = None,
    symbol: str = "primary_hashtag",
    ts: str = "timestamp",
) -> DataFrame:
    buckets = bucket_sentiment(scored, settings, symbol, ts)
    return with_composite(with_volume_baseline(buckets, settings), settings)


def latest_per_symbol(signal: DataFrame) -> DataFrame:
    newest = Window.partitionBy("symbol").orderBy(F.desc("window_start"))
    return (
        signal.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
    )


def signal_frame(signal: DataFrame, symbol: str | None = None) -> DataFrame:
    """Lines and confidence bands to plot, of one symbol or of all."""
    picked = signal if symbol is None else signal.where(F.col("symbol") == symbol)
    return picked.select("symbol", "window_start", "composite_score", "ci_lower", "ci_upper").orderBy(
        "symbol", "window_start"
    )
