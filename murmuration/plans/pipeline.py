"""The whole batch run: load, deduplicate, clean, score, build the signal, report, persist."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from murmuration.config import DEFAULT, EngineConfig
from murmuration.operators import cleaning, dedup, report, rows, sampling, sentiment, signal, terms
from murmuration.sources import store


def score_posts(
    raw: DataFrame,
    near_duplicates: bool = True,
    config: EngineConfig = DEFAULT,
    ts: str = "timestamp",
) -> DataFrame:
    """Duplicates are judged on the raw text, before cleaning.

    Cleaning and scoring run where the posts are read; only what is wanted of the scored posts meets the names that stay.
    """
    unique, names = dedup.survivors(raw, near_duplicates, config.near_dup, ts, config.storage.key_columns)
    scored = sentiment.with_sentiment(cleaning.clean_posts(unique))
    return rows.among(scored, names).drop(*rows.NAMES)


@dataclass(frozen=True)
class PipelineResult:
    """Frames that read the written tables; nothing is held in memory."""

    scored: DataFrame
    signal: DataFrame
    top_terms: DataFrame
    report: DataFrame
    sentiment_split: DataFrame
    script_mix: DataFrame
    latest_signal: DataFrame
    scatter: DataFrame


def run_pipeline(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    near_duplicates: bool = True,
    config: EngineConfig = DEFAULT,
) -> PipelineResult | None:
    """Run on a post store and write all outputs below ``out_path``; None without raw posts.

    The scored posts are written once and every later output reads that table,
    so the text work is not repeated per output.
    """
    raw = store.PostStore(spark, raw_path, config.storage).load()
    if raw.isEmpty():
        return None
    codec = config.storage.compression

    scored_path = f"{out_path}/posts_scored"
    store.write_scored(score_posts(raw, near_duplicates, config), scored_path, codec)
    scored = spark.read.parquet(scored_path)

    signal_path = f"{out_path}/composite_signals"
    store.write_signal(signal.build_signal(scored, config.signal), signal_path, codec)
    series = spark.read.parquet(signal_path)

    weights = terms.tfidf(scored, config.terms)
    best_terms = terms.top_terms(weights, config.terms.top_n)
    best_terms.write.mode("overwrite").parquet(f"{out_path}/top_terms")

    tags = report.tag_report(raw, scored, config.collection)
    tags.write.mode("overwrite").parquet(f"{out_path}/tag_report")
    tags = spark.read.parquet(f"{out_path}/tag_report")
    store.write_report_csv(tags, f"{out_path}/tag_report_csv")
    store.write_report_markdown(
        report.markdown_lines(tags, config.collection), f"{out_path}/tag_report_markdown"
    )
    return PipelineResult(
        scored=scored,
        signal=series,
        top_terms=spark.read.parquet(f"{out_path}/top_terms"),
        report=tags,
        sentiment_split=sentiment.count_values(scored, "sentiment_label"),
        script_mix=sentiment.count_values(scored, "script"),
        latest_signal=signal.latest_per_symbol(series),
        scatter=sampling.scatter_frame(scored, config.sample),
    )


def run_report(
    spark: SparkSession, raw_path: str, out_path: str, config: EngineConfig = DEFAULT
) -> DataFrame:
    """Only the report, from raw posts and the scored posts of an earlier run."""
    raw = store.PostStore(spark, raw_path, config.storage).load()
    if raw.isEmpty():
        raise FileNotFoundError(f"no raw posts under {raw_path}")
    scored = spark.read.parquet(f"{out_path}/posts_scored")
    tags = report.tag_report(raw, scored, config.collection)
    store.write_report_csv(tags, f"{out_path}/tag_report_csv")
    store.write_report_markdown(
        report.markdown_lines(tags, config.collection), f"{out_path}/tag_report_markdown"
    )
    return tags


def main(argv: list[str]) -> int:
    if len(argv) != 2:
        print("usage: spark-submit run_signals.py RAW_PATH OUT_PATH")
        return 2
    spark = (
        SparkSession.builder.appName("murmuration")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    result = run_pipeline(spark, *argv)
    if result is None:
        print(f"no raw posts under {argv[0]}")
        return 1
    result.sentiment_split.show()
    result.script_mix.show()
    result.latest_signal.show(truncate=False)
    result.top_terms.show(truncate=False)
    result.report.orderBy("hashtag").show(truncate=False)
    return 0

