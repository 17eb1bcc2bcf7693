"""One registered query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.config import CollectionSettings, NearDuplicateSettings, SampleSettings, SignalSettings, StorageSettings, TermSettings
from murmuration.functions import minhash, text
from murmuration.operators import (
    cleaning,
    dedup,
    ingest,
    report,
    sampling,
    sentiment,
    signal,
    similarity,
    terms,
)
from murmuration.plans.pipeline import score_posts
from murmuration.schema import DELIVERED_POSTS, RAW_POSTS
from murmuration.sources import given_tables as given
from murmuration.sources.scratch import Scratch
from murmuration.sources.store import PostStore
from murmuration.streaming import jobs

# Targets that the given event types exceed, meet and miss.
DEMO_TAGS = CollectionSettings(
    hashtags=("view", "click", "nifty50", "sensex"), posts_per_hashtag=1000, bonus_target=500
)
DAILY = SignalSettings(bucket_minutes=24 * 60)
STREAM_DELAY = "10 minutes"
SIGNATURE = (3, 21)
# At 0.80 more texts collide, so that the rounds of the near tier have work.
LOOSE = NearDuplicateSettings(threshold=0.80)
LOOSE_SIGNATURE = (5, 11)


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles rounded for a comparison by value; adding 0.0 turns -0.0 into 0.0."""
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in columns})


def _joined(column: str) -> Column:
    return F.array_join(column, " ").alias(column)


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.with_engagement(given.posts(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_posts(_posts(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.with_sentiment(_cleaned(spark, sf_dir))


def _delivered(posts: DataFrame) -> DataFrame:
    """Posts in the shape a collector delivers."""
    return posts.withColumns(
        {"view_count": F.lit(None), "scraped_at": F.col("timestamp")}
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DELIVERED_POSTS])


# --- sources, sinks, ingest -------------------------------------------------------------------


def _stored(spark: SparkSession, sf_dir: str) -> PostStore:
    store = PostStore(spark, Scratch(spark, "store").at("posts"))
    store.write_batch(ingest.normalise_delivered(_delivered(given.posts(spark, sf_dir))))
    return store


def scan_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).load(
        columns=["post_id", "primary_hashtag", "engagement_score", "is_reply"],
        filters=[
            ("primary_hashtag", "in", ["view", "click"]),
            ("scrape_date", ">=", "2024-01-10"),
            ("engagement_score", ">", 20),
        ],
    )


def partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _stored(spark, sf_dir).load()
    return stored.groupBy("scrape_date", "primary_hashtag").agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum("engagement_score").alias("engagement"),
        F.sum(F.char_length("content")).alias("characters"),
    )


def repeated_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts stored in three batches, each tried twice; the first attempt of each held half of its rows."""
    store = PostStore(spark, Scratch(spark, "batches").at("posts"), StorageSettings(batch_column="batch"))
    posts = ingest.normalise_delivered(_delivered(given.posts(spark, sf_dir)))
    share = F.pmod(F.xxhash64("post_id"), F.lit(6))
    for batch in range(3):
        store.write_batch(posts.where(share == batch), batch)
        store.write_batch(posts.where(share.isin(batch, batch + 3)), batch)
    return store.load(["post_id", "primary_hashtag", "engagement_score"])


def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rows of the ten busiest posts, read back by their ids."""
    store = _stored(spark, sf_dir)
    busiest = sampling.top_posts(store.load(["post_id", "engagement_score"]), 10)
    keys = [r["post_id"] for r in busiest.select("post_id").collect()]
    return store.lookup(keys, ["post_id", "primary_hashtag", "engagement_score", "content"])


def engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posts(spark, sf_dir).select("post_id", "engagement_score", "scrape_date")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.with_entities(given.posts(spark, sf_dir)).select(
        "post_id", _joined("hashtags"), _joined("mentions"), "is_reply"
    )


def count_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    hundredths = F.floor(F.col("value") * 100)
    cards = given.table(spark, sf_dir, "events").select(
        F.concat(
            F.lit("/user"), F.col("user_id"), F.lit("/status/"), F.col("event_id"), F.lit("?s=20")
        ).alias("link"),
        F.concat(F.format_number(hundredths, 0), F.lit(" Likes. Like")).alias("like_label"),
        F.concat(F.lit("Reposts: "), F.col("user_id")).alias("retweet_label"),
        F.lit("Reply").alias("reply_label"),
    )
    return ingest.parse_cards(cards)


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collected cards on their way into the stored columns."""
    shown = given.posts(spark, sf_dir).select(
        F.concat(F.lit("/someone/status/"), "post_id").alias("link"),
        F.concat(F.format_number("like_count", 0), F.lit(" Likes. Like")).alias("like_label"),
        F.concat(F.col("retweet_count"), F.lit(" reposts. Repost")).alias("retweet_label"),
        F.concat(F.col("reply_count"), F.lit(" Replies. Reply")).alias("reply_label"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time_label"),
        F.concat(F.lit("@"), F.trim("username")).alias("username"),
        "content",
    )
    stored = ingest.normalise_delivered(ingest.parse_cards(shown))
    return stored.select(
        "post_id", "username", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "like_count",
        "engagement_score", "scrape_date", _joined("hashtags"), "is_reply",
    )


def lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.posts(spark, sf_dir)
    newest = given.table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    return ingest.within_lookback(posts, newest, 24).select("post_id", "timestamp")


def tag_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.posts(spark, sf_dir).select("post_id", "primary_hashtag", "timestamp")
    return ingest.cap_per_tag(posts, DEMO_TAGS)


def collected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.collected_per_tag(given.posts(spark, sf_dir), DEMO_TAGS)


# --- deduplication ----------------------------------------------------------------------------


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    twice = given.cross_posted(_posts(spark, sf_dir))
    # the texts are hashed and measured where they are read, and not shuffled
    measured = twice.withColumns({"_row": F.xxhash64(*twice.columns), "n_chars": F.char_length("content")}).drop("content")
    return dedup.exact_dedup(measured, row_hash="_row").select("post_id", "primary_hashtag", "engagement_score", "n_chars")


def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.with_comparable_text(given.posts(spark, sf_dir)).select("post_id", "comparable")


def shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = dedup.with_comparable_text(given.article_posts(spark, sf_dir))
    return dedup.shingle_sets(texts, ["post_id"])


def minhash_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    bands, rows = SIGNATURE
    texts = dedup.with_comparable_text(given.article_posts(spark, sf_dir))
    signed = dedup.signatures(texts, ["post_id"], bands * rows)
    minima = [F.col(f"m{i}") for i in range(bands * rows)]
    return signed.select(
        "post_id",
        F.concat_ws(",", *[m.cast("string") for m in minima]).alias("signature"),
        F.array_join(minhash.band_keys(minima, bands, rows), " ").alias("buckets"),
    )


def lsh_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    banded = dedup.banded_texts(given.article_posts(spark, sf_dir))
    return dedup.bucket_leaders(dedup.bucket_entries(banded)).select(
        "bucket", F.col("leader.id").alias("leader"), "members"
    )


def lsh_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.lsh_candidates(given.article_posts(spark, sf_dir))


def lsh_candidates_080(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.lsh_candidates(given.article_posts(spark, sf_dir), LOOSE)


def near_dedup_080(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.article_posts(spark, sf_dir)
    return dedup.near_duplicate_dedup(posts, settings=LOOSE).select("post_id", "engagement_score")


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicate_dedup(given.article_posts(spark, sf_dir)).select(
        "post_id", "engagement_score"
    )


def near_dedup_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.article_posts(spark, sf_dir)
    return dedup.near_duplicate_dedup(posts, settings=LOOSE, verify=True).select("post_id", "engagement_score")


def jaccard_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(similarity.similar_pairs(given.article_posts(spark, sf_dir), LOOSE.threshold), "jaccard")


def two_tier_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    twice = given.cross_posted(_posts(spark, sf_dir))
    return dedup.deduplicate(twice).select("post_id", "primary_hashtag", "engagement_score")


# --- text -------------------------------------------------------------------------------------


def nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.posts(spark, sf_dir)
    return posts.select("post_id", text.nfkc(F.col("content")).alias("normalised"))


def emojis(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.posts(spark, sf_dir)
    return posts.select(
        "post_id", F.array_join(text.extract_emojis(F.col("content")), " ").alias("emojis")
    )


def script_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.count_values(_cleaned(spark, sf_dir), "script")


def cashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.posts(spark, sf_dir)
    return posts.select(
        "post_id", F.array_join(text.cashtags(F.col("content")), " ").alias("cashtags")
    )


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).select("post_id", "content_clean", "script")


def tag_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = ingest.with_entities(given.posts(spark, sf_dir))
    return cleaning.clean_posts(posts).select("post_id", "username", _joined("hashtags"))


def sentiment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir).select("post_id", "sentiment_score", "sentiment_label")
    return _rounded(scored, "sentiment_score")


def sentiment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.count_values(_scored(spark, sf_dir), "sentiment_label")


# --- terms ------------------------------------------------------------------------------------


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.article_posts(spark, sf_dir)
    found = terms.tokenised(posts, text="content")
    every = terms.all_terms(F.col("tokens"), TermSettings().max_ngram)
    return found.select(
        "post_id", F.array_join("tokens", " ").alias("words"), F.array_join(every, ",").alias("terms")
    )


def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = given.article_posts(spark, sf_dir)
    return terms.most_frequent(terms.term_frequencies(posts, text="content"))


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(terms.tfidf(given.article_posts(spark, sf_dir), text="content"), "weight")


def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = terms.tfidf(given.article_posts(spark, sf_dir), text="content")
    return _rounded(terms.top_terms(weights), "score")


# --- signal -----------------------------------------------------------------------------------

_BUCKET_DOUBLES = ("sentiment_signal", "ci_lower", "ci_upper")
_VOLUME_DOUBLES = ("volume_rolling_mean", "volume_rolling_std", "volume_zscore")


def signal_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(signal.bucket_sentiment(_scored(spark, sf_dir)), *_BUCKET_DOUBLES)


def signal_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(signal.bucket_sentiment(_scored(spark, sf_dir), DAILY), *_BUCKET_DOUBLES)


def volume_z(spark: SparkSession, sf_dir: str) -> DataFrame:
    based = signal.build_signal(_scored(spark, sf_dir), DAILY)
    return _rounded(based, *_VOLUME_DOUBLES).select(
        "symbol", "window_start", "tweet_count", *_VOLUME_DOUBLES
    )


def composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = signal.build_signal(_scored(spark, sf_dir))
    return _rounded(built, *_BUCKET_DOUBLES, *_VOLUME_DOUBLES, "composite_score")


def latest_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = signal.latest_per_symbol(signal.build_signal(_scored(spark, sf_dir)))
    return _rounded(latest, "composite_score", "ci_lower", "ci_upper").select(
        "symbol", "window_start", "composite_score", "ci_lower", "ci_upper", "tweet_count"
    )


def signal_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = signal.build_signal(_scored(spark, sf_dir), DAILY)
    frame = signal.signal_frame(built, "view")
    return _rounded(frame, "composite_score", "ci_lower", "ci_upper")


# --- reports and samples ----------------------------------------------------------------------


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = given.cross_posted(_posts(spark, sf_dir))
    return report.tag_report(raw, score_posts(raw, near_duplicates=False), DEMO_TAGS)


def tag_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir)


def report_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_total(_report(spark, sf_dir))


def shortfalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.shortfalls(_report(spark, sf_dir))


def report_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    # one row per tag, read by several parts of the text
    stored = Scratch(spark, "report").put(_report(spark, sf_dir), "report")
    return report.markdown_lines(stored, DEMO_TAGS)


def top_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.top_posts(_posts(spark, sf_dir)).select(
        "post_id", "primary_hashtag", "engagement_score", "content"
    )


def reservoir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.uniform_sample(_posts(spark, sf_dir), SampleSettings()).select(
        "post_id", "engagement_score"
    )


def scatter_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sampling.scatter_frame(_scored(spark, sf_dir)), "sentiment_score", "size")


def full_run_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both dedup tiers, cleaning, scoring and the daily composite signal."""
    raw = given.cross_posted(_posts(spark, sf_dir))
    built = signal.build_signal(score_posts(raw), DAILY)
    return _rounded(built, *_BUCKET_DOUBLES, *_VOLUME_DOUBLES, "composite_score")


# --- streaming --------------------------------------------------------------------------------


def _land(posts: DataFrame, path: str) -> None:
    """Add files to a landing folder; zstd finds the text of a post again in its other deliveries, however long it is."""
    posts.write.mode("append").option("compression", "zstd").parquet(path)


def _land_and_run(spark: SparkSession, posts: DataFrame, scratch: Scratch, start: Callable) -> str:
    """Land the older half, run the job, land the newer half, run it again; return the sink.

    The second run resumes from the checkpoint of the first one.
    """
    sink = scratch.at("sink")
    # one value for both halves: an approximate median that each half takes anew may differ, and lose posts in between
    middle = posts.agg(F.percentile_approx(F.unix_micros("timestamp"), 0.5)).first()[0]
    is_old = F.unix_micros("timestamp") < middle
    for part in (posts.where(is_old), posts.where(~is_old)):
        _land(part, scratch.at("landing"))
        stream = jobs.landed(spark, scratch.at("landing"), posts.schema)
        start(stream, sink, scratch.at("state")).awaitTermination()
    return sink


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "stream-ingest")
    delivered = _delivered(given.posts(spark, sf_dir))
    batches = StorageSettings(batch_column="batch")
    sink = _land_and_run(
        spark, delivered, scratch, lambda stream, path, state: jobs.ingest_landed(stream, path, state, scratch.at("landing"), batches)
    )
    return (
        spark.read.schema(RAW_POSTS).parquet(sink)
        .groupBy("scrape_date", "primary_hashtag")
        .agg(
            F.count(F.lit(1)).alias("posts"),
            F.sum("engagement_score").alias("engagement"),
            F.sum(F.size("hashtags")).alias("tags"),
        )
    )


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "stream-dedup")
    twice = given.cross_posted(given.posts(spark, sf_dir))
    delivered = _delivered(twice)
    sink = _land_and_run(
        spark,
        delivered,
        scratch,
        lambda stream, path, state: jobs.write_unique(
            jobs.exact_dedup_stream(jobs.placed_posts(stream), STREAM_DELAY),
            path,
            state,
            landing=scratch.at("landing"),
        ),
    )
    return spark.read.schema(delivered.schema).parquet(sink).select(
        "post_id",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.char_length("content").alias("n_chars"),
        F.md5(F.col("content").cast("binary")).alias("content_md5"),
    )


def _streamable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posts(spark, sf_dir).select(
        "post_id",
        "content",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        "primary_hashtag",
        "engagement_score",
    )


def _streamed_buckets(spark: SparkSession, sf_dir: str, settings: SignalSettings) -> str:
    return _land_and_run(
        spark,
        _streamable(spark, sf_dir),
        Scratch(spark, "stream-signal"),
        lambda stream, path, state: jobs.write_buckets(
            jobs.finalised_buckets(stream, STREAM_DELAY, settings), path, state
        ),
    )


def stream_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = spark.read.parquet(_streamed_buckets(spark, sf_dir, SignalSettings()))
    return _rounded(buckets, *_BUCKET_DOUBLES).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


def stream_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "stream-volume")
    sink = _land_and_run(
        spark,
        _streamable(spark, sf_dir),
        scratch,
        lambda stream, path, state: jobs.write_composite(jobs.finalised_buckets(stream, STREAM_DELAY, DAILY), path, state, settings=DAILY),
    )
    built = jobs.read_composite(spark, sink)
    return _rounded(built, *_VOLUME_DOUBLES, "composite_score").select(
        "symbol",
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "tweet_count",
        *_VOLUME_DOUBLES,
        "composite_score",
    )


def stream_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest third of the posts lands first and the oldest last: no bucket misses a post, the open one included."""
    scratch = Scratch(spark, "stream-states")
    posts = _streamable(spark, sf_dir)
    cuts = posts.agg(F.percentile_approx(F.unix_micros("timestamp"), [0.33, 0.66])).first()[0] or [None, None]
    at = F.unix_micros("timestamp")
    for part in (at >= cuts[1], (at >= cuts[0]) & (at < cuts[1]), at < cuts[0]):
        _land(posts.where(part), scratch.at("landing"))
        stream = jobs.landed(spark, scratch.at("landing"), posts.schema)
        jobs.write_states(stream, scratch.at("sink"), scratch.at("state")).awaitTermination()
        jobs.compact_states(spark, scratch.at("sink"))
    buckets = jobs.current_buckets(spark, scratch.at("sink"))
    return _rounded(buckets, *_BUCKET_DOUBLES).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_filtered": scan_filtered,
    "partition_roundtrip": partition_roundtrip,
    "repeated_batches": repeated_batches,
    "key_lookup": key_lookup,
    "engagement": engagement,
    "entities": entities,
    "count_labels": count_labels,
    "cards": cards,
    "lookback": lookback,
    "tag_cap": tag_cap,
    "collected": collected,
    "exact_dedup": exact_dedup,
    "norm_text": norm_text,
    "shingles": shingles,
    "minhash": minhash_signatures,
    "lsh_buckets": lsh_buckets,
    "lsh_candidates": lsh_candidates,
    "lsh_candidates_080": lsh_candidates_080,
    "near_dedup_080": near_dedup_080,
    "near_dedup": near_dedup,
    "near_dedup_verified": near_dedup_verified,
    "jaccard_pairs": jaccard_pairs,
    "two_tier_dedup": two_tier_dedup,
    "nfkc": nfkc,
    "emojis": emojis,
    "script_mix": script_mix,
    "cashtags": cashtags,
    "clean_text": clean_text,
    "tag_norm": tag_norm,
    "sentiment": sentiment_scores,
    "sentiment_split": sentiment_split,
    "tokens": tokens,
    "vocab": vocab,
    "tfidf": tfidf,
    "top_terms": top_terms,
    "signal_15m": signal_15m,
    "signal_1d": signal_1d,
    "volume_z": volume_z,
    "composite": composite,
    "latest_signal": latest_signal,
    "signal_frame": signal_frame,
    "tag_report": tag_report,
    "report_total": report_total,
    "shortfalls": shortfalls,
    "report_markdown": report_markdown,
    "top_posts": top_posts,
    "reservoir": reservoir,
    "scatter_frame": scatter_frame,
    "full_run_signal": full_run_signal,
    "stream_ingest": stream_ingest,
    "stream_dedup": stream_dedup,
    "stream_signal": stream_signal,
    "stream_volume": stream_volume,
    "stream_states": stream_states,
}
