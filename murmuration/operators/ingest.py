"""Derive the stored columns of a post and limit what is ingested."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmuration.config import DEFAULT, CollectionSettings
from murmuration.functions import text
from murmuration.sources.scratch import Scratch


def engagement_score() -> Column:
    """Replies weigh most, then reposts, then likes; 64-bit so that it cannot overflow."""
    return (
        F.col("like_count").cast("bigint")
        + F.lit(2) * F.col("retweet_count").cast("bigint")
        + F.lit(3) * F.col("reply_count").cast("bigint")
    )


def with_engagement(posts: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add ``engagement_score`` and ``scrape_date`` (the date of the post itself)."""
    return posts.withColumns(
        {
            "engagement_score": engagement_score(),
            "scrape_date": F.date_format(ts, "yyyy-MM-dd"),
        }
    )


def with_entities(posts: DataFrame) -> DataFrame:
    """Add hashtags, mentions and the reply flag found in ``content``."""
    content = F.col("content")
    return posts.withColumns(
        {
            "hashtags": text.hashtags(content),
            "mentions": text.mentions(content),
            "is_reply": text.is_reply(content),
        }
    )


def parse_cards(cards: DataFrame) -> DataFrame:
    """Typed columns from the link and the count labels of collected cards.

    Expects ``link``, ``like_label``, ``retweet_label`` and ``reply_label``; where there is a
    ``time_label`` (ISO text with a zone) or a ``username``, they become ``timestamp`` and the name without "@".
    Cards without a post id in the link are no posts and are left out.
    """
    parsed = cards.withColumns(
        {
            "post_id": text.post_id_from_link(F.col("link")),
            "like_count": text.count_from_label(F.col("like_label")),
            "retweet_count": text.count_from_label(F.col("retweet_label")),
            "reply_count": text.count_from_label(F.col("reply_label")),
        }
    )
    if "time_label" in cards.columns:
        parsed = parsed.withColumn("timestamp", F.col("time_label").try_cast("timestamp"))
    if "username" in cards.columns:
        parsed = parsed.withColumn("username", F.regexp_replace("username", "^@+", ""))
    return parsed.where(F.col("post_id").isNotNull()).drop(
        "link", "like_label", "retweet_label", "reply_label", "time_label"
    )


def normalise_delivered(posts: DataFrame) -> DataFrame:
    """All stored raw columns from the delivered ones; works on batch and stream alike."""
    return with_entities(with_engagement(posts)).withColumn("display_name", F.col("username"))


def within_lookback(
    posts: DataFrame, as_of: datetime | Column, hours: int | None = None, ts: str = "timestamp"
) -> DataFrame:
    """Posts not older than ``hours`` before ``as_of``. With a constant the filter reaches the scan.

    Stored posts lie in folders by ``scrape_date``, the date of the post: older folders are not listed.
    """
    hours = DEFAULT.collection.lookback_hours if hours is None else hours
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    oldest = moment - F.expr(f"INTERVAL {int(hours)} HOURS")
    recent = posts.where(F.col(ts) >= oldest)
    if "scrape_date" in posts.columns:
        day = F.date_format(oldest.cast("timestamp"), "yyyy-MM-dd")
        recent = recent.where(F.col("scrape_date").isNull() | (F.col("scrape_date") >= day))
    return recent


def tag_targets(spark: SparkSession, settings: CollectionSettings | None = None) -> DataFrame:
    """(tag, target) of the configured hashtags and cashtags."""
    settings = settings or DEFAULT.collection
    tags = dict.fromkeys([*settings.hashtags, *settings.cashtags])
    return spark.createDataFrame(
        [(t, settings.target_for(t)) for t in tags], "tag string, target bigint"
    )


def target_column(tag: str, settings: CollectionSettings) -> Column:
    return (
        F.when(F.col(tag).isin(*settings.hashtags), F.lit(settings.posts_per_hashtag))
        .otherwise(F.lit(min(settings.bonus_target, settings.posts_per_hashtag)))
        .cast("bigint")
    )


def since_cutoff(
    posts: DataFrame,
    settings: CollectionSettings | None = None,
    tag: str = "primary_hashtag",
    ts: str = "timestamp",
) -> DataFrame:
    """The posts of each tag from the second on in which it reaches its target; all posts of a tag that does not.

    Counts by second read two narrow columns once and are aggregated before the shuffle. They are summed by hour first and
    looked at one by one only within the hour found, so no task orders all seconds of a tag. What is left of a tag
    is its target and at most the posts of one second more.
    """
    settings = settings or DEFAULT.collection
    posts = posts.where(F.col(tag).isNotNull() & F.col(ts).isNotNull())

    def reached(counted: DataFrame) -> DataFrame:
        newest_first = Window.partitionBy(tag).orderBy(F.desc("_unit"))
        newer = F.col("_newer") + F.sum("_n").over(newest_first) - F.col("_n")
        open_units = counted.withColumn("_newer", newer).where(F.col("_newer") < target_column(tag, settings))
        # going back in time the newer posts only grow in number, so both belong to one unit
        return open_units.groupBy(F.col(tag).alias("_tag")).agg(F.min("_unit").alias("_cutoff"), F.max("_newer").alias("_newer"))

    second = F.date_trunc("second", ts).alias("_second")
    counts = posts.groupBy(tag, second).agg(F.count(F.lit(1)).alias("_n"))
    hour = F.date_trunc("hour", "_second")
    hours = reached(counts.groupBy(tag, hour.alias("_unit")).agg(F.sum("_n").alias("_n")).withColumn("_newer", F.lit(0)))
    within = counts.join(hours, (F.col(tag) == F.col("_tag")) & (hour == F.col("_cutoff"))).select(tag, "_newer", F.col("_second").alias("_unit"), "_n")
    # stored, so the planner knows its size and broadcasts it where that is small
    seconds = Scratch(posts.sparkSession, "tag-cutoff").put(reached(within).drop("_newer"), "cutoff")
    return posts.join(seconds, (F.col(tag) == F.col("_tag")) & (F.col(ts) >= F.col("_cutoff"))).drop("_tag", "_cutoff")


def cap_per_tag(
    posts: DataFrame,
    settings: CollectionSettings | None = None,
    tag: str = "primary_hashtag",
    ts: str = "timestamp",
    post_id: str = "post_id",
    salts: int = 64,
) -> DataFrame:
    """The newest posts of each tag, at most its target.

    Two reductions keep a dominating tag away from any single task. Posts older than the second in which a tag
    reaches its target stay in the scan stage (see ``since_cutoff``). What remains is ranked within salted parts of
    the tag, and only the best of each part are ranked across the tag. Both steps are exact. The largest target
    is repeated as a constant; up to the session's limit for groups (1,000 rows by default) Catalyst applies it
    before the shuffle as well.
    """
    settings = settings or DEFAULT.collection
    recent = since_cutoff(posts, settings, tag, ts)

    largest = settings.posts_per_hashtag
    order = [F.desc(ts), F.asc(post_id)]
    salt = F.pmod(F.xxhash64(post_id, ts), F.lit(salts))
    part = Window.partitionBy(tag, "_salt").orderBy(*order)
    whole = Window.partitionBy(tag).orderBy(*order)
    return (
        recent.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(part))
        .where((F.col("_rank") <= largest) & (F.col("_rank") <= target_column(tag, settings)))
        .withColumn("_rank", F.row_number().over(whole))
        .where((F.col("_rank") <= largest) & (F.col("_rank") <= target_column(tag, settings)))
        .drop("_salt", "_rank")
    )


def collected_per_tag(posts: DataFrame, settings: CollectionSettings | None = None) -> DataFrame:
    """Collected against target for every configured or seen tag."""
    settings = settings or DEFAULT.collection
    seen = posts.where(F.col("primary_hashtag").isNotNull()).select(
        F.col("primary_hashtag").alias("tag"), F.lit(1).alias("one")
    )
    wanted = tag_targets(posts.sparkSession, settings).select("tag", F.lit(0).alias("one"))
    return (
        seen.unionByName(wanted)
        .groupBy("tag")
        .agg(F.sum("one").alias("collected"))
        .withColumn("target", target_column("tag", settings))
        .withColumn("short_of_target", F.col("collected") < F.col("target"))
    )
