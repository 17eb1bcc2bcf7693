"""Exact top-k, exact uniform samples and the frames that plots are drawn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.config import DEFAULT, SampleSettings
from murmuration.sources.scratch import Scratch

HASH_BITS = 32
# At most 2^20 hash ranges, so one task can accumulate their counts whatever the
# input size, and one range holds a millionth of the posts.
RANGE_BITS = 20

# Point size and colours of the sentiment scatter.
ENGAGEMENT_CEILING = 200
SIZE_DIVISOR = 8.0
SIZE_OFFSET = 4.0
UP_COLOUR, DOWN_COLOUR, FLAT_COLOUR = "#2e7d32", "#c62828", "#9e9e9e"
COLOUR_BAND = 0.2


def sample_hash(post_id: str, seed: int) -> Column:
    """Seeded 32-bit hash of the id: the same rows are drawn whatever the partitioning."""
    keyed = F.concat(F.lit(f"{seed}|"), F.col(post_id))
    return F.conv(F.substring(F.md5(keyed.cast("binary")), 1, 8), 16, 10).cast("bigint")


def uniform_sample(
    posts: DataFrame, settings: SampleSettings | None = None, post_id: str = "post_id"
) -> DataFrame:
    """Exactly ``size`` posts (all of them if there are fewer), uniform and repeatable.

    The posts with the smallest hashes are the sample. Taking k rows from every
    input split would send splits x k rows to one task, so a narrow pass first
    counts the hashes per range and finds the range in which the k-th smallest
    hash lies; only posts up to it are carried on.
    """
    settings = settings or DEFAULT.sample
    k = settings.size
    shift = HASH_BITS - RANGE_BITS
    hashed = posts.withColumn("_hash", sample_hash(post_id, settings.seed))
    ranges = hashed.groupBy(F.shiftright("_hash", shift).alias("_range")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    last = (
        ranges.withColumn("_before", before)
        .where(F.col("_before") < k)
        .agg(F.max("_range"))
        .scalar()
    )
    return (
        hashed.where(F.shiftright("_hash", shift) <= last)
        .orderBy("_hash", post_id)
        .limit(k)
        .drop("_hash")
    )


def magnitude_range(value: Column) -> Column:
    """A whole number that rises with a long: 128 ranges between a power of two and the next.

    At most some 16,000 different ones on either side of zero, whatever the values.
    """
    size = F.least(F.abs(value), F.lit((1 << 63) - 1))
    shift = F.greatest(F.lit(0), F.length(F.bin(size)) - 8)
    ranged = shift * 256 + F.call_function("shiftright", size, shift)
    return F.when(value < 0, F.negative(ranged)).otherwise(ranged)


def at_or_above_cut(rows: DataFrame, value: Column, k: int) -> DataFrame:
    """Rows whose value lies in the range of the k-th largest or above: all of the top k, few others.

    Taking k rows from every input split would send splits x k rows to one task; a narrow pass
    counts the values per range instead, and only the rows from the k-th's range on are ordered.
    """
    ranges = rows.groupBy(magnitude_range(value).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy(F.desc("_range"))) - F.col("_n")
    cut = ranges.withColumn("_before", before).where(F.col("_before") < k).agg(F.min("_range")).scalar()
    return rows.where(magnitude_range(value) >= cut)


def top_posts(
    posts: DataFrame, k: int = 50, by: str = "engagement_score", post_id: str = "post_id"
) -> DataFrame:
    """The k posts with the highest engagement, ties by id.

    The cut-off is found on the engagement alone; the wide columns are read only for the
    posts at or above it.
    """
    ranked = posts.where(F.col(by).isNotNull())
    reached = at_or_above_cut(ranked, F.col(by).cast("bigint"), k)
    return reached.orderBy(F.desc(by), F.asc(post_id)).limit(k)


def scatter_frame(
    scored: DataFrame, settings: SampleSettings | None = None, ts: str = "timestamp"
) -> DataFrame:
    """Points of the sentiment scatter, drawn from a bounded uniform sample.

    The sample reads its input twice; the few columns of a point are stored first, so that
    cleaning and scoring run once.
    """
    score = F.col("sentiment_score")
    colour = (
        F.when(score > COLOUR_BAND, F.lit(UP_COLOUR))
        .when(score < -COLOUR_BAND, F.lit(DOWN_COLOUR))
        .otherwise(F.lit(FLAT_COLOUR))
    )
    size = (
        F.least(F.col("engagement_score"), F.lit(ENGAGEMENT_CEILING)) / F.lit(SIZE_DIVISOR)
        + F.lit(SIZE_OFFSET)
    )
    points = scored.select("post_id", ts, "sentiment_score", "engagement_score")
    points = Scratch(scored.sparkSession, "scatter").put(points, "points")
    return uniform_sample(points, settings).select(
        "post_id",
        F.col(ts).alias("ts"),
        "sentiment_score",
        size.alias("size"),
        colour.alias("colour"),
    )
