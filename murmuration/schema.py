"""The fixed schema of stored raw posts.

Partition values are re-inferred by Spark on read ("007" would come back as an
int), so readers always pass this schema instead of relying on inference.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_POSTS = T.StructType(
    [
        T.StructField("post_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("display_name", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("like_count", T.LongType()),
        T.StructField("retweet_count", T.LongType()),
        T.StructField("reply_count", T.LongType()),
        T.StructField("view_count", T.LongType()),
        T.StructField("hashtags", T.ArrayType(T.StringType())),
        T.StructField("mentions", T.ArrayType(T.StringType())),
        T.StructField("primary_hashtag", T.StringType()),
        T.StructField("is_reply", T.BooleanType()),
        T.StructField("lang", T.StringType()),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("scrape_date", T.StringType()),
        T.StructField("engagement_score", T.LongType()),
    ]
)

# What a collector delivers; the remaining raw columns are derived on ingest.
DELIVERED_POSTS = T.StructType(
    [
        f
        for f in RAW_POSTS
        if f.name
        not in {"display_name", "hashtags", "mentions", "is_reply", "scrape_date", "engagement_score"}
    ]
)
