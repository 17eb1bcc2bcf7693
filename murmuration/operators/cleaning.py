"""Cleaning of post text and the columns isolated from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.functions import text

# Fixed value: shortest cleaned text that is still a post.
MIN_CLEAN_LENGTH = 3


def clean_posts(posts: DataFrame) -> DataFrame:
    """Isolate emoji, script and cashtags of the raw text, clean it, drop what becomes too short.

    ``content_clean`` is the NFKC form without URLs and emoji, with single
    blanks. Posts without content are left out. ``username`` and ``hashtags``
    are normalised when the frame has them.

    Cleaning is one Arrow step. The length test sits inside a generator, since a plain filter on the
    result would be pushed below that step and run it twice.
    """
    content = F.col("content")
    posts = posts.where(content.isNotNull()).withColumn("_cleaned", text.cleaned(content))
    guard = F.col("_cleaned.near_emoji")
    long_enough = F.filter(
        F.array("_cleaned.clean"), lambda t: F.char_length(t) >= MIN_CLEAN_LENGTH
    )
    posts = posts.select("*", F.explode(long_enough).alias("content_clean"))
    derived = {
        "content_raw": content,
        "emojis": text.extract_emojis(content, guard),
        "script": text.script_of(content),
        "cashtags_extra": text.cashtags(content),
    }
    if "username" in posts.columns:
        derived["username"] = F.lower(text.trimmed(F.col("username")))
    if "hashtags" in posts.columns:
        derived["hashtags"] = text.sorted_tag_set(F.col("hashtags"))
    return posts.withColumns(derived).drop("_cleaned")
