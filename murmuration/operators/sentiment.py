"""Lexicon sentiment of cleaned posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.functions import lexicon


def with_sentiment(cleaned: DataFrame) -> DataFrame:
    """Add ``sentiment_score`` and ``sentiment_label`` from ``content_clean`` and ``emojis``."""
    terms, emojis = F.col("_terms"), F.col("emojis")
    return (
        cleaned.withColumn("_terms", lexicon.term_hits(F.col("content_clean")))
        .withColumns(
            {
                "_bull": lexicon.bull_hits(terms, emojis),
                "_bear": lexicon.bear_hits(terms, emojis),
            }
        )
        .withColumn("sentiment_score", lexicon.score_from_hits(F.col("_bull"), F.col("_bear")))
        .withColumn("sentiment_label", lexicon.label_of(F.col("sentiment_score")))
        .drop("_terms", "_bull", "_bear")
    )


def count_values(posts: DataFrame, column: str) -> DataFrame:
    """How often each value of a column occurs, e.g. the sentiment split or the script mix."""
    return posts.groupBy(column).agg(F.count(F.lit(1)).alias("posts"))
