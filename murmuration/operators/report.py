"""Per-tag quality report: collected against target, removals, sentiment and engagement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmuration.config import DEFAULT, CollectionSettings
from murmuration.operators.ingest import target_column

DEVANAGARI_SCRIPTS = ("devanagari", "devanagari_mixed")


def _percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def tag_report(
    raw: DataFrame, scored: DataFrame, settings: CollectionSettings | None = None
) -> DataFrame:
    """One row per tag that was seen or is a configured hashtag.

    Raw posts, scored posts and configured tags are stacked and reduced by one
    grouping: no joins, a single shuffle of one partial row per tag and task.
    """
    settings = settings or DEFAULT.collection
    tag = F.col("primary_hashtag").alias("hashtag")
    collected = raw.select(tag, F.lit(1).alias("raw"), F.lit(0).alias("kept"))
    remaining = scored.select(
        tag,
        F.lit(0).alias("raw"),
        F.lit(1).alias("kept"),
        F.col("engagement_score").cast("double").alias("engagement"),
        F.col("sentiment_label").alias("label"),
        F.col("script").isin(*DEVANAGARI_SCRIPTS).alias("devanagari"),
    )
    wanted = raw.sparkSession.createDataFrame(
        [(t, 0, 0) for t in settings.hashtags], "hashtag string, raw int, kept int"
    )
    stacked = collected.unionByName(remaining, allowMissingColumns=True).unionByName(
        wanted, allowMissingColumns=True
    )

    def share(condition: Column) -> Column:
        counted = F.when(F.col("kept") == 1, F.when(condition, 100.0).otherwise(0.0))
        return F.round(F.avg(counted), 1)

    sums = (
        stacked.where(F.col("hashtag").isNotNull())
        .groupBy("hashtag")
        .agg(
            F.sum("raw").alias("raw_collected"),
            F.sum("kept").alias("after_clean_dedup"),
            F.round(F.avg("engagement"), 1).alias("avg_engagement"),
            share(F.col("label") == "bullish").alias("pct_bullish"),
            share(F.col("label") == "bearish").alias("pct_bearish"),
            share(F.col("label") == "neutral").alias("pct_neutral"),
            share(F.col("devanagari")).alias("pct_devanagari_or_mixed"),
        )
        .withColumn("target", target_column("hashtag", settings))
        .withColumn("removed_clean_dedup", F.col("raw_collected") - F.col("after_clean_dedup"))
    )
    return sums.select(
        "hashtag",
        "target",
        "raw_collected",
        F.round(_percent(F.col("raw_collected"), F.col("target")), 1).alias("pct_of_target"),
        "after_clean_dedup",
        "removed_clean_dedup",
        F.round(_percent(F.col("removed_clean_dedup"), F.col("raw_collected")), 1).alias(
            "pct_removed"
        ),
        "avg_engagement",
        "pct_bullish",
        "pct_bearish",
        "pct_neutral",
        "pct_devanagari_or_mixed",
    )


def report_total(report: DataFrame) -> DataFrame:
    sums = report.agg(
        F.coalesce(F.sum("raw_collected"), F.lit(0)).alias("collected"),
        F.coalesce(F.sum("target"), F.lit(0)).alias("target"),
    )
    return sums.withColumn(
        "pct_of_target", F.round(_percent(F.col("collected"), F.col("target")), 1)
    )


def shortfalls(report: DataFrame) -> DataFrame:
    """Tags below their target, compared exactly and not by the rounded percentage."""
    return report.where(F.col("raw_collected") < F.col("target")).select(
        "hashtag",
        "target",
        "raw_collected",
        (F.col("target") - F.col("raw_collected")).alias("missing"),
        "pct_of_target",
    )


def _cell(column: str, suffix: str = "") -> Column:
    value = F.col(column).cast("string")
    return F.coalesce(F.concat(value, F.lit(suffix)), F.lit("-"))


def markdown_lines(report: DataFrame, settings: CollectionSettings | None = None) -> DataFrame:
    """The report as Markdown lines; sort by (position, hashtag) to read it in order."""
    settings = settings or DEFAULT.collection
    spark = report.sparkSession

    def fixed(position: int, *texts: str) -> DataFrame:
        rows = [(position + i, "", t) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "position int, hashtag string, line string")

    columns = [
        ("Tag", F.concat(F.lit("#"), F.col("hashtag"))),
        ("Target", _cell("target")),
        ("Collected", _cell("raw_collected")),
        ("Of target", _cell("pct_of_target", "%")),
        ("Kept", _cell("after_clean_dedup")),
        ("Bullish", _cell("pct_bullish", "%")),
        ("Bearish", _cell("pct_bearish", "%")),
        ("Neutral", _cell("pct_neutral", "%")),
        ("Mean engagement", _cell("avg_engagement")),
    ]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[c for _, c in columns]), F.lit(" |"))
    head = fixed(
        0,
        "# Collection quality by tag",
        "",
        f"Goal: {settings.posts_per_hashtag} posts for each of {', '.join(settings.hashtags)} "
        f"within {settings.lookback_hours} hours.",
        "",
    )
    total = report_total(report).select(
        F.lit(10).alias("position"),
        F.lit("").alias("hashtag"),
        F.concat(
            F.lit("All tags: "), _cell("collected"), F.lit(" of "), _cell("target"),
            F.lit(" posts ("), _cell("pct_of_target", "%"), F.lit(")."),
        ).alias("line"),
    )
    table_head = fixed(
        20,
        "",
        "| " + " | ".join(name for name, _ in columns) + " |",
        "|" + "---|" * len(columns),
    )
    body = report.select(F.lit(30).alias("position"), "hashtag", row.alias("line"))
    notes_head = fixed(40, "", "## Tags below their target", "")
    notes = shortfalls(report).select(
        F.lit(50).alias("position"),
        "hashtag",
        F.concat(
            F.lit("- #"), F.col("hashtag"), F.lit(": "), _cell("missing"), F.lit(" of "),
            _cell("target"), F.lit(" posts missing."),
        ).alias("line"),
    )
    none_short = notes.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit(50).alias("position"), F.lit("").alias("hashtag"), F.lit("Every tag has reached its target.").alias("line")
    )
    parts = [head, total, table_head, body, notes_head, notes, none_short]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return lines
