"""Posts derived from the given tables.

The given texts contain no emoji, tags, links or Devanagari, so each event
becomes a post: the whole text of its document plus one of a few fixed
endings. The same rule is spelled as a DataFrame and as SQL, so both engines
see the same posts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Endings by event_id % ENDING_CYCLE; ids without an entry get none.
ENDING_CYCLE = 12
ENDINGS = {
    0: " bullish breakout rally 🚀 #Nifty50",
    1: " crash, stop loss hit 📉📉 #banknifty #BankNifty",
    2: " read http://a.example/x1 and www.example.org today",
    3: " शेयर ऊपर गया #शेयर",
    4: " $NIFTY $ABCDEFGHIJKL long $bank",
    5: " generally, the weather along here",
    6: " buy 🔥 sell 🔴 @Some_User",
    7: "   spaced    out   ",
    # compatibility characters: a ligature, two signs, full-width letters, a decomposed accent
    8: " a \ufb01ne \u2122 mark, \u24c2 and \uff23\uff41\uff46e\u0301",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Posts that a task makes on average at most. Each has a text of its own, and what orders posts holds the whole of them.
POSTS_PER_TASK = 128_000


def _documents(spark: SparkSession, sf_dir: str, tasks: int = 1) -> DataFrame:
    """Documents spread over all tasks, ``tasks`` at least; the given file is a single split."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return table(spark, sf_dir, "documents").repartition(max(partitions, tasks), "doc_id")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per event, with the text of document ``event_id % number of documents``."""
    events = table(spark, sf_dir, "events")
    documents = _documents(spark, sf_dir, -(-events.count() // POSTS_PER_TASK)).select("doc_id", "text", "lang")
    n_documents = table(spark, sf_dir, "documents").agg(F.count(F.lit(1))).scalar()
    events = events.withColumn("doc_id", F.col("event_id") % n_documents)
    turn = F.col("event_id") % ENDING_CYCLE
    ending = F.lit("")
    for key, value in ENDINGS.items():
        ending = F.when(turn == key, F.lit(value)).otherwise(ending)
    return events.join(documents, "doc_id").select(
        F.col("event_id").cast("string").alias("post_id"),
        F.concat(F.lit(" User_"), F.col("user_id").cast("string"), F.lit(" ")).alias("username"),
        F.concat("text", ending).alias("content"),
        F.col("ts").alias("timestamp"),
        F.floor("value").alias("like_count"),
        (F.col("event_id") % 7).alias("retweet_count"),
        (F.col("event_id") % 3).alias("reply_count"),
        F.col("event_type").alias("primary_hashtag"),
        "lang",
    )


POSTS_SQL = """
SELECT CAST(e.event_id AS VARCHAR) AS post_id,
       concat(' User_', CAST(e.user_id AS VARCHAR), ' ') AS username,
       concat(d.text, CASE e.event_id % {cycle} {cases} ELSE '' END) AS content,
       e.ts AS timestamp,
       CAST(floor(e.value) AS BIGINT) AS like_count,
       e.event_id % 7 AS retweet_count,
       e.event_id % 3 AS reply_count,
       e.event_type AS primary_hashtag,
       d.lang AS lang
FROM (SELECT *, event_id % (SELECT count(*) FROM documents) AS doc_id FROM events) e
JOIN documents d ON d.doc_id = e.doc_id
""".format(
    cycle=ENDING_CYCLE, cases=" ".join(f"WHEN {k} THEN '{v}'" for k, v in ENDINGS.items())
)


def article_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per document with its undecorated text, engagement and time of the equal event.

    Real copies and near copies among the documents stay as they are.
    """
    documents = _documents(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    return documents.join(events, documents.doc_id == events.event_id, "left").select(
        F.col("doc_id").cast("string").alias("post_id"),
        F.col("text").alias("content"),
        F.col("ts").alias("timestamp"),
        F.floor("value").alias("engagement_score"),
        F.col("event_type").alias("primary_hashtag"),
    )


ARTICLE_POSTS_SQL = """
SELECT CAST(d.doc_id AS VARCHAR) AS post_id,
       d.text AS content,
       e.ts AS timestamp,
       CAST(floor(e.value) AS BIGINT) AS engagement_score,
       e.event_type AS primary_hashtag
FROM documents d LEFT JOIN events e ON d.doc_id = e.event_id
"""


def cross_posted(all_posts: DataFrame) -> DataFrame:
    """Every post twice, the second time as found under another tag."""
    other = F.concat(F.lit("via_"), F.col("lang"))
    return all_posts.withColumn("primary_hashtag", F.explode(F.array("primary_hashtag", other)))
