from datetime import datetime, timedelta

from pyspark.sql import functions as F

from murmuration.config import CollectionSettings, SampleSettings
from murmuration.operators import ingest, sampling

START = datetime(2024, 1, 1)


def posts(spark, rows):
    return spark.createDataFrame(
        rows, "post_id string, primary_hashtag string, timestamp timestamp, engagement_score bigint"
    )


def test_engagement_does_not_overflow(spark):
    df = spark.createDataFrame(
        [(2_000_000_000, 2_000_000_000, 2_000_000_000, datetime(2024, 3, 9, 23, 59))],
        "like_count int, retweet_count int, reply_count int, timestamp timestamp",
    )
    row = ingest.with_engagement(df).first()
    assert (row["engagement_score"], row["scrape_date"]) == (12_000_000_000, "2024-03-09")


def test_cards_without_an_id_are_left_out(spark):
    df = spark.createDataFrame(
        [("/u/status/5", "1,000 Likes", "x", "3"), ("/u", "1", "1", "1")],
        "link string, like_label string, retweet_label string, reply_label string",
    )
    assert [tuple(r) for r in ingest.parse_cards(df).collect()] == [("5", 1000, 0, 3)]


def test_lookback_includes_the_boundary(spark):
    rows = [(str(h), "a", START + timedelta(hours=h), 0) for h in range(30)]
    kept = ingest.within_lookback(posts(spark, rows), START + timedelta(hours=29), 24)
    assert kept.count() == 25


def test_lookback_reaches_the_scan(spark, tmp_path, plan_of):
    path = str(tmp_path / "p")
    posts(spark, [("1", "a", START, 0)]).write.parquet(path)
    plan = plan_of(ingest.within_lookback(spark.read.parquet(path), START, 24))
    assert "GreaterThanOrEqual(timestamp" in plan


SMALL = CollectionSettings(hashtags=("hot", "cold"), posts_per_hashtag=5, bonus_target=2)


def capped(df, **kw):
    found = {}
    for r in ingest.cap_per_tag(df, SMALL, **kw).collect():
        found.setdefault(r["primary_hashtag"], set()).add(r["post_id"])
    return found


def test_cap_keeps_the_newest_of_each_tag(spark):
    rows = [(f"h{i:03}", "hot", START + timedelta(minutes=i), 0) for i in range(200)]
    rows += [("c1", "cold", START, 0), ("x1", "extra", START, 0), ("x2", "extra", START, 0)]
    rows += [("x3", "extra", START + timedelta(days=1), 0), ("n", None, START, 0)]
    df = posts(spark, rows)
    expected = {"hot": {f"h{i}" for i in range(195, 200)}, "cold": {"c1"}, "extra": {"x3", "x1"}}
    assert capped(df) == expected
    assert capped(df, salts=1) == expected


def test_cap_with_all_posts_in_one_instant(spark):
    df = posts(spark, [(f"{i:03}", "hot", START, 0) for i in range(50)])
    assert capped(df) == {"hot": {"000", "001", "002", "003", "004"}}


def test_cap_leaves_old_posts_of_a_busy_hour_in_the_scan_at_the_default_target(spark):
    df = spark.range(40_000).select(
        F.format_string("%05d", "id").alias("post_id"),
        F.when(F.col("id") % 1000 == 0, "quiet").otherwise("nifty50").alias("primary_hashtag"),
        (F.lit(START) + F.expr("make_dt_interval(0, 0, 0, id / 20.0)")).alias("timestamp"),
    )
    left = {r["primary_hashtag"]: r["count"] for r in ingest.since_cutoff(df).groupBy("primary_hashtag").count().collect()}
    assert left["quiet"] == 40 and 2000 <= left["nifty50"] <= 2000 + 20
    newest = df.where("primary_hashtag = 'nifty50'").orderBy(F.desc("timestamp"), "post_id").limit(2000)
    kept = ingest.cap_per_tag(df)
    assert kept.count() == 2040 and newest.join(kept, "post_id", "left_anti").isEmpty()


def test_cut_off_counts_the_newer_hours(spark):
    rows = [(f"new{i}", "hot", START + timedelta(hours=1), 0) for i in range(3)]
    rows += [(f"{i:02}", "hot", START + timedelta(seconds=i, milliseconds=500), 0) for i in range(60)]
    left = {r["post_id"] for r in ingest.since_cutoff(posts(spark, rows), SMALL).collect()}
    assert left == {"new0", "new1", "new2", "59", "58"}
    assert ingest.since_cutoff(posts(spark, []), SMALL).count() == 0


def test_collected_lists_silent_tags(spark):
    rows = [(str(i), "hot", START, 0) for i in range(6)] + [("y", "other", START, 0)]
    found = {r["tag"]: (r["collected"], r["target"], r["short_of_target"])
             for r in ingest.collected_per_tag(posts(spark, rows), SMALL).collect()}
    assert found["hot"] == (6, 5, False)
    assert found["cold"] == (0, 5, True)
    assert found["other"] == (1, 2, True)
    assert found["NIFTY"] == (0, 2, True)


def test_sample_has_the_exact_size_and_ignores_partitioning(spark):
    df = posts(spark, [(f"p{i}", "a", START, i) for i in range(2000)])
    drawn = [
        {r["post_id"] for r in sampling.uniform_sample(d, SampleSettings(size=100)).collect()}
        for d in (df, df.repartition(13))
    ]
    assert drawn[0] == drawn[1] and len(drawn[0]) == 100
    other = sampling.uniform_sample(df, SampleSettings(size=100, seed=7))
    assert {r["post_id"] for r in other.collect()} != drawn[0]


def test_sample_of_fewer_rows_is_everything(spark):
    df = posts(spark, [(str(i), "a", START, i) for i in range(10)])
    assert sampling.uniform_sample(df).count() == 10
    assert sampling.uniform_sample(df.where("false")).count() == 0


def test_sample_survives_equal_ids(spark):
    df = posts(spark, [("same", "a", START, i) for i in range(300)])
    assert sampling.uniform_sample(df, SampleSettings(size=50)).count() == 50


def test_top_posts_with_ties(spark):
    df = posts(spark, [(f"{i:02}", "a", START, 1 if i else 9) for i in range(60)])
    top = sampling.top_posts(df, 5).collect()
    assert [r["post_id"] for r in top] == ["00", "01", "02", "03", "04"]
    assert sampling.top_posts(df.where("false"), 5).count() == 0


def test_scatter_sizes_and_strict_colour_bounds(spark):
    df = posts(spark, [("1", "a", START, 1000), ("2", "a", START, 80), ("3", "a", START, 0)])
    df = df.withColumn(
        "sentiment_score",
        F.when(F.col("post_id") == "1", 0.2).when(F.col("post_id") == "2", -0.3).otherwise(0.21),
    )
    rows = {r["post_id"]: (r["size"], r["colour"]) for r in sampling.scatter_frame(df).collect()}
    assert rows == {"1": (29.0, "#9e9e9e"), "2": (14.0, "#c62828"), "3": (4.0, "#2e7d32")}


def test_lookback_prunes_date_folders(spark, plan_of, tmp_path):
    df = posts(spark, [(str(i), "hot", START - timedelta(days=i), 0) for i in range(4)])
    df.withColumn("scrape_date", F.date_format("timestamp", "yyyy-MM-dd")).write.partitionBy("scrape_date").parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p")).withColumn("scrape_date", F.col("scrape_date").cast("string"))
    recent = ingest.within_lookback(stored, START, 24)
    assert recent.count() == 2
    assert "PartitionFilters: []" not in plan_of(recent)


def test_cards_give_time_and_plain_name(spark):
    cards = spark.createDataFrame(
        [("/u/status/5", "1 like", "", "", "2024-01-02T03:04:05Z", "@some_one"), ("/u", "", "", "", None, None)],
        "link string, like_label string, retweet_label string, reply_label string, time_label string, username string",
    )
    (row,) = ingest.parse_cards(cards).collect()
    assert (row["post_id"], row["timestamp"], row["username"]) == ("5", datetime(2024, 1, 2, 3, 4, 5), "some_one")


def test_ranges_rise_with_the_value(spark):
    values = sorted({s * ((1 << k) + d) for k in range(62) for d in (-1, 0, 1) for s in (-1, 1)} | set(range(-300, 300)))
    df = spark.createDataFrame([(v,) for v in values], "v long")
    found = [r.r for r in df.select("v", sampling.magnitude_range(F.col("v")).alias("r")).orderBy("v").collect()]
    assert found == sorted(found) and len(set(found)) < 2 * 64 * 256
