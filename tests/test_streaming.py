from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from murmuration.config import StorageSettings
from murmuration.operators import ingest, signal
from murmuration.operators.cleaning import clean_posts
from murmuration.operators.sentiment import with_sentiment
from murmuration.plans import queries
from murmuration.schema import DELIVERED_POSTS, RAW_POSTS
from murmuration.sources import given_tables
from murmuration.sources.store import PostStore
from murmuration.streaming import jobs

START = datetime(2024, 1, 1)


def delivered(spark, minutes, copies=1):
    rows = [
        (f"p{m}", "u", f"buy number {m}", START + timedelta(minutes=m), m % 9, 1, 0, None,
         "a" if m % 3 else "b", None, START)
        for m in minutes
        for _ in range(copies)
    ]
    return spark.createDataFrame(rows, DELIVERED_POSTS)


def run(spark, tmp_path, batches, start, schema=DELIVERED_POSTS):
    landing, sink, state = (str(tmp_path / n) for n in ("landing", "sink", "state"))
    for batch in batches:
        batch.write.mode("append").parquet(landing)
        start(jobs.landed(spark, landing, schema), sink, state).awaitTermination()
    return sink


def test_ingest_resumes_without_loss_or_repeat(spark, tmp_path):
    batches = [delivered(spark, range(0, 50)), delivered(spark, range(50, 80))]
    sink = run(spark, tmp_path, batches, jobs.ingest_posts)
    stored = spark.read.schema(RAW_POSTS).parquet(sink)
    assert stored.count() == 80
    expected = ingest.normalise_delivered(batches[0].union(batches[1]))
    assert stored.agg(F.sum("engagement_score")).first() == expected.agg(F.sum("engagement_score")).first()


def test_ingest_adds_one_file_per_folder_and_batch(spark, tmp_path):
    batches = [delivered(spark, range(0, 50)).repartition(7), delivered(spark, range(50, 80)).repartition(7)]
    sink = run(spark, tmp_path, batches, jobs.ingest_posts)
    files = list((tmp_path / "sink").rglob("*.parquet"))
    folders = {f.parent for f in files}
    assert sink and len(folders) == 2 and len(files) == 2 * len(folders)


def test_ingest_of_batches_shuffles_no_texts_and_replaces_a_batch(spark, tmp_path):
    """A large micro-batch is written by the tasks that scan it, which are as many as its rows ask for, and a small one is grouped."""
    settings = StorageSettings(batch_column="batch", rows_per_file=50, rows_per_task=25)
    batches = [delivered(spark, range(0, 1000)).repartition(40), delivered(spark, range(1000, 1010)), delivered(spark, [])]
    landing, sink, state = (str(tmp_path / n) for n in ("landing", "sink", "state"))
    for batch in batches:
        batch.write.mode("append").parquet(landing)
        jobs.ingest_landed(jobs.landed(spark, landing), sink, state, landing, settings)
    assert len(list((tmp_path / "sink" / "batch=0").rglob("*.parquet"))) > 60
    assert len(list((tmp_path / "sink" / "batch=1").rglob("*.parquet"))) == 2
    first = ingest.normalise_delivered(batches[0])
    PostStore(spark, sink, settings).write_batch(first, 0)  # run again after a failure
    stored = PostStore(spark, sink, settings).load()
    want = ingest.normalise_delivered(batches[0].union(batches[1])).select(*stored.columns)
    assert stored.count() == 1010 and stored.exceptAll(want).isEmpty()
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None


def test_stream_ingest_stores_batches(spark, tmp_path, monkeypatch):
    small_tables(spark, tmp_path)
    start, given = jobs.ingest_posts, []
    monkeypatch.setattr(jobs, "ingest_posts", lambda stream, path, state, settings=None: given.append(settings) or start(stream, path, state, settings))
    assert queries.stream_ingest(spark, str(tmp_path)).agg(F.sum("posts")).first()[0] == 40
    assert [s.batch_column for s in given] == ["batch", "batch"]


def test_composite_of_an_empty_sink(spark, tmp_path):
    (tmp_path / "sink").mkdir()
    assert jobs.composite_of_finalised(spark, str(tmp_path / "sink")).count() == 0


def scored_buckets(posts):
    return {(r["symbol"], r["window_start"]): (r["tweet_count"], r["total_engagement"], round(r["sentiment_signal"], 9), round(r["ci_lower"], 9)) for r in posts.collect()}


def test_late_posts_correct_their_buckets(spark, tmp_path):
    """The oldest posts come last and the first file again under its own number; compaction in between changes nothing."""
    batches = [ingest.with_engagement(delivered(spark, m)) for m in (range(200, 301), range(90, 210), range(0, 95))]
    everything = batches[0].union(batches[1]).union(batches[2])
    want = scored_buckets(signal.bucket_sentiment(with_sentiment(clean_posts(everything))))
    path = str(tmp_path / "plain")
    assert jobs.current_buckets(spark, path).count() == 0 and jobs.compact_states(spark, path) == -1
    for number, batch in enumerate(batches):
        jobs.add_states(batch, number, path)
    jobs.add_states(batches[2], 2, path)  # run again
    assert scored_buckets(jobs.current_buckets(spark, path)) == want
    assert jobs.compact_states(spark, path) == 2
    assert scored_buckets(jobs.current_buckets(spark, path)) == want and jobs.compact_states(spark, path) == 2
    sink = run(spark, tmp_path, batches, lambda s, p, state: jobs.write_states(s, p, state), batches[0].schema)
    assert scored_buckets(jobs.current_buckets(spark, sink)) == want


def test_composite_by_batches_equals_the_whole_and_replays(spark, tmp_path):
    posts = ingest.with_engagement(delivered(spark, range(0, 900, 2)))
    buckets = signal.bucket_sentiment(with_sentiment(clean_posts(posts))).cache()
    key = lambda df: sorted((r["symbol"], str(r["window_start"]), r["tweet_count"], round(r["volume_zscore"], 9), round(r["composite_score"], 9)) for r in df.collect())
    want = key(signal.with_composite(signal.with_volume_baseline(buckets)))
    path = str(tmp_path / "out")
    assert jobs.read_composite(spark, path).count() == 0
    cuts = [0, 100, 130, 500, 510, 901]
    parts = [buckets.where((F.col("window_start") >= START + timedelta(minutes=a)) & (F.col("window_start") < START + timedelta(minutes=b))) for a, b in zip(cuts, cuts[1:])]
    for number, part in enumerate(parts):
        jobs.add_composite(part, number, path)
        jobs.add_composite(part, number, path)  # run again after a failure
    assert key(jobs.read_composite(spark, path)) == want
    carried = spark.read.parquet(*[f"{path}/carried/slot-{k}" for k in range(3)])
    assert carried.count() <= 3 * 7 * 2  # symbols x buckets of a baseline, not the history


def test_dedup_across_batches(spark, tmp_path):
    batches = [delivered(spark, range(0, 30), copies=3), delivered(spark, range(25, 40), copies=2)]
    sink = run(
        spark, tmp_path, batches,
        lambda s, path, state: jobs.write_unique(jobs.exact_dedup_stream(s, "1 hour"), path, state),
    )
    ids = [r["post_id"] for r in spark.read.parquet(sink).collect()]
    assert len(ids) == len(set(ids)) == 40


def test_buckets_equal_the_batch_except_the_open_tail(spark, tmp_path):
    slices = [range(0, 100), range(100, 200), range(200, 301)]
    batches = [delivered(spark, s) for s in slices]
    batches = [ingest.with_engagement(b) for b in batches]
    sink = run(
        spark, tmp_path, batches,
        lambda s, path, state: jobs.write_buckets(jobs.finalised_buckets(s, "10 minutes"), path, state),
        batches[0].schema,
    )
    everything = batches[0].union(batches[1]).union(batches[2])
    whole = signal.bucket_sentiment(with_sentiment(clean_posts(everything)))
    closed = START + timedelta(minutes=290)
    key = lambda r: (r["symbol"], r["window_start"], r["tweet_count"], round(r["sentiment_signal"], 9))
    expected = {key(r) for r in whole.collect() if r["window_start"] + timedelta(minutes=15) <= closed}
    assert {key(r) for r in spark.read.parquet(sink).collect()} == expected
    composite = jobs.composite_of_finalised(spark, sink)
    assert composite.count() == len(expected) and "composite_score" in composite.columns


def test_dedup_by_places_appends_whole_posts_and_reads_only_their_files(spark, tmp_path):
    batches = [delivered(spark, range(0, 30), copies=3).repartition(3), delivered(spark, range(25, 40), copies=2).repartition(2)]
    landing = tmp_path / "land ing 100%"
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")
    for batch in batches:
        old = list(landing.glob("*.parquet"))
        batch.write.mode("append").parquet(str(landing))
        for file in old:
            file.write_bytes(b"not to be read again")
        stream = jobs.exact_dedup_stream(jobs.placed_posts(jobs.landed(spark, str(landing))), "1 hour")
        jobs.write_unique(stream, sink, state, landing=str(landing)).awaitTermination()
    got = spark.read.schema(DELIVERED_POSTS).parquet(sink).select(*DELIVERED_POSTS.fieldNames())
    want = delivered(spark, range(0, 40))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_batch_of_places_replays_and_misses_no_file(spark, tmp_path):
    """Rows beyond the first bitmap of a file, a batch that is run again, one without rows, and a file that has gone."""
    landing, sink = str(tmp_path / "landing"), str(tmp_path / "sink")
    many = spark.range(0, 70_000, 1, 1).withColumn("text", F.concat(F.lit("t"), "id"))
    many.write.parquet(landing)
    places = jobs.rows.placed(spark.read.schema(many.schema).parquet(landing), ["id"]).where("id % 32768 in (0, 32767)")
    for _ in range(2):
        jobs.add_landed(places, 0, sink, landing, many.schema)
    jobs.add_landed(places.where("id < 0"), 1, sink, landing, many.schema)
    got = spark.read.schema(many.schema).parquet(sink)
    assert sorted(r["text"] for r in got.collect()) == sorted(f"t{n}" for n in (0, 32767, 32768, 65535, 65536))
    gone = places.withColumn("_file", F.concat("_file", F.lit("x")))
    with pytest.raises(RuntimeError, match="5 of 5"):
        jobs.add_landed(gone, 2, sink, landing, many.schema)


def small_tables(spark, path, posts=40):
    documents = [(n, f"text {n}", None if n == 2 else "en", "web", 6) for n in range(4)]
    events = [(n, START + timedelta(minutes=n), n, "click", float(n), "{}") for n in range(posts)]
    spark.createDataFrame(documents, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{path}/documents.parquet")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(events, schema).write.parquet(f"{path}/events.parquet")


@pytest.mark.parametrize("query", ["stream_ingest", "stream_states"])
def test_halves_meet_at_one_value(spark, tmp_path, monkeypatch, query):
    """A cut that each part evaluates anew is approximate, so that posts may fall between two parts."""
    small_tables(spark, tmp_path)
    land, plans, landed = queries._land, [], []
    def look(part, path):
        plans.append(part._jdf.queryExecution().optimizedPlan().toString())
        landed.append(part.count())
        land(part, path)
    monkeypatch.setattr(queries, "_land", look)
    getattr(queries, query)(spark, str(tmp_path))
    assert sum(landed) == 40 and all(landed) and not any("percentile_approx" in plan for plan in plans)


@pytest.mark.parametrize("query", ["stream_dedup", "stream_states"])
def test_streams_without_posts(spark, tmp_path, query):
    small_tables(spark, tmp_path, 0)
    assert getattr(queries, query)(spark, str(tmp_path)).count() == 0


def test_stream_dedup_shuffles_no_texts(spark, tmp_path, monkeypatch):
    small_tables(spark, tmp_path)
    write, streamed = jobs.write_unique, []
    monkeypatch.setattr(jobs, "write_unique", lambda posts, *rest, **named: streamed.append(posts.columns) or write(posts, *rest, **named))
    got = queries.stream_dedup(spark, str(tmp_path))
    posts = given_tables.posts(spark, str(tmp_path))
    want = {r["post_id"]: r["content"] for r in posts.collect()}
    assert {r["post_id"]: r["n_chars"] for r in got.collect()} == {k: len(v) for k, v in want.items()} and got.count() == len(want) == 40
    assert len(streamed) == 2 and not any("content" in columns for columns in streamed)
    tags = [r["primary_hashtag"] for r in given_tables.cross_posted(posts).collect()]
    assert sorted(tags, key=str) == sorted(["click"] * 40 + ["via_en"] * 30 + [None] * 10, key=str)
