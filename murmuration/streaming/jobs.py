"""Continuous forms of ingest, exact dedup and the bucketed signal.

Every job reads files with a declared schema and commits to a Parquet sink
through a checkpoint, so a restarted job neither loses nor repeats rows. The
default trigger works off what has landed and stops, which suits a scheduler;
pass ``{"processingTime": "1 minute"}`` to keep a job running.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from murmuration.config import DEFAULT, SignalSettings, StorageSettings
from murmuration.operators import cleaning, ingest, rows, sentiment, signal
from murmuration.schema import DELIVERED_POSTS
from murmuration.sources.store import PostStore, parquet_options

AVAILABLE = {"availableNow": True}


def landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType = DELIVERED_POSTS,
    file_format: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(file_format)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _to_parquet(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict,
    partition_columns: tuple[str, ...] = (),
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
        .trigger(**trigger)
    )
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    return writer.start()


def ingest_posts(
    delivered: DataFrame,
    path: str,
    checkpoint: str,
    settings: StorageSettings | None = None,
    trigger: dict = AVAILABLE,
    salts: int = 1,
) -> StreamingQuery:
    """Derive the stored columns of delivered posts and append them to a post store.

    Posts are grouped by folder first, so a micro-batch adds ``salts`` files to a folder at most. What
    a dominating folder gets is bounded by the micro-batch (``max_files``); more salts split it further.

    With ``settings.batch_column`` each micro-batch is a batch of a ``PostStore`` instead, which replaces it if it is run again: a large one is
    written by the tasks that scan it, so that no text is shuffled. A folder written without has Spark's log of its files and does not take them.
    """
    settings = settings or DEFAULT.storage
    if settings.batch_column is not None:
        store = PostStore(delivered.sparkSession, path, settings)
        return _per_batch(delivered, lambda batch, number: store.write_batch(ingest.normalise_delivered(batch), number), checkpoint, trigger)
    salt = F.pmod(F.xxhash64("post_id"), F.lit(salts))
    grouped = ingest.normalise_delivered(delivered).repartition(*settings.partition_columns, salt)
    return _to_parquet(grouped, path, checkpoint, trigger, settings.partition_columns, parquet_options(settings))


@contextmanager
def _split_by(spark: SparkSession, tasks: int) -> Iterator[None]:
    """Micro-batches that run within scan their files by so many tasks at least, as far as these can be parted."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(tasks))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ingest_landed(delivered: DataFrame, path: str, checkpoint: str, landing: str, settings: StorageSettings | None = None) -> StreamingQuery:
    """``ingest_posts`` of what has come to the folder ``landing`` so far, over once this returns.

    Landed texts may be packed so well that a split of the usual size holds more of them than a task should sort, so the scan is split by their number.
    """
    settings, spark = settings or DEFAULT.storage, delivered.sparkSession
    tasks = -(-_stored(spark, landing, delivered.schema).count() // settings.rows_per_task)
    with _split_by(spark, max(tasks, spark.sparkContext.defaultParallelism)):
        query = ingest_posts(delivered, path, checkpoint, settings)
        query.awaitTermination()
    return query


def placed_posts(posts: DataFrame, key_columns: list[str] | None = None) -> DataFrame:
    """Keys and times of posts landed as Parquet; in place of the other columns, the file and row in which each lies.

    What only decides on posts can shuffle these, and ``write_unique`` fetches the whole posts.
    """
    return rows.placed(posts, [*(key_columns or DEFAULT.storage.key_columns), "timestamp"])


def exact_dedup_stream(
    posts: DataFrame,
    delay: str = "10 minutes",
    key_columns: list[str] | None = None,
    salts: int = 1,
) -> DataFrame:
    """First arrival of each key among posts at most ``delay`` apart.

    Ids are nearly unique, so one pass is enough. For a dominating key, ``salts`` above 1
    adds a pass over salted parts of it, at the price of a second state per key.
    """
    keys = list(key_columns or DEFAULT.storage.key_columns)
    marked = posts.withWatermark("timestamp", delay)
    if salts > 1:
        marked = marked.withColumn("_salt", F.pmod(F.xxhash64("timestamp"), F.lit(salts)))
        marked = marked.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return marked.dropDuplicatesWithinWatermark(keys)


def finalised_buckets(
    posts: DataFrame, delay: str = "10 minutes", settings: SignalSettings | None = None
) -> DataFrame:
    """Signal buckets of a post stream, each emitted once its time is over by ``delay``.

    Cleaning and scoring keep no state; the window sums are reduced per task
    before they reach the state of their bucket.
    """
    scored = sentiment.with_sentiment(cleaning.clean_posts(posts.withWatermark("timestamp", delay)))
    return signal.bucket_sentiment(scored, settings)


def write_buckets(
    buckets: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE
) -> StreamingQuery:
    return _to_parquet(buckets, path, checkpoint, trigger)


def write_unique(
    posts: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict = AVAILABLE,
    landing: str | None = None,
    schema: T.StructType = DELIVERED_POSTS,
) -> StreamingQuery:
    """Append the posts of a stream to a folder.

    With ``landing``, the folder in which posts of this schema land, the stream holds their places (``placed_posts``);
    each micro-batch then fetches its whole posts, as they landed, in the tasks that scan them, so that texts are never shuffled.
    These go to a folder for each micro-batch. A folder written without ``landing`` has Spark's log of its files and does not take them.
    """
    if landing is None:
        return _to_parquet(posts, path, checkpoint, trigger)
    return _per_batch(posts, lambda batch, number: add_landed(batch, number, path, landing, schema), checkpoint, trigger)


def composite_of_finalised(
    spark: SparkSession, path: str, settings: SignalSettings | None = None
) -> DataFrame:
    """Volume baseline and composite over the buckets that the stream has finalised so far.

    A batch window over the bucket table: it holds symbols x buckets rows, not
    posts, and needs no state beyond what the sink already keeps.
    """
    scored = "primary_hashtag string, timestamp timestamp, engagement_score bigint, sentiment_score double"
    schema = signal.bucket_sentiment(spark.createDataFrame([], scored), settings).schema
    buckets = spark.read.schema(schema).parquet(path)
    return signal.with_composite(signal.with_volume_baseline(buckets, settings), settings)


# --- sinks of micro-batches -----------------------------------------------------------------------
#
# A micro-batch writes only folders named after its own number and replaces what they hold, so a batch
# that is run again after a failure changes nothing.

_STATES = "symbol string, window_start timestamp, n bigint, total_engagement bigint, sw double, sws double, swss double, ss double, sss double"


def _per_batch(stream: DataFrame, sink: Callable[[DataFrame, int], object], checkpoint: str, trigger: dict) -> StreamingQuery:
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def _stored(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The Parquet table at a path; no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def add_landed(places: DataFrame, batch_id: int, path: str, landing: str, schema: T.StructType = DELIVERED_POSTS) -> None:
    """The landed posts at the places of one micro-batch, as ``batch=<id>``.

    Only files that hold one of them are read. A landed file must stay as it is until its micro-batch is done.
    """
    spark = places.sparkSession
    rows.bitmaps_of(places).write.mode("overwrite").parquet(f"{path}/_places")
    bitmaps = spark.read.schema(rows.BITMAPS).parquet(f"{path}/_places")
    files = bitmaps.groupBy("_file").agg(F.sum(F.bitmap_count("_bitmap")).alias("posts")).collect()
    whole = spark.read.schema(schema).parquet(landing).where(F.col("_metadata.file_path").isin([f["_file"] for f in files]))
    target = f"{path}/batch={batch_id}"
    rows.at_places(whole, bitmaps).write.mode("overwrite").parquet(target)
    wanted, found = sum(f["posts"] for f in files), spark.read.schema(schema).parquet(target).count()
    if found != wanted:
        raise RuntimeError(f"{wanted - found} of {wanted} posts are no longer at their place in {landing}")


def add_states(batch: DataFrame, batch_id: int, path: str, settings: SignalSettings | None = None) -> None:
    """The bucket states of one micro-batch of posts, as ``batch=<id>``; adding the same batch again replaces them."""
    scored = sentiment.with_sentiment(cleaning.clean_posts(batch))
    signal.bucket_states(scored, settings).write.mode("overwrite").parquet(f"{path}/states/batch={batch_id}")


def write_states(posts: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE, settings: SignalSettings | None = None) -> StreamingQuery:
    """Partial bucket states of a post stream, without watermark: a post that comes late, by any time, still counts in its bucket.

    The stream keeps no state of its own; what grows is a table of symbols x buckets x micro-batches, which
    ``compact_states`` reduces to symbols x buckets.
    """
    return _per_batch(posts, lambda batch, number: add_states(batch, number, path, settings), checkpoint, trigger)


def _open_states(spark: SparkSession, path: str) -> tuple[DataFrame, int, int]:
    """The states that count now, the last batch of the newest base, and the last batch of all (-1 for none)."""
    bases = _stored(spark, f"{path}/bases", "upto bigint")
    base = bases.agg(F.max("upto")).first()[0]
    base = -1 if base is None else base
    later = _stored(spark, f"{path}/states", f"{_STATES}, batch bigint").where(F.col("batch") > base)
    last = later.agg(F.max("batch")).first()[0]
    states = later.drop("batch")
    if base >= 0:
        states = states.unionByName(spark.read.schema(_STATES).parquet(f"{path}/merged/upto={base}"))
    return states, base, base if last is None else last


def current_buckets(spark: SparkSession, path: str, settings: SignalSettings | None = None) -> DataFrame:
    """Signal buckets of all posts that have come so far, open ones and late corrections included."""
    return signal.sentiment_of_states(signal.merge_states(_open_states(spark, path)[0]), settings)


def compact_states(spark: SparkSession, path: str) -> int:
    """Merge all states into a new base and return its last batch. Readers turn to the base once its one-row entry is there, so a
    compaction that fails half-way is not seen; folders of merged batches may be expired by age after that."""
    states, base, last = _open_states(spark, path)
    if last > base:
        signal.merge_states(states).write.mode("overwrite").parquet(f"{path}/merged/upto={last}")
        spark.createDataFrame([(last,)], "upto bigint").coalesce(1).write.mode("append").parquet(f"{path}/bases")
    return last


def add_composite(buckets: DataFrame, batch_id: int, path: str, settings: SignalSettings | None = None) -> None:
    """Baseline and composite of a micro-batch of finalised buckets, as ``signal/batch=<id>``.

    A bucket's baseline needs the few buckets of its symbol before it. These are carried from batch to batch in one of three
    small tables used in turn, each marked with its batch. So a batch reads its own buckets and these, whatever the
    history, and a batch that is run again finds the table of the batch before it untouched.
    """
    settings = settings or DEFAULT.signal
    spark = buckets.sparkSession
    carried = T.StructType([*buckets.schema.fields, T.StructField("batch", T.LongType())])
    slots = [_stored(spark, f"{path}/carried/slot-{k}", carried).where(F.col("batch") < batch_id) for k in range(3)]
    seen = slots[0].unionByName(slots[1]).unionByName(slots[2])
    newest = seen.agg(F.max("batch")).first()[0]
    before = seen.where(F.col("batch") == F.lit(newest).cast("bigint")).drop("batch")
    both = before.withColumn("_new", F.lit(False)).unionByName(buckets.withColumn("_new", F.lit(True)))
    built = signal.with_composite(signal.with_volume_baseline(both, settings), settings)
    work = f"{path}/work/slot-{batch_id % 3}"
    built.write.mode("overwrite").parquet(work)
    built = spark.read.schema(built.schema).parquet(work)
    built.where("_new").drop("_new").write.mode("overwrite").parquet(f"{path}/signal/batch={batch_id}")
    latest = Window.partitionBy("symbol").orderBy(F.desc("window_start"))
    kept = built.withColumn("_nth", F.row_number().over(latest)).where(F.col("_nth") < settings.baseline_buckets)
    kept.select(*buckets.columns, F.lit(batch_id).cast("bigint").alias("batch")).write.mode("overwrite").parquet(f"{path}/carried/slot-{batch_id % 3}")


def write_composite(buckets: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE, settings: SignalSettings | None = None) -> StreamingQuery:
    """Composite signal of a stream of finalised buckets, micro-batch by micro-batch."""
    return _per_batch(buckets, lambda batch, number: add_composite(batch, number, path, settings), checkpoint, trigger)


def read_composite(spark: SparkSession, path: str) -> DataFrame:
    """The composite signal that ``write_composite`` has written so far."""
    empty = "symbol string, window_start timestamp, sentiment_signal double, ci_lower double, ci_upper double, tweet_count bigint, total_engagement bigint, volume_rolling_mean double, volume_rolling_std double, volume_zscore double, composite_score double"
    return _stored(spark, f"{path}/signal", f"{empty}, batch bigint").drop("batch")
