"""Exact and near-duplicate removal.

Near duplicates are removed by the greedy rule "walk the posts from the most to
the least engaging and keep one unless it shares a band with a kept post". The
walk only needs the posts that share a bucket with another one, and it can be made
in each connected component of the collision graph alone. A component with more posts
than one task should walk is walked in batches of rising rank: the outcome for the first posts
does not depend on later ones, these drop what collides with the kept ones, and what is left falls
into components anew. So the jobs grow with the logarithm of the longest chain of
collisions, and with a component's size over the batch, but never with the length of a chain itself.
No pairs are formed: components come from one edge per entry, to the leader of its bucket.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.config import DEFAULT, NearDuplicateSettings
from murmuration.functions import minhash, text
from murmuration.operators import rows as row_names
from murmuration.operators import similarity
from murmuration.operators.components import connected_components
from murmuration.sources.scratch import Scratch

log = logging.getLogger(__name__)

# Entries of a bucket that meet its leader in one part; a larger bucket is dealt into more.
PART_ENTRIES = 50_000
# Posts that one task walks through, in order of rank.
WALK_POSTS = 100_000


def exact_dedup(
    posts: DataFrame,
    key_columns: list[str] | tuple[str, ...] | None = None,
    order_columns: list[str] | None = None,
    row_hash: str | None = None,
) -> DataFrame:
    """One row per key: the first by partition columns and collection time.

    Ties beyond these columns are broken by a hash of the whole row. Filtering
    the row number lets Catalyst apply the limit before the shuffle as well, so
    a key that fills a third of the table leaves one row per task.

    All columns that are read from the result go through the shuffle. Where a long text is only measured, do that before, drop
    the text and name the column ``row_hash`` with the hash of the whole row.
    """
    keys = list(key_columns or DEFAULT.storage.key_columns)
    if order_columns is None:
        order_columns = [*DEFAULT.storage.partition_columns, "scraped_at"]
    order = [F.col(c) for c in order_columns if c in posts.columns]
    tie = F.xxhash64(*posts.columns) if row_hash is None else F.col(row_hash)
    first = Window.partitionBy(*keys).orderBy(*order, tie)
    return posts.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def with_comparable_text(posts: DataFrame) -> DataFrame:
    return posts.withColumn("comparable", text.comparable_text(F.col("content")))


def shingle_rows(posts: DataFrame, keep: list[str], k: int | None = None) -> DataFrame:
    """One row per shingle occurrence of ``comparable``, next to the columns to keep.

    The split is its own projection below the generator, so it is evaluated once
    per post and not again for every shingle. Positions are exploded and the words joined
    after it, inside generated code: no array of shingles is built.
    """
    k = DEFAULT.near_dup.shingle_words if k is None else k
    tokens = posts.select(*keep, F.split("comparable", " ").alias("_tokens"))
    starts = tokens.select(*keep, "_tokens", F.explode(minhash.shingle_starts(F.col("_tokens"), k)).alias("_at"))
    return starts.select(*keep, minhash.shingle_at(F.col("_tokens"), F.col("_at"), k).alias("shingle"))


def shingle_sets(posts: DataFrame, keep: list[str], k: int | None = None) -> DataFrame:
    """Distinct shingles of every post."""
    return shingle_rows(posts, keep, k).distinct()


def signatures(posts: DataFrame, keep: list[str], perms: int, k: int | None = None) -> DataFrame:
    """The MinHash minima ``m0 .. m<perms-1>`` of ``comparable``, one row per distinct ``keep``."""
    digests = shingle_rows(posts, keep, k).withColumn("_md5", F.md5(F.col("shingle").cast("binary")))
    hashed = digests.withColumns({f"_h{i}": lane for i, lane in enumerate(minhash.base_hashes(F.col("_md5")))})
    minima = [
        F.min(minhash.permuted(F.col(f"_h{i % minhash.LANES}"), i)).alias(f"m{i}") for i in range(perms)
    ]
    return hashed.groupBy(*keep).agg(*minima)


def banded_texts(
    posts: DataFrame,
    settings: NearDuplicateSettings | None = None,
    ts: str | None = "timestamp",
    post_id: str = "post_id",
) -> DataFrame:
    """(id, rank, buckets) of the best-ranked post of every distinct comparable text.

    Posts with equal text share all buckets, so only the first of them can be
    kept; collapsing them first means one signature per text. The collapse
    hash-partitions by text, the signature groups by the same key, hence the
    posts are shuffled once.
    """
    settings = settings or DEFAULT.near_dup
    bands, rows = minhash.band_layout(settings.threshold, settings.num_perm)
    ts = ts if ts in posts.columns else None
    best = (
        with_comparable_text(posts.where(F.col("content").isNotNull() & F.col(post_id).isNotNull()))
        .select(F.md5(F.col("comparable").cast("binary")).alias("text_key"), "comparable",
                similarity.rank(ts, post_id).alias("rank"))
        .groupBy("text_key")
        .agg(F.min(F.struct("rank", "comparable")).alias("best"))
        .select("text_key", F.col("best.rank").alias("rank"),
                F.col("best.comparable").alias("comparable"))
    )
    signed = signatures(best, ["text_key", "rank"], bands * rows, settings.shingle_words)
    return signed.select(F.col("rank.id").alias("id"), "rank", _buckets(bands, rows))


def _buckets(bands: int, rows: int) -> Column:
    return minhash.band_keys([F.col(f"m{i}") for i in range(bands * rows)], bands, rows).alias("buckets")


def bucket_entries(banded: DataFrame) -> DataFrame:
    return banded.select(F.explode("buckets").alias("bucket"), "id", "rank")


def bucket_leaders(entries: DataFrame) -> DataFrame:
    """First-ranked member and size of every bucket."""
    return entries.groupBy("bucket").agg(
        F.min("rank").alias("leader"), F.count(F.lit(1)).alias("members")
    )


def _attach(entries: DataFrame, per_bucket: DataFrame) -> DataFrame:
    """Inner join of entries with the rows of their bucket, which name its ``members``.

    A bucket is dealt into as many parts as its size asks for, so its entries do not meet in
    a single task, however large its share. Only the narrow rows of large buckets are repeated, and only
    those are looked up before.
    """
    parts = F.ceil(F.col("members") / PART_ENTRIES).cast("int")
    large = per_bucket.where(F.col("members") > PART_ENTRIES).select("bucket", parts.alias("_parts"))
    salt = F.pmod(F.xxhash64("id"), F.coalesce("_parts", F.lit(1))).cast("int")
    salted = entries.join(large, "bucket", "left").withColumn("_salt", salt).drop("_parts")
    repeated = per_bucket.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.join(repeated, ["bucket", "_salt"]).drop("_salt")


def lsh_candidates(
    posts: DataFrame,
    settings: NearDuplicateSettings | None = None,
    ts: str | None = "timestamp",
    post_id: str = "post_id",
) -> DataFrame:
    """Every colliding text next to the leader of each bucket that it shares.

    A star per bucket carries the same information as all pairs of its members
    and stays linear in the number of posts.
    """
    settings = settings or DEFAULT.near_dup
    scratch = Scratch(posts.sparkSession, "lsh")
    entries = bucket_entries(scratch.put(banded_texts(posts, settings, ts, post_id), "banded"))
    shared = scratch.put(bucket_leaders(entries).where("members > 1"), "shared")
    return (
        _attach(entries, shared)
        .where(F.col("id") != F.col("leader.id"))
        .select("bucket", F.col("id").alias("member"), F.col("leader.id").alias("leader"), "members")
    )


def _walked(posts: DataFrame, threshold: float | None) -> DataFrame:
    """(id, kept, buckets, shingles) by the sequential rule, for each component on its own.

    Rows stream through a task by component and rank; it remembers the kept posts of one component only.
    With a threshold a post is dropped only if a kept post in one of its buckets is that similar to it.
    """

    def walk(batches):
        import numpy as np
        import pyarrow as pa

        def similar(a, b):
            both = len(np.intersect1d(a, b, assume_unique=True))
            return both >= threshold * (len(a) + len(b) - both)

        component, taken = None, {}
        for batch in batches:
            kept = []
            shingles = batch.column("shingles").to_pylist() if threshold is not None else [None] * len(batch)
            for own, buckets, words in zip(batch.column("component").to_pylist(), batch.column("buckets").to_pylist(), shingles, strict=True):
                if own != component:
                    component, taken = own, {}
                words = np.array(words, np.int64) if words is not None else None
                rivals = [r for b in buckets for r in taken.get(b, ())]
                lost = bool(rivals) if threshold is None else any(similar(words, r) for r in rivals)
                kept.append(not lost)
                if not lost:
                    for b in buckets:
                        taken.setdefault(b, []).append(words)
            columns = [batch.column("id"), pa.array(kept, pa.bool_()), batch.column("buckets"), batch.column("shingles")]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "kept", "buckets", "shingles"])

    schema = posts.select("id", F.lit(True).alias("kept"), "buckets", "shingles").schema
    ordered = posts.repartition("component").sortWithinPartitions("component", "rank")
    return ordered.select("component", "id", "buckets", "shingles").mapInArrow(walk, schema)


def _first_batch(posts: DataFrame, scratch: Scratch, round_no: int) -> DataFrame:
    """The ``posts`` (with a component) next to ``now``: whether the post is in its component's first batch.

    A component of up to WALK_POSTS is a batch of its own. A larger one is dealt into parts by a hash; the lowest of the ranks
    that stand at the same place in each part bounds a batch of at most WALK_POSTS, without ordering the component as a whole.
    """
    large = posts.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > WALK_POSTS)
    large = large.select("component", F.ceil(F.col("n") / WALK_POSTS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id", F.lit(round_no)), F.col("parts"))
    in_part = Window.partitionBy("component", "part").orderBy("rank")
    placed = posts.join(large, "component").withColumn("part", part).withColumn("nth", F.row_number().over(in_part))
    ends = placed.where(F.col("nth") == F.greatest(F.lit(1), F.floor(F.lit(WALK_POSTS) / F.col("parts"))))
    ends = scratch.put(ends.groupBy("component").agg(F.min("rank").alias("end")), f"ends-{round_no}")
    return posts.join(ends, "component", "left").withColumn("now", F.coalesce(F.col("rank") <= F.col("end"), F.lit(True))).drop("end")


def _dropped_texts(scratch: Scratch, entries: DataFrame, threshold: float | None = None, sets: Callable | None = None) -> DataFrame | None:
    """Ids of texts that collide with a kept one; None when nothing collides.

    With a ``threshold`` a collision counts only if the shingle sets are that similar; ``sets`` gives them (id, shingles) for
    a table of ids.
    """
    shared = scratch.put(bucket_leaders(entries).where("members > 1"), "shared")
    if shared.isEmpty():
        return None
    # Entries alone in their bucket constrain nobody: only posts in shared buckets are walked.
    live = _attach(entries, shared).groupBy("id", "rank").agg(F.collect_list("bucket").alias("buckets"))
    if sets is None:
        live = live.withColumn("shingles", F.lit(None).cast("array<bigint>"))
    else:
        live = scratch.put(live, "colliding")
        live = live.join(sets(live.select("id")), "id")
    live = scratch.put(live, "live-0")
    decided, round_no = [], 0
    while True:
        n = live.count()
        if n <= WALK_POSTS:
            posts = live.withColumn("component", F.lit(None).cast(live.schema["id"].dataType)).withColumn("now", F.lit(True))
        else:
            own = live.select(F.explode("buckets").alias("bucket"), "id", "rank")
            edges = _attach(own, scratch.put(bucket_leaders(own), f"leaders-{round_no}")).select(F.col("id").alias("a"), F.col("leader.id").alias("b"))
            named = connected_components(edges, scratch, f"components-{round_no}").withColumnRenamed("node", "id")
            posts = live.join(named, "id", "left").withColumn("component", F.coalesce("component", "id"))
            posts = _first_batch(scratch.put(posts, f"posts-{round_no}"), scratch, round_no)
        walked = scratch.put(_walked(posts.where("now"), threshold), f"walked-{round_no}")
        decided.append(walked.where(~F.col("kept")).select("id"))
        if n <= WALK_POSTS:
            break
        later = posts.where(~F.col("now")).drop("component", "now")
        kept = walked.where("kept").select(F.explode("buckets").alias("bucket"), F.col("shingles").alias("theirs"))
        met = later.select("id", "shingles", F.explode("buckets").alias("bucket")).join(kept, "bucket")
        if threshold is not None:
            both = F.size(F.array_intersect("shingles", "theirs"))
            met = met.where(both >= threshold * (F.size("shingles") + F.size("theirs") - both))
        lost = scratch.put(met.select("id").distinct(), f"lost-{round_no}")
        decided.append(lost)
        log.info("near-dup batch %d: %d posts were open, %d fell to kept ones of the batch", round_no, n, lost.count())
        round_no += 1
        live = scratch.put(later.join(lost, "id", "left_anti"), f"live-{round_no}")
    dropped = decided[0]
    for more in decided[1:]:
        dropped = dropped.unionByName(more)
    return dropped


def near_duplicate_dedup(
    posts: DataFrame,
    threshold: float | None = None,
    num_perm: int | None = None,
    settings: NearDuplicateSettings | None = None,
    ts: str | None = "timestamp",
    post_id: str = "post_id",
    verify: bool = False,
) -> DataFrame:
    """Posts without near duplicates; the most engaging copy stays.

    Needs unique ids. With ``verify`` a post is dropped only if its shingles are exactly as similar to those of a kept post
    in one of its buckets as the threshold asks; by default a common bucket is enough.
    Posts without content or id have no duplicates and stay. Runs jobs while it is called;
    every intermediate table lies in the shared scratch folder, so a lost
    executor costs a task and not the steps before. ``posts`` is read several times
    and must be the same each time.
    """
    base = settings or DEFAULT.near_dup
    settings = NearDuplicateSettings(
        threshold=threshold or base.threshold,
        num_perm=num_perm or base.num_perm,
        shingle_words=base.shingle_words,
    )
    work = Scratch(posts.sparkSession, "near-dup-work")
    banded = work.put(banded_texts(posts, settings, ts, post_id), "banded")

    def sets(ids: DataFrame) -> DataFrame:
        own = posts.join(ids, F.col(post_id) == F.col("id"), "left_semi").withColumnRenamed(post_id, "id")
        return similarity.shingle_hashes(with_comparable_text(own), ["id"], settings.shingle_words).select("id", "shingles")

    kept = banded.select("id")
    dropped = _dropped_texts(work, bucket_entries(banded), *((settings.threshold, sets) if verify else ()))
    if dropped is not None:
        kept = kept.join(dropped, "id", "left_anti")
    # Only the kept ids outlive the call; the larger work tables go at once.
    kept = Scratch(posts.sparkSession, "near-dup").put(kept, "kept")
    work.drop()
    # One pass decides on all posts with an id, so an exact tier below runs once for it. Posts without an id are read apart:
    # they would meet in one task of the join, and the test reaches the scan where ids are the key of that tier.
    chosen = kept.withColumn("_chosen", F.lit(True)).withColumnRenamed("id", "_kept_id")
    named = posts.where(F.col(post_id).isNotNull()).join(chosen, F.col(post_id) == F.col("_kept_id"), "left")
    named = named.where(F.col("_chosen") | F.col("content").isNull()).drop("_chosen", "_kept_id")
    return named.unionByName(posts.where(F.col(post_id).isNull()))


def _names_without_near_duplicates(unique: DataFrame, settings: NearDuplicateSettings, ts: str | None, names: DataFrame, post_id: str = "post_id") -> DataFrame:
    """The stored names of the posts that stay, out of named posts of which those in ``names`` count.

    Texts never leave the scan stage: they are compared by md5, and one post of each distinct text is read again for
    the signature of that text.
    """
    scratch = Scratch(unique.sparkSession, "near-dup")
    work = Scratch(unique.sparkSession, "near-dup-work")
    bands, rows = minhash.band_layout(settings.threshold, settings.num_perm)
    ts = ts if ts in unique.columns else None
    has_text = F.col("content").isNotNull() & F.col(post_id).isNotNull()
    key = F.md5(F.col("comparable").cast("binary"))
    narrow = with_comparable_text(unique).select(*row_names.NAMES, similarity.rank(ts, post_id).alias("rank"), F.when(has_text, key).alias("text_key"))
    narrow = work.put(row_names.among(narrow, names), "narrow")

    first = F.min(F.struct("rank", *row_names.NAMES)).alias("first")
    best = narrow.where(F.col("text_key").isNotNull()).groupBy("text_key").agg(first)
    best = work.put(best.select("text_key", "first.*"), "best")
    # never null here; said so that no test for null repeats the work on the text below the join
    texts = with_comparable_text(row_names.may_be_among(unique, best).where(has_text)).withColumn("text_key", F.coalesce(key, F.lit("")))
    signed = signatures(texts, ["text_key"], bands * rows, settings.shingle_words).select("text_key", _buckets(bands, rows))
    banded = best.join(signed, "text_key").select(F.col("rank.id").alias("id"), "rank", "buckets")
    banded = work.put(banded, "banded")
    kept = banded.select("id")
    dropped = _dropped_texts(work, bucket_entries(banded))
    if dropped is not None:
        kept = kept.join(dropped, "id", "left_anti")
    stay = narrow.where(F.col("text_key").isNotNull()).join(kept, F.col("rank.id") == F.col("id"), "left_semi").select(*row_names.NAMES)
    stay = stay.unionByName(narrow.where(F.col("text_key").isNull()).select(*row_names.NAMES))
    stay = scratch.put(stay, "names")
    work.drop()
    return stay


def survivors(
    posts: DataFrame,
    near_duplicates: bool = True,
    settings: NearDuplicateSettings | None = None,
    ts: str | None = "timestamp",
    key_columns: list[str] | tuple[str, ...] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Named posts that may stay, and the stored names of those that do; ``rows.among`` of both is the result.

    Both tiers decide on narrow rows. Steps that work on a post alone, such as cleaning and scoring, can run on the first
    table before ``among`` and so need no shuffle of the texts. ``posts`` is read several times and must be the same each time.
    """
    keys = list(key_columns or DEFAULT.storage.key_columns)
    named = row_names.named(posts, keys)
    names = exact_dedup(named, keys, row_hash="_row").select(*row_names.NAMES)
    names = Scratch(posts.sparkSession, "exact-dedup").put(names, "names")
    unique = row_names.may_be_among(named, names)
    if near_duplicates:
        names = _names_without_near_duplicates(unique, settings or DEFAULT.near_dup, ts, names)
        unique = row_names.may_be_among(named, names)
    return unique, names


def deduplicate(
    posts: DataFrame,
    near_duplicates: bool = True,
    settings: NearDuplicateSettings | None = None,
    ts: str | None = "timestamp",
    key_columns: list[str] | tuple[str, ...] | None = None,
) -> DataFrame:
    """Exact tier by ``key_columns``, then (unless switched off) the near-duplicate tier; runs jobs while it is called."""
    unique, names = survivors(posts, near_duplicates, settings, ts, key_columns)
    if not near_duplicates:
        return row_names.among(unique, names).drop(*row_names.NAMES)
    # posts without an id are read apart: the test reaches the scan
    has_id = F.col("post_id").isNotNull()
    both = row_names.among(unique.where(has_id), names).unionByName(row_names.among(unique.where(~has_id), names))
    return both.drop(*row_names.NAMES)
