"""Exact Jaccard similarity of posts: a set-similarity join over word shingles.

Texts are compared as sets of shingles, each a 64-bit hash. All shingles are ordered by how many texts have them, the rarest
first. Two sets of similarity t or more share a shingle among the first n - ceil(t n) + 1 of each, so only these
prefixes are joined, and mostly on rare shingles. A pair is a candidate if its sizes allow the
similarity and enough shingles are left behind the common one; candidates are then compared as whole sets.

Posts with the same comparable text are one text, shown by its best-ranked post: a text that a third of all posts
repeat makes no pair with itself. A prefix shingle of very many texts is joined in blocks of bounded size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.config import DEFAULT
from murmuration.functions import minhash, text
from murmuration.operators import rows
from murmuration.sources.scratch import Scratch

# Texts of a prefix shingle that meet in one block.
BLOCK_TEXTS = 1_000


def rank(ts: str | None, post_id: str) -> Column:
    """Ordering of posts: engagement descending (none comes last), then oldest, then id."""
    when = F.col(ts) if ts else F.lit(None).cast("timestamp")
    return F.struct(
        F.col("engagement_score").isNull().alias("unknown"),
        F.negative(F.col("engagement_score").cast("bigint")).alias("down"),
        when.alias("ts"),
        F.col(post_id).alias("id"),
    )


def shingle_hashes(posts: DataFrame, keep: list[str], k: int | None = None) -> DataFrame:
    """``keep`` and ``shingles``: the rising distinct hashes of the shingles of ``comparable``.

    The split is its own projection, so it is evaluated once per post.
    """
    k = DEFAULT.near_dup.shingle_words if k is None else k
    tokens = posts.select(*keep, F.split("comparable", " ").alias("_tokens"))
    parts = tokens.select(*keep, minhash.shingles(F.col("_tokens"), k).alias("_parts"))
    return parts.select(*keep, F.array_sort(F.array_distinct(F.transform("_parts", lambda p: F.xxhash64(p)))).alias("shingles"))


def distinct_texts(posts: DataFrame, ts: str | None = "timestamp", post_id: str = "post_id") -> DataFrame:
    """(id, copies, comparable): each distinct comparable text with its best-ranked post."""
    known = posts.where(F.col("content").isNotNull() & F.col(post_id).isNotNull())
    compared = known.withColumn("comparable", text.comparable_text(F.col("content")))
    ts = ts if ts in posts.columns else None
    by_text = compared.select(F.md5(F.col("comparable").cast("binary")).alias("text_key"), "comparable", rank(ts, post_id).alias("rank")).groupBy("text_key")
    best = by_text.agg(F.min(F.struct("rank", "comparable")).alias("best"), F.count(F.lit(1)).alias("copies"))
    return best.select(F.col("best.rank.id").alias("id"), "copies", F.col("best.comparable").alias("comparable"))


def similar_pairs(
    posts: DataFrame,
    threshold: float | None = None,
    ts: str | None = "timestamp",
    post_id: str = "post_id",
    k: int | None = None,
) -> DataFrame:
    """(left_id, right_id, jaccard, left_copies, right_copies) of all pairs of different texts that are as similar as ``threshold``.

    Ids are those of the best-ranked posts of both texts, the smaller first. Posts without content or id take no part.
    """
    threshold = threshold or DEFAULT.near_dup.threshold
    scratch = Scratch(posts.sparkSession, "similar")
    sets = scratch.put(shingle_hashes(distinct_texts(posts, ts, post_id), ["id", "copies"], k).withColumn("n", F.size("shingles")), "sets")
    # stored, as the joins below then read nothing but tables and can be split where a shingle is frequent
    spread = sets.select("id", "n", F.explode("shingles").alias("shingle"))
    # shingles of one text only come first in its order and meet no other text: their number is enough, and only rows of
    # shared shingles, which a bitmap picks in the scan, are joined and ordered
    shared = scratch.put(spread.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "frequencies")
    met = rows.may_be_among(spread.withColumn("_row", F.col("shingle")), shared.withColumn("_row", F.col("shingle"))).drop("_row")
    own = Window.partitionBy("id")
    nth = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("texts", "shingle"))
    first = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1
    prefixes = met.join(shared, "shingle").withColumn("nth", nth).where(F.col("nth") <= first)
    prefixes = scratch.put(prefixes.select("id", "n", "shingle", "nth"), "prefixes")

    blocks = prefixes.groupBy("shingle").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TEXTS).cast("int").alias("blocks")).where("blocks > 1")
    blocks = scratch.put(blocks, "blocks")
    dealt = prefixes.join(blocks, "shingle", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt.select("shingle", F.col("own").alias("p"), other.alias("q"), F.col("id").alias("left_id"), F.col("n").alias("ln"), F.col("nth").alias("lp"))
    right = dealt.select("shingle", other.alias("p"), F.col("own").alias("q"), F.col("id").alias("right_id"), F.col("n").alias("rn"), F.col("nth").alias("rp"))
    needed = F.lit(threshold / (1 + threshold)) * (F.col("ln") + F.col("rn")) - 1e-9
    fits = (F.least("ln", "rn") >= F.lit(threshold) * F.greatest("ln", "rn") - 1e-9) & (1 + F.least(F.col("ln") - F.col("lp"), F.col("rn") - F.col("rp")) >= needed)
    met = left.join(right, ["shingle", "p", "q"]).where((F.col("left_id") < F.col("right_id")) & fits)
    candidates = scratch.put(met.select("left_id", "right_id").distinct(), "candidates")

    # whole sets are read again only where a candidate names them
    named = F.xxhash64("id")
    ids = candidates.select(F.explode(F.array("left_id", "right_id")).alias("id")).distinct().withColumn("_row", named)
    sets = scratch.put(rows.may_be_among(sets.withColumn("_row", named), ids).drop("_row"), "compared")
    side = lambda name: sets.select(*[F.col(c).alias(f"{name}_{c}") for c in ("id", "copies", "shingles")])
    both = F.size(F.array_intersect("left_shingles", "right_shingles"))
    compared = candidates.join(side("left"), "left_id").join(side("right"), "right_id").withColumn("both", both)
    jaccard = F.col("both") / (F.size("left_shingles") + F.size("right_shingles") - F.col("both"))
    return compared.withColumn("jaccard", jaccard).where(F.col("jaccard") >= threshold).select("left_id", "right_id", "jaccard", "left_copies", "right_copies")
