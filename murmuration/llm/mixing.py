"""Mixing sources to target weights: Pareto order sampling after certain whole copies.

Every source has a target in words. The whole part of target / size of its source is how often each of its documents is
copied for certain; the rest of the words is drawn. Within a source the inclusion probability of a document is in
proportion to its ``merit``, the number of binary digits of its number of words, so that longer documents are
likelier, and such that the expected words are the rest. Documents whose probability would exceed 1 are certain, and the
others share what these leave. As a source has few different merits (64 at most), this is solved on one row per merit.

Documents are ranked by random odds over inclusion odds (Pareto order), and each source takes them in this order until
the next would exceed the rest; of those left, the document that comes closest to the missing words is taken if that brings the source nearer to
its target. The random number of a document follows from its id, its text and the seed, so reruns agree.

Hot sources: words are first summed per source and range of rank, the range that holds the
edge is found on these sums, and only its rows are ordered.

Edge cases: a null or empty text has size 0 and is taken as nothing; documents without
source form a source of their own, after the others; repeated rows count each; rows equal in id and text are
interchangeable; if a source has no words its target is 0; a very long text is one document like any other; an empty
table gives no rows. Other columns are not read by ``mix``; ``mixed_documents`` passes them on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.llm.common import fresh, n_words
from murmuration.sources.scratch import Scratch

#: Weights by turn of the sources in code point order.
WEIGHTS = (5, 2, 1)
#: A source, and so a document, is taken this many times at most.
MOST_COPIES = 3
SEED = "pareto"
#: Random numbers are whole, below 2 to this power: exact in every engine.
_RANDOM_BITS = 52
#: Ranges of rank whose words are summed before any row is ordered.
RANK_RANGES = 4096


def random_number(doc_id: Column, digest: Column, seed: str) -> Column:
    """A whole number below 2^52 that follows from the id, the digest of the text and the seed."""
    digits = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), digest, F.lit(f":{seed}")).cast("binary")), 1, 13)
    return F.conv(digits, 16, 10).cast("long")


def merit(size: Column) -> Column:
    """Number of binary digits of a size; 0 has none."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0).cast("long")


def pareto_rank(random: Column, inclusion: Column) -> Column:
    """Random odds over inclusion odds; smallest first. Certain documents get 0, impossible ones infinity."""
    u = (random + F.lit(0.5)) / F.lit(float(1 << _RANDOM_BITS))
    return (
        F.when(inclusion >= 1, F.lit(0.0))
        .when(inclusion <= 0, F.lit(float("inf")))
        .otherwise((u / (1 - u)) / (inclusion / (1 - inclusion)))
    )


def inclusions(classes: DataFrame) -> DataFrame:
    """(source, merit, inclusion) from the words of each source and merit (columns source, merit, words, rest).

    The highest merits are certain as long as the next would exceed 1 in proportion to what is left.
    """
    above = Window.partitionBy("source").orderBy(F.desc("merit")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("source")
    weighed = classes.withColumn("weighed", F.col("words") * F.col("merit"))
    left = F.col("rest") - F.coalesce(F.sum("words").over(above), F.lit(0))
    open_ = F.sum("weighed").over(whole) - F.coalesce(F.sum("weighed").over(above), F.lit(0))
    # the factor if all merits above this one are certain; it holds from the first merit on that it keeps at or below 1
    factor = weighed.withColumn("factor", F.when((open_ > 0) & (left > 0), left / open_).otherwise(F.lit(0.0)))
    fits = F.when(F.col("factor") * F.col("merit") <= 1, F.struct(F.negative("merit").alias("up"), "factor"))
    solved = factor.withColumn("first", F.min(fits).over(whole))
    inclusion = F.when(F.col("merit") > -F.col("first.up"), F.lit(1.0)).otherwise(F.col("first.factor") * F.col("merit"))
    return solved.select("source", "merit", F.when(F.col("rest") > 0, F.coalesce(inclusion, F.lit(1.0))).otherwise(F.lit(0.0)).alias("inclusion"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """One row per source: source, source_size, target.

    All words are shared by weight. A target stops at ``most`` times its source; the excess is shared
    by weight among the others until none is above. Sources are ordered by how much of
    their weight they can carry; those that cannot carry their share come first.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")).cast("long")
    weighed = by_source.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = weighed.withColumn("level", left / open_weight)
    capped = shared.withColumn("is_capped", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("is_capped"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)
    target = F.when(F.col("is_capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * level["level"])
    return capped.select("source", "source_size", target.alias("target"), "is_capped")


def _mixed(docs: DataFrame, weights: tuple[int, ...], most: int, seed: str) -> DataFrame:
    """doc_id, digest, source, size, source_size, target, copies of each row."""
    scratch = Scratch(docs.sparkSession, "mixing")
    # narrow rows, read several times from here instead of counting words again
    sized = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), _digest().alias("digest")
    )
    sized = scratch.put(sized.withColumn("merit", merit(F.col("size"))), "sizes")
    by_merit = scratch.put(sized.groupBy("source", "merit").agg(F.sum("size").alias("words")), "merits")
    targets = source_targets(by_merit.withColumnRenamed("words", "size"), weights, most)
    whole = F.when(F.col("is_capped"), F.lit(most)).when(F.col("target") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    planned = targets.withColumn("whole", whole.cast("long")).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # one row per source and merit, so the planner broadcasts it where its size allows
    planned = scratch.put(planned.withColumnRenamed("source", "_s"), "planned")
    classes = by_merit.join(planned, F.col("source").eqNullSafe(F.col("_s"))).select("source", "merit", "words", "source_size", "target", "whole", "rest")
    classes = scratch.put(classes, "classes")
    chances = inclusions(classes).select(F.col("source").alias("_s"), F.col("merit").alias("_m"), "inclusion")
    known = classes.drop("words").join(chances, F.col("source").eqNullSafe(F.col("_s")) & (F.col("merit") == F.col("_m"))).drop("_s", "_m")
    known = scratch.put(known, "chances").withColumnRenamed("source", "_s").withColumnRenamed("merit", "_m")
    ranked = sized.join(known, F.col("source").eqNullSafe(F.col("_s")) & (F.col("merit") == F.col("_m"))).drop("_s", "_m", "merit")
    ranked = ranked.withColumn("rank", pareto_rank(random_number(F.col("doc_id"), F.col("digest"), seed), F.col("inclusion")))
    # the edge lies near rank 1; rank / (1 + rank) is spread over 0 to 1
    share = F.when(F.col("rank") < 1e15, F.col("rank") / (1 + F.col("rank"))).otherwise(F.lit(1.0))
    ranked = scratch.put(ranked.withColumn("range", F.floor(share * RANK_RANGES)), "ranked")

    sums = ranked.groupBy("source", "range").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (
        sums.withColumn("after", F.sum("words").over(upto))
        .groupBy(F.col("source").alias("_s"))
        .agg(F.min(F.when(F.col("after") > F.col("rest"), F.struct("range", (F.col("after") - F.col("words")).alias("before")))).alias("edge"))
    )
    edges = scratch.put(edges, "edges")
    found = ranked.join(edges, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    at_edge = F.coalesce(F.col("range") == F.col("edge.range"), F.lit(False))
    # only rows in the range with the edge need an order
    upto_row = Window.partitionBy("source").orderBy("rank", "doc_id", "digest", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = found.where(at_edge).withColumn("in", F.sum("size").over(upto_row) + F.col("edge.before") <= F.col("rest"))
    far = found.where(~at_edge).withColumn("in", F.coalesce(F.col("range") < F.col("edge.range"), F.lit(True)))
    columns = ["row", "doc_id", "digest", "source", "size", "source_size", "target", "whole", "rest", "rank"]
    decided = near.unionByName(far).select(*columns, (F.col("in") & (F.col("inclusion") > 0)).alias("in"))
    decided = scratch.put(decided, "decided")

    # what is missing now is less than the next document: take the one that fits best
    taken = F.coalesce(F.sum(F.when(F.col("in"), F.col("size"))), F.lit(0))
    gaps = decided.groupBy(F.col("source").alias("_s")).agg((F.first("rest") - taken).alias("gap"))
    off = F.abs(F.col("size") - F.col("gap"))
    last = (
        decided.where(~F.col("in"))
        .join(gaps, F.col("source").eqNullSafe(F.col("_s")))
        .where(off < F.col("gap"))
        .groupBy("_s")
        .agg(F.min(F.struct(off.alias("off"), "rank", "doc_id", "digest", "row")).alias("last"))
        .select(F.col("last.row").alias("_row"), F.lit(1).alias("one"))
    )
    copies = F.col("whole") + F.col("in").cast("long") + F.coalesce(F.col("one"), F.lit(0))
    done = decided.join(last, F.col("row") == F.col("_row"), "left")
    return done.select("doc_id", "digest", "source", "size", "source_size", "target", copies.alias("copies"))


def _digest() -> Column:
    return F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    return _mixed(docs, weights, most, seed).drop("digest").withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """The documents with all their columns, each as often as the mix takes it.

    Rows that agree in id, source and text share the copies that these rows are given; those of least hash get more.
    """
    names = ["key", "turn", "digest", "low", "sum", "rows", "times", "copy", "t_id", "t_digest", "t_source", "t_key"]
    key, turn, digest, low, total, rows, times, copy, t_id, t_digest, t_source, t_key = (fresh(docs, f"_{n}") for n in names)
    # copies of rows that are alike differ by one at most
    taken = (
        _mixed(docs, weights, most, seed)
        .groupBy(F.col("doc_id").alias(t_id), F.col("digest").alias(t_digest), F.col("source").alias(t_source))
        .agg(F.min("copies").alias(low), F.sum("copies").alias(total), F.count(F.lit(1)).alias(rows))
        .where(F.col(total) > 0)
        .withColumn(t_key, F.xxhash64(t_id, t_digest, t_source))
    )
    told = docs.withColumn(digest, _digest())
    told = told.withColumn(key, F.xxhash64("doc_id", digest, F.col("source").cast("string")))
    same = (F.col(key) == F.col(t_key)) & F.col("doc_id").eqNullSafe(F.col(t_id)) & F.col("source").cast("string").eqNullSafe(F.col(t_source)) & (F.col(digest) == F.col(t_digest))
    # numbered within the join's own partitioning: no second shuffle of texts
    alike = Window.partitionBy(key, "doc_id", "source", digest).orderBy(F.xxhash64(*docs.columns))
    joined = told.join(taken, same).withColumn(turn, F.row_number().over(alike))
    more = F.col(total) - F.col(low) * F.col(rows)
    each = joined.withColumn(times, F.col(low) + (F.col(turn) <= more).cast("long")).where(F.col(times) > 0)
    each = each.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))
    return each.select(*docs.columns)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), by_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS weight, 3 * source_size AS cap FROM by_source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
          / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (SELECT *, cap <= level * weight AS is_capped FROM levels
), targets AS (
  SELECT source, source_size, is_capped,
         CASE WHEN is_capped THEN cap::DOUBLE
              ELSE weight * (SELECT arg_min(level, cap / weight) FROM capped WHERE NOT is_capped) END AS target
  FROM capped
), planned AS (
  SELECT *, CASE WHEN is_capped THEN 3 WHEN target > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), merits AS (
  SELECT * FROM (
    SELECT p.source, s.merit, sum(s.size) AS words, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest
    FROM planned p JOIN (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS merit FROM sized) s ON s.source IS NOT DISTINCT FROM p.source
    GROUP BY p.source, s.merit, p.source_size, p.target, p.whole)
), lefts AS (
  SELECT *, rest - coalesce(sum(words) OVER above, 0)::DOUBLE AS left_, sum(words * merit) OVER (PARTITION BY source) - coalesce(sum(words * merit) OVER above, 0) AS open_
  FROM merits WINDOW above AS (PARTITION BY source ORDER BY merit DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), factors AS (
  SELECT *, CASE WHEN open_ > 0 AND left_ > 0 THEN left_ / open_::DOUBLE ELSE 0.0::DOUBLE END AS factor FROM lefts
), solved AS (
  SELECT *, max(merit) FILTER (factor * merit <= 1) OVER (PARTITION BY source) AS first_merit,
    arg_max(factor, merit) FILTER (factor * merit <= 1) OVER (PARTITION BY source) AS first_factor FROM factors
), chances AS (
  SELECT *, CASE WHEN rest <= 0 THEN 0 WHEN first_merit IS NULL OR merit > first_merit THEN 1 ELSE first_factor * merit END::DOUBLE AS inclusion FROM solved
), drawn AS (
  SELECT s.doc_id, s.source, s.size, md5(coalesce(s.text, '')) AS digest, c.source_size, c.target, c.whole, c.rest, c.inclusion,
    (('0x' || substr(md5(concat(coalesce(s.doc_id::VARCHAR, 'null'), ':', md5(coalesce(s.text, '')), ':pareto')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM sized s JOIN chances c ON s.source IS NOT DISTINCT FROM c.source AND c.merit = CASE WHEN s.size > 0 THEN length(bin(s.size)) ELSE 0 END
), ranked AS (
  SELECT *, CASE WHEN inclusion >= 1 THEN 0 WHEN inclusion <= 0 THEN 'Infinity'::DOUBLE ELSE (u / (1 - u)) / (inclusion / (1 - inclusion)) END::DOUBLE AS rank FROM drawn
), fitted AS (
  SELECT *, inclusion > 0 AND sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, digest ROWS UNBOUNDED PRECEDING) <= rest AS fits FROM ranked
), gaps AS (
  SELECT *, rest - coalesce(sum(size) FILTER (fits) OVER (PARTITION BY source), 0) AS gap FROM fitted
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY source, fits ORDER BY abs(size - gap), rank, doc_id, digest) = 1
            AND NOT fits AND abs(size - gap) < gap AS fits_best
  FROM gaps
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN fits OR fits_best THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ordered
"""
