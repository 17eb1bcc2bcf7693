"""Sharding by sampled splitters.

Records are ordered by (hash of the text, hash of the id, number of the row): equal texts lie side by side,
and a group of copies that is too large for one range can be cut inside, even of rows equal in text and id. A sample of the
keys, drawn with probability in proportion to size, gives quantile boundaries; each record
falls into the range between two of them. The exact bytes of all ranges are then counted.
Ranges above twice the mean are subdivided by a second sample from them alone. Consecutive
ranges make up the shards, each border at the range border nearest to an equal share of the bytes that are left, so that
a heavy record does not starve the shards behind it.

What reaches the driver: the sampled keys and one row per range, both bounded by
parameters. Rows travel once, without their texts, to be numbered within their range.

Edge cases: a null text has one byte of size and the crc32 of the empty string; null ids
sort as a value of their own; rows equal in text and id are told apart by the number that they get when the keys are
stored; a single very long text is not divided; an empty table gives no rows; other columns are passed through ``shard`` where named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.sources.scratch import Scratch

SHARDS = 8
#: Ranges, at most; a shard's bytes are off by half a range at most.
RANGES = 4096
#: Keys drawn, about; three longs each on the driver.
SAMPLE = 131_072
_LAW = "bytes"


_KEY = ("h", "k", "s")


def _range_of(splitters: list[tuple[int, int, int]]) -> Column:
    """How many splitters are at or below the key, by halving steps over a sorted array."""
    if not splitters:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(splitters):
        steps.append(step)
        step *= 2
    # one array of longs for each part of the key: an array of structs cannot be a literal
    parts = [F.lit(list(part)) for part in zip(*splitters, strict=True)]

    def narrowed(low: Column, step: Column) -> Column:
        at = low + step
        h, k, s = (F.get(part, at - 1) for part in parts)
        below = (h < F.col("h")) | ((h == F.col("h")) & ((k < F.col("k")) | ((k == F.col("k")) & (s <= F.col("s")))))
        return F.when((at <= len(splitters)) & below, at).otherwise(low)

    return F.aggregate(F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0), narrowed)


def _sampled(keys: DataFrame, total: int, wanted: int, seed: int) -> list[tuple[int, int, int]]:
    """Sorted keys drawn with probability ``size * wanted / total``; the draw follows from the key."""
    if not total:
        return []
    draw = F.pmod(F.xxhash64(*_KEY, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = keys.where(draw < F.col("size") * (wanted / total)).select(*_KEY).collect()
    return sorted(map(tuple, rows))


_LOWEST = -(1 << 63)


def quantile_splitters(sample: list[tuple[int, int, int]], n: int, most: int = 1) -> list[tuple[int, int, int]]:
    """About ``n - 1`` quantiles of a sorted sample.

    A splitter moves to the start of its group of equal texts, unless the group holds more
    than ``most`` of them: only large groups are cut.
    """
    chosen = [sample[i * len(sample) // n] for i in range(1, n)] if sample else []
    times: dict[int, int] = {}
    for h, *_ in chosen:
        times[h] = times.get(h, 0) + 1
    return sorted({key if times[key[0]] > most else (key[0], _LOWEST, _LOWEST) for key in chosen})


def owners(sizes: list[int], shards: int) -> list[int]:
    """The shard of each consecutive range: a shard is closed where it is nearest to an equal share of what is left."""
    out, left, filled = [], sum(sizes), 0
    shard = 0
    for b in sizes:
        if filled and shard < shards - 1 and filled + b / 2 > left / (shards - shard):
            left, filled, shard = left - filled, 0, shard + 1
        out.append(shard)
        filled += b
    return out


def shard(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, sample: int = SAMPLE, seed: int = 29, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns named in ``keep``, size, law, shard, slot and grown_shard (null under this law)."""
    scratch = Scratch(docs.sparkSession, "sharding")
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")
    row = F.xxhash64(F.monotonically_increasing_id(), F.lit(seed))
    keyed = docs.select("doc_id", *keep, size.alias("size"), F.xxhash64("text").alias("h"), F.xxhash64("doc_id", F.lit(seed)).alias("k"), row.alias("s"))
    # narrow rows, read four times from here instead of hashing the texts again
    keyed = scratch.put(keyed, "keys")
    total = keyed.agg(F.sum("size")).first()[0] or 0
    # a group stays whole up to about a sixty-fourth of a shard
    most = max(1, ranges // 2 // (64 * shards))
    splitters = quantile_splitters(_sampled(keyed, total, sample, seed), ranges // 2, most)

    def counted(splitters: list[tuple[int, int, int]]) -> dict[int, tuple[int, int]]:
        rows = keyed.groupBy(_range_of(splitters).alias("r")).agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()
        return {r.r: (r.b, r.n) for r in rows}

    sums = counted(splitters)
    mean = total / max(1, len(splitters) + 1)
    overfull = [r for r, (b, _) in sums.items() if b > 2 * mean]
    if overfull:
        inside = keyed.where(_range_of(splitters).isin(overfull))
        weight = sum(sums[r][0] for r in overfull)
        finer = quantile_splitters(_sampled(inside, weight, sample, seed + 1), min(ranges // 2, max(2, int(2 * weight / mean))))
        splitters = sorted({*splitters, *finer})
        sums = counted(splitters)

    filled = [sums.get(r, (0, 0)) for r in range(len(splitters) + 1)]
    owner, base, rows = owners([b for b, _ in filled], shards), [], [0] * shards
    for s, (_, n) in zip(owner, filled, strict=True):
        base.append(rows[s])
        rows[s] += n

    by_key = Window.partitionBy("_r").orderBy(*_KEY, "doc_id", "size")
    numbered = keyed.withColumn("_r", _range_of(splitters)).withColumn("_n", F.row_number().over(by_key) - 1)
    slot = F.get(F.lit(base), F.col("_r")).cast("long") + F.col("_n")
    return numbered.select(
        "doc_id", *keep, "size", F.lit(_LAW).alias("law"), F.get(F.lit(owner), F.col("_r")).cast("int").alias("shard"),
        slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents as one folder per shard, each with its ``slot``; ids must be unique."""
    placed = shard(docs, shards).select("doc_id", "shard", "slot")
    full = docs.join(placed, "doc_id")
    full.repartition("shard", F.floor(F.col("slot") / 10_000)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
