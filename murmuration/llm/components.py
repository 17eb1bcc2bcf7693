"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.sources.scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``links`` (columns a, b; longs): the least node it can reach.

    Each round turns the neighbours of a node to its least neighbour, first those above the node,
    then those at or below it; the number of rounds grows with the logarithm of the nodes. A
    hub with very many links is reduced before the shuffle and split by the adaptive join.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.put(edges, "links-0")
    last = None
    for i in range(1, max_rounds + 1):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # every link now points from the larger to the smaller node
        large = scratch.put(large.distinct(), f"large-{i}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = scratch.put(small, f"links-{i}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
