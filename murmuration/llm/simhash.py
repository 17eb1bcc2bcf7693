"""SimHash near-duplicates, linked through BK-trees.

A fingerprint has 64 bits: bit j is set if it is set in over half of the hashes of the
text's 3-word shingles. Documents are linked if their fingerprints differ in at most
``radius`` bits.

Distinct fingerprints are dealt into shards: a fingerprint is cut into twice as many blocks as the radius. Two within
the radius differ in at most ``radius`` blocks and agree in the others, so a shard is one value of one choice of ``radius`` blocks. With
a radius of 3 that are 20 choices of 32 bits each: each fingerprint is in 20 shards, and by chance a shard holds few, however many
fingerprints there are. Each shard becomes a BK-tree: a node's children are keyed by their Hamming distance to it. A query
at distance d from a node only follows edges from d - radius to d + radius. Trees grow with
the corpus, so they are not broadcast as a whole: a task builds and queries the trees of its own shards,
and a shard with too many fingerprints is cut into parts, whose trees are
visited by the queries of each part, one pair of parts at a time. All trees of a task are built and walked level by level
with array operations.

A task reports a star for each cluster of a shard, never its pairs. Components of the
stars are found by alternating minima.

Edge cases: a null, empty or wordless text has fingerprint zero and is linked like any
other; a document without id belongs to its component, whose id is the smallest id that is
there (null if none is); repeated rows are kept; an empty table gives no rows; tables without any link, and tasks without any
row, give every document its own component. The hashes of a very long text are counted in parts. Other
columns are not read by ``near_duplicates``.
"""

from __future__ import annotations

from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from murmuration.llm.common import bounded_batches, fresh, sliced
from murmuration.llm.components import connected_components
from murmuration.sources.scratch import Scratch

RADIUS = 3
SHINGLE = 3
SEED = 42
#: Fingerprints of a shard that share a tree; larger shards are cut into parts.
TREE_NODES = 20_000
#: Rows of a task that builds trees, about.
TASK_NODES = 200_000
#: (query, node) pairs that are held at once.
_FRONT = 2_000_000
#: Hashes whose bits are counted at once.
_COUNTED = 1 << 16


def fingerprint_of(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned SimHash of one text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(flat, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: -shingle] + 1).tolist()]
    stops = ends[shingle - 1 :].tolist()
    hashes = np.array([xxh64_intdigest(flat[a:b], seed) for a, b in zip(starts, stops, strict=True)], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), _COUNTED):  # a very long text has very many
        some = hashes[first : first + _COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprint(text: Column) -> Column:
    """SimHash of a text column, as a signed long with the same bits."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint_of(t or "") for some in sliced([texts]) for t in some.to_pylist()], np.uint64)
        return pa.array(found.view(np.int64))

    return simhash(text.cast("string"))


def choices(radius: int) -> list[int]:
    """Masks (as signed 64-bit numbers) of which two fingerprints within the radius agree in at least one."""
    cuts = [64 * i // max(1, 2 * radius) for i in range(2 * radius + 1)] or [0]
    blocks = [(1 << b) - (1 << a) for a, b in pairwise(cuts)]
    masks = [sum(some) for some in combinations(blocks, radius)] if radius else [(1 << 64) - 1]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class Forest:
    """BK-trees over unsigned fingerprints, one per group, built level by level."""

    def __init__(self, prints: np.ndarray, groups: np.ndarray):
        """``groups`` must be sorted; the first of a group is its tree's root."""
        n = len(prints)
        self.prints = prints
        first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if n else np.zeros(0, np.int64)
        self.roots = np.repeat(first, np.diff(np.r_[first, n]))
        at = self.roots.copy()
        open_ = np.flatnonzero(np.arange(n) != at)
        edges_from, edges_key, edges_to = [], [], []
        while len(open_):
            distance = np.bitwise_count(prints[open_] ^ prints[at[open_]]).astype(np.int64)
            slot = at[open_] * 65 + distance
            keys, where, of = np.unique(slot, return_index=True, return_inverse=True)
            child = open_[where]
            edges_from.append(keys // 65)
            edges_key.append(keys % 65)
            edges_to.append(child)
            at[open_] = child[of]
            open_ = open_[at[open_] != open_]
        parent = np.concatenate(edges_from) if edges_from else np.zeros(0, np.int64)
        key = np.concatenate(edges_key) if edges_key else np.zeros(0, np.int64)
        to = np.concatenate(edges_to) if edges_to else np.zeros(0, np.int64)
        order = np.argsort(parent * 65 + key)
        self.slots, self.children = (parent * 65 + key)[order], to[order]

    def within(self, queries: np.ndarray, start: np.ndarray, radius: int):
        """Yield (query index, node) arrays of all nodes within ``radius``, starting at the given roots."""
        q, node = np.arange(len(queries)), start
        while len(q):
            distance = np.bitwise_count(queries[q] ^ self.prints[node]).astype(np.int64)
            near = distance <= radius
            if near.any():
                yield q[near], node[near]
            low = np.searchsorted(self.slots, node * 65 + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.slots, node * 65 + np.minimum(distance + radius, 64), side="right")
            many = high - low
            q = np.repeat(q, many)
            first = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) if len(many) else low
            node = self.children[first + np.arange(len(q))]


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (each node's least known partner) after linking a with b, fully resolved."""
    while True:
        pa_, pb = parent[a], parent[b]
        differ = pa_ != pb
        if not differ.any():
            return parent
        a, b, pa_, pb = a[differ], b[differ], pa_[differ], pb[differ]
        np.minimum.at(parent, np.maximum(pa_, pb), np.minimum(pa_, pb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def star_links(groups: np.ndarray, parts: np.ndarray, prints: np.ndarray, stays: np.ndarray, radius: int, asking: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links that join, within each group, all fingerprints within the radius.

    Rows with ``stays`` make up the trees; the others only query them. Rows not ``asking`` (all ask if it
    is not given) do not query.
    """
    order = np.lexsort((prints, ~stays, parts, groups))
    asking = np.ones(len(prints), bool) if asking is None else asking[order]
    groups, parts, prints, stays = groups[order], parts[order], prints[order], stays[order]
    whole = np.r_[0, np.cumsum((groups[1:] != groups[:-1]) | (parts[1:] != parts[:-1]))] if len(groups) else groups
    in_tree = np.flatnonzero(stays)
    forest = Forest(prints[in_tree], whole[in_tree])
    root = np.full(int(whole[-1]) + 1 if len(whole) else 0, -1, np.int64)
    root[whole[in_tree]] = forest.roots
    starts = root[whole]
    asks = np.flatnonzero((starts >= 0) & asking)
    size = np.bincount(whole[in_tree], minlength=len(root))[whole[asks]]
    parent = np.arange(len(prints))
    at = 0
    while at < len(asks):
        # as many queries as may visit _FRONT nodes in all
        upto = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), _FRONT)))
        some = asks[at:upto]
        for q, node in forest.within(prints[some], starts[some], radius):
            parent = _joined(parent, some[q], in_tree[node])
        at = upto
    linked = np.flatnonzero(parent != np.arange(len(parent)))
    return prints[linked], prints[parent[linked]]


def link_fingerprints(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Stars (a, b) that connect all distinct fingerprints (column fp) within the radius."""
    schema = "a long, b long"
    cuts = F.array(*[F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(choices(radius))])
    dealt = prints.select("fp", F.explode(cuts).alias("c")).select("fp", "c.band", "c.value")
    # a shard with more than TREE_NODES is cut into parts; a group is one part's tree and the queries of that part or of an earlier one
    sizes = dealt.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.withColumn("parts", F.ceil(F.col("n") / TREE_NODES).cast("int"))
    total = sizes.agg(F.sum(F.col("n") * F.col("parts"))).first()[0] or 0
    own = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    tree, asker = F.greatest("own", "other").cast("long"), F.least("own", "other").cast("long")
    rows = (
        dealt.join(sizes.where("n > 1"), ["band", "value"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "fp", F.xxhash64("band", "value").alias("shard"), (F.shiftright(tree * (tree + 1), 1) + asker).alias("part"),
            (F.col("own") == tree).alias("stays"), (F.col("own") == asker).alias("asks"),
        )
    )

    def walk(batches):
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return  # a task may get no rows
        table = pa.Table.from_batches(held)
        column = lambda name: table.column(name).to_numpy()
        a, b = star_links(column("shard"), column("part"), column("fp").view(np.uint64), column("stays").astype(bool), radius, column("asks").astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    tasks = max(1, -(-total // TASK_NODES))
    return rows.repartition(tasks, "shard", "part").mapInArrow(walk, schema)


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp (long with the fingerprint's bits), root, component_id."""
    bounded_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "simhash")
    printed = scratch.put(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")), "fingerprints")
    distinct = scratch.put(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    links = link_fingerprints(distinct.select("fp"), radius)
    roots = connected_components(links, scratch).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = scratch.put(rooted.select("fp", "first_id", "root"), "rooted")
    # both sides of each join are stored tables, so that a hot component or fingerprint can be split by the adaptive join
    ids = scratch.put(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "ids")
    labels = scratch.put(rooted.select("fp", "root").join(ids, "root").select("fp", "root", "component_id"), "labels")
    return printed.join(labels, "fp").select("doc_id", "fp", "root", "component_id")


def one_per_component(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The documents with all their columns, of each component only one: that of the smallest id.

    Of rows that agree in this id and in the fingerprint the one whose columns have the least hash stays. A component without any id
    keeps one of its documents.
    """
    fp, best_fp, best_id, nth = (fresh(docs, c) for c in ("_fp", "_best_fp", "_best_id", "_nth"))
    order = F.struct(F.col("doc_id").isNull().alias("gone"), "doc_id", "fp")
    best = near_duplicates(docs, radius).groupBy("root").agg(F.min(order).alias("b")).select(F.col("b.doc_id").alias(best_id), F.col("b.fp").alias(best_fp))
    printed = docs.withColumn(fp, fingerprint(F.col("text")))
    kept = printed.join(best, (F.col(fp) == F.col(best_fp)) & F.col("doc_id").eqNullSafe(F.col(best_id)), "left_semi")
    # the rows that are left of an id and fingerprint: equal in both, so a recomputed task must choose alike
    first = Window.partitionBy("doc_id", fp).orderBy(F.xxhash64(*docs.columns), F.xxhash64(*docs.columns, F.lit(1)))
    return kept.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).select(*docs.columns)
