"""Exact top-k search by inner product: exhaustive term-at-a-time accumulation.

A vector is a sparse row of terms: its components that are not 0, as whole numbers. Candidates are stored in blocks as
posting lists: per term the rows of the block that have it, with their weights. For a block of candidates and some
queries there is a dense array of scores, filled term by term: each query that has the term adds its weight times the
posting's to the scores of the posting's rows. When all terms are done, a partition selection finds each query's k-th
score, and the rows above it join the best so far.

Queries form groups of bounded size, candidate blocks are dealt into a bounded number of stripes, and a cell (group, stripe)
streams through its blocks with one array of scores at a time. It gives one packed row with the best k + 1 of
each query; those of a group are merged in the end, where the query's own row is left out. So rows and memory stay bounded
while the work is, as the search is exhaustive, queries times candidates.

Edge cases: a vector that is null or has a null or non-finite component takes no part; an empty vector scores 0 with all;
vectors of different lengths agree in the terms that both have. Ties go to the smaller id, rows without id come last and
never ask. Only one row is a query's own: another of the same id is a candidate like any other, and each row of a repeated
query id gets its own answers. Scores are exact; one beyond 64 bits is shown as the largest or smallest 64-bit number. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.llm.common import bounded_batches, give_back
from murmuration.sources.scratch import Scratch

SCALE = 256
#: Candidates of a block, and queries that are scored against it at once.
BLOCK = 4096
ABREAST = 64
#: Queries of a group, about, and stripes that a group's candidates are dealt into.
GROUP = 8192
STRIPES = 32
_LONG = np.iinfo(np.int64)
_HEADER = "<qqqq"  # rows, terms, weights, bytes of a weight
_STORED = "kind string, n long, terms long, largest string, block binary"


class Sparse:
    """Rows of (term, weight), laid end to end by row."""

    def __init__(self, ids: np.ndarray, gone: np.ndarray, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray):
        self.ids, self.gone, self.sizes, self.terms, self.weights = ids, gone, sizes, terms, weights

    def pack(self) -> bytes:
        exact = self.weights.dtype == object
        weights = self.weights
        if not exact:
            for kind in ("<i2", "<i4", "<i8"):
                if not len(weights) or (weights.min() >= np.iinfo(kind).min and weights.max() <= np.iinfo(kind).max):
                    weights = weights.astype(kind)
                    break
        raw = "\n".join(map(str, weights)).encode() if exact else weights.tobytes()
        terms = self.terms.astype("<u4").tobytes()
        head = struct.pack(_HEADER, len(self.ids), len(self.terms), len(raw), 0 if exact else weights.itemsize)
        return b"".join([head, self.ids.astype("<i8").tobytes(), self.gone.astype("u1").tobytes(), self.sizes.astype("<u4").tobytes(), terms, raw])

    @classmethod
    def unpack(cls, payload: bytes) -> Sparse:
        n, m, raw, width = struct.unpack_from(_HEADER, payload)
        at = struct.calcsize(_HEADER)
        found = []
        for kind, size in (("<i8", n), ("u1", n), ("<u4", n), ("<u4", m)):
            found.append(np.frombuffer(payload, kind, size, at))
            at += found[-1].nbytes
        weights = np.frombuffer(payload, f"<i{width}", m, at) if width else np.array([int(w) for w in payload[at : at + raw].split()], object)
        return cls(found[0], found[1].astype(bool), found[2].astype(np.int64), found[3].astype(np.int64), weights)

    def rows(self, low: int, high: int) -> Sparse:
        a, b = int(self.sizes[:low].sum()), int(self.sizes[:high].sum())
        return Sparse(self.ids[low:high], self.gone[low:high], self.sizes[low:high], self.terms[a:b], self.weights[a:b])

    def by_term(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(terms, end of each term's list, rows, weights): the same, laid end to end by term."""
        row = np.repeat(np.arange(len(self.ids)), self.sizes)
        order = np.argsort(self.terms, kind="stable")
        terms, sizes = np.unique(self.terms[order], return_counts=True)
        return terms, np.cumsum(sizes), row[order], self.weights[order]


def joined(parts: list[Sparse]) -> Sparse:
    def whole(of):
        found = [of(p) for p in parts]
        kind = object if any(f.dtype == object for f in found) else np.int64
        return np.concatenate([f.astype(kind) for f in found])

    return Sparse(whole(lambda p: p.ids), np.concatenate([p.gone for p in parts]), whole(lambda p: p.sizes), whole(lambda p: p.terms), whole(lambda p: p.weights))


def quantised(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows that take part, terms of each, terms, weights): floor(scale * component), without zeros."""
    lists = vectors.cast(pa.list_(pa.float64()))
    values = lists.flatten()
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    whole = ~np.array(lists.is_null())
    flat = values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(lists)), sizes)
    usable = whole & (np.bincount(owner, ~np.isfinite(flat), len(lists)) == 0)
    inside = usable[owner]
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat, owner, place = flat[inside], owner[inside], place[inside]
    if len(flat) and np.abs(flat).max() * scale >= 2.0**62:
        weights = np.array([int(x.as_integer_ratio()[0] * scale // x.as_integer_ratio()[1]) for x in flat.tolist()], object)
    else:
        weights = np.floor(flat * scale).astype(np.int64)
    solid = weights != 0
    rows = np.flatnonzero(usable)
    return rows, np.bincount(owner[solid], minlength=len(lists))[rows], place[solid], weights[solid]


def postings(block: Sparse, kind) -> dict[int, tuple]:
    """Per term (rows, weights); a posting with many of the rows has them all, with weights of 0, so that it is added in place."""
    n, start, out = len(block.ids), 0, {}
    terms, ends, rows, weights = block.by_term()
    weights = weights.astype(kind)
    for term, end in zip(terms.tolist(), ends.tolist(), strict=True):
        if 4 * (end - start) >= n:
            dense = np.zeros(n, kind)
            dense[rows[start:end]] = weights[start:end]
            out[term] = slice(None), dense
        else:
            out[term] = rows[start:end], weights[start:end]
        start = end
    return out


def scores_of(queries: Sparse, lists: dict[int, tuple], n: int, kind) -> np.ndarray:
    """A dense score array (query, candidate), accumulated term by term."""
    scores = np.zeros((len(queries.ids), n), kind)
    terms, ends, asking, weights = queries.by_term()
    weights, start = weights.astype(kind), 0
    for term, end in zip(terms.tolist(), ends.tolist(), strict=True):
        if term in lists:
            rows, posting = lists[term]
            for q, w in zip(asking[start:end].tolist(), weights[start:end], strict=True):
                scores[q, rows] += posting * w
        start = end
    return scores


def best_of(query: np.ndarray, score: np.ndarray, ids: np.ndarray, gone: np.ndarray, k: int) -> np.ndarray:
    """Indices of each query's k best: highest score, then smallest id, none last; by query."""
    if score.dtype == object:  # beyond 64 bits: sort by place among the values
        score = np.unique(score, return_inverse=True)[1]
    order = np.lexsort((ids, gone, -score, query))
    sorted_ = query[order]
    first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(order) else order
    nth = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[nth < k]


class Best:
    """The best ``k`` candidates of each query of a group so far."""

    def __init__(self, k: int):
        self.k = k
        self.query, self.score, self.ids, self.gone = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray, gone: np.ndarray) -> None:
        kind = object if object in (self.score.dtype, score.dtype) else np.int64
        query, score = np.r_[self.query, query], np.r_[self.score.astype(kind), score.astype(kind)]
        ids, gone = np.r_[self.ids, ids], np.r_[self.gone, gone]
        kept = best_of(query, score, ids, gone, self.k)
        self.query, self.score, self.ids, self.gone = query[kept], score[kept], ids[kept], gone[kept]

    def packed(self) -> bytes:
        exact = self.score.dtype == object
        raw = "\n".join(map(str, self.score)).encode() if exact else self.score.astype("<i8").tobytes()
        return b"".join([struct.pack("<q?", len(self.query), exact), self.query.astype("<i8").tobytes(), self.ids.astype("<i8").tobytes(), self.gone.astype("u1").tobytes(), raw])

    @staticmethod
    def unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n, exact = struct.unpack_from("<q?", payload)
        at = struct.calcsize("<q?")
        query, ids = np.frombuffer(payload, "<i8", n, at), np.frombuffer(payload, "<i8", n, at + 8 * n)
        gone = np.frombuffer(payload, "u1", n, at + 16 * n).astype(bool)
        rest = payload[at + 17 * n :]
        score = np.array([int(x) for x in rest.split()], object) if exact else np.frombuffer(rest, "<i8", n)
        return query, score, ids, gone


def search_block(queries: Sparse, block: Sparse, best: Best, kind) -> None:
    """Score a block for all queries, a few abreast, and keep what is among the best."""
    lists, n, k, found = postings(block, kind), len(block.ids), best.k, []
    for low in range(0, len(queries.ids) if n else 0, ABREAST):
        some = queries.rows(low, min(low + ABREAST, len(queries.ids)))
        scores = scores_of(some, lists, n, kind)
        if n > k and kind is not object:
            least = np.partition(scores, n - k, axis=1)[:, n - k]
            q, c = np.nonzero(scores >= least[:, None])
        else:
            q, c = (x.ravel() for x in np.indices(scores.shape))
        kept = best_of(q, scores[q, c], block.ids[c], block.gone[c], k)
        found.append((q[kept] + low, scores[q, c][kept], block.ids[c[kept]], block.gone[c[kept]]))
    if found:
        best.add(*map(np.concatenate, zip(*found, strict=True)))


def _blocks(vectors: DataFrame, is_query, vec_id: str, vector: str, scale: int) -> DataFrame:
    """Packed blocks of candidates (kind c) and of queries (kind q)."""
    plain = vectors.select(F.col(vec_id).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.col(vector).cast("array<double>").alias("v"))

    def block(batches):
        held: dict[str, list[Sparse]] = {"c": [], "q": []}

        def out(kind: str):
            rows = joined(held[kind])
            held[kind] = []
            largest = max((abs(int(w)) for w in (rows.weights.min(), rows.weights.max())), default=0) if len(rows.weights) else 0
            one = {"kind": [kind], "n": [len(rows.ids)], "terms": [int(rows.sizes.max()) if len(rows.sizes) else 0], "largest": [str(largest)], "block": pa.array([rows.pack()], pa.binary())}
            return pa.RecordBatch.from_pydict(one)

        for batch in batches:
            for first in range(0, len(batch), BLOCK):
                part = batch.slice(first, BLOCK)
                rows, sizes, terms, weights = quantised(part.column("v"), scale)
                ids = part.column("id").take(pa.array(rows))
                gone = np.array(ids.is_null(), bool)
                all_ = Sparse(ids.fill_null(0).to_numpy().astype(np.int64), gone, sizes, terms, weights)
                asks = np.array(part.column("asks").to_numpy(zero_copy_only=False), bool)[rows]
                chosen = np.repeat(asks, sizes)
                held["c"].append(all_)
                held["q"].append(Sparse(all_.ids[asks], gone[asks], sizes[asks], terms[chosen], weights[chosen]))
                for kind in ("c", "q"):
                    if sum(len(p.ids) for p in held[kind]) >= BLOCK:
                        yield out(kind)
        for kind in ("c", "q"):
            if sum(len(p.ids) for p in held[kind]):
                yield out(kind)

    return plain.mapInArrow(block, _STORED)


def top_k(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row with ``is_query`` the k other rows of highest score."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "topk")
    stored = scratch.put(_blocks(vectors, is_query & F.col(vec_id).isNotNull(), vec_id, vector, scale), "blocks")
    seen = {r.kind: r for r in stored.groupBy("kind").agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("n"), F.max("terms").alias("terms"), F.max(F.struct(F.length("largest"), "largest")).alias("most")).collect()}
    asked, given = seen.get("q"), seen.get("c")
    groups = max(1, -(-(asked.n if asked else 0) // GROUP))
    stripes = max(1, min(STRIPES, given.blocks if given else 1))
    bound = int(given.most.largest) * int(asked.most.largest) * given.terms if asked and given else 0
    kind = np.int32 if bound < 1 << 31 else np.int64 if bound < 1 << 63 else object

    of = lambda n, seed: F.pmod(F.xxhash64("block", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = stored.where("kind = 'q'").withColumn("group", of(groups, 1)).withColumn("stripe", every(stripes))
    blocks = stored.where("kind = 'c'").withColumn("stripe", of(stripes, 2)).withColumn("group", every(groups))
    cells = queries.unionByName(blocks).withColumn("first", F.expr("kind = 'q'"))
    cells = cells.select("group", "stripe", "first", "block", F.xxhash64("block").alias("key"))
    # a query's rows must come in the same order to every cell of its group
    cells = cells.repartition(groups * stripes, "group", "stripe").sortWithinPartitions("group", "stripe", F.desc("first"), "key", "block")

    def search(batches):
        cell, parts, queries, best = None, [], None, None

        def out():
            row = {"group": [cell[0]], "stripe": [cell[1]], "queries": pa.array([queries.pack() if cell[1] == 0 else None], pa.binary()), "found": pa.array([best.packed()], pa.binary())}
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for group, stripe, first, payload in zip(*(batch.column(c).to_pylist() for c in ("group", "stripe", "first", "block")), strict=True):
                if cell != (group, stripe):
                    if queries is not None:
                        yield out()
                    cell, parts, queries, best = (group, stripe), [], None, None
                if first:
                    parts.append(Sparse.unpack(payload))
                    queries = joined(parts)
                    best = Best(k + 1)
                elif queries is not None:
                    search_block(queries, Sparse.unpack(payload), best, kind)
        if queries is not None:
            yield out()
        give_back()

    partial = scratch.put(cells.mapInArrow(search, "group long, stripe long, queries binary, found binary"), "cells")

    def merge(batches):
        group, queries, best = None, None, None

        def out():
            # the rest of a query's answers once its own row is gone
            wide = object if kind is object else np.int64
            of_own = np.zeros(len(queries.ids), wide)
            np.add.at(of_own, np.repeat(np.arange(len(queries.ids)), queries.sizes), queries.weights.astype(wide) ** 2)
            own = ~best.gone & (best.ids == queries.ids[best.query]) & (best.score == of_own[best.query])
            _, where = np.unique(best.query[own], return_index=True)
            stays = np.ones(len(best.query), bool)
            stays[np.flatnonzero(own)[where]] = False
            query, score, ids, gone = (x[stays] for x in (best.query, best.score, best.ids, best.gone))
            first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else query
            rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)])) + 1
            few = rank <= k
            shown = [min(max(s, _LONG.min), _LONG.max) for s in score[few].tolist()]
            columns = [pa.array(queries.ids[query[few]]), pa.array(rank[few].astype(np.int32)), pa.array(ids[few], mask=gone[few]), pa.array(shown, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["query_id", "rank", "vec_id", "score"])

        for batch in batches:
            for of, packed, found in zip(*(batch.column(c).to_pylist() for c in ("group", "queries", "found")), strict=True):
                if of != group:
                    if group is not None:
                        yield out()
                    group, queries = of, Sparse.unpack(packed)  # stripe 0 comes first
                    best = Best(k + 1)
                best.add(*Best.unpacked(found))
        if group is not None:
            yield out()

    ordered = partial.repartition(groups, "group").sortWithinPartitions("group", "stripe")
    return ordered.mapInArrow(merge, "query_id long, rank int, vec_id long, score long")


TOPK_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS k, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.k, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.k <> c.k WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY k ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
