"""Periodic runs of words, found as maximal pairs of an LCP-interval tree.

A run is a stretch of words with smallest period q (words q apart are equal) that is at least
max(``least``, 2 q) words long and that no neighbouring word extends with this period.

The words of a few documents are numbered and laid end to end. Prefix doubling sorts their suffixes, the
stored ranks of the doublings give the common prefix of neighbours in this order (LCP). A walk over these values
visits the LCP intervals bottom-up. Every interval keeps its places in lists by the word to their left.
Two places i < j from different children of an interval of value l, with different words to the left, are a maximal
pair: the equal parts can be grown on neither side. If j - i <= l they overlap or touch, so the stretch from i to
j + l has period j - i and grows on neither side: it is a run, without any extension. Places are only compared
within the distance l, and never with those of their own left word, so what is looked at stays near to what
is found. The same stretch appears for multiples of its period; the smallest stays.

Edge cases: a null, empty or wordless text has no words and no runs; a text of any length is treated whole, alone in its
chunk if it is long (it takes about 4 bytes per word for each doubling of its longest repetition); a document
without id is treated like any other; repeated rows each have their row; an empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.llm.common import bounded_batches, sliced, split_batches

LEAST = 12
#: Characters of a chunk of documents; a longer document is a chunk of its own.
CHUNK_CHARS = 1_000_000
_RUNS = "array<struct<start:long,length:long,period:long>>"


def suffix_order(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffixes in an order in which equal beginnings are neighbours, and the ranks of each doubling.

    ``words`` must tell documents apart, ``ends`` is the end of each place's document. The ranks of a doubling (h, ranks)
    agree for two places exactly if the next h words do and lie in the document.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    values = words[order]
    new = np.r_[True, values[1:] != values[:-1]] if n else np.zeros(0, bool)
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, np.diff(np.r_[first, n]))
    levels = [(1, rank.astype(np.int32 if n < 1 << 31 else np.int64))]
    h = 1
    slots = np.flatnonzero(~(new & np.r_[new[1:], True])) if n else first
    while len(slots):
        open_ = order[slots]
        after = open_ + h
        inside = after < ends[open_]
        second = np.where(inside, rank[np.where(inside, after, 0)], -1)
        sort = np.lexsort((second, rank[open_]))
        open_, second = open_[sort], second[sort]
        group = rank[open_]
        new = np.r_[True, (group[1:] != group[:-1]) | (second[1:] != second[:-1])]
        order[slots] = open_
        first = np.flatnonzero(new)
        rank[open_] = np.repeat(slots[first], np.diff(np.r_[first, len(slots)]))
        slots = slots[~(new & np.r_[new[1:], True])]
        h *= 2
        levels.append((h, rank.astype(levels[0][1].dtype)))
    return order, levels


def common_prefixes(a: np.ndarray, b: np.ndarray, ends: np.ndarray, levels: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """How many words from the places ``a`` and ``b`` on agree."""
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    last_a, last_b = ends[a], ends[b]
    for h, rank in reversed(levels):
        fits = (a < last_a) & (b < last_b)
        same = fits & (rank[np.where(fits, a, 0)] == rank[np.where(fits, b, 0)])
        step = np.where(same, h, 0)
        total, a, b = total + step, a + step, b + step
    return total


class Places:
    """The places of an LCP interval: all, and by the word to their left, both rising."""

    __slots__ = ("all", "by_left")

    def __init__(self, place: int, left: int):
        self.all, self.by_left = [place], {left: [place]}

    def merge(self, other: Places, depth: int, left: list[int], found: list[tuple[int, int, int]], least: int) -> Places:
        """Both together; appends (place, distance, depth) of the maximal pairs between them that are runs."""
        large, small = (self, other) if len(self.all) >= len(other.all) else (other, self)
        for x in small.all:
            own = left[x]
            low, high = bisect_left(large.all, x - depth), bisect_right(large.all, x + depth)
            if low == high:
                continue
            if high - low <= len(large.by_left):
                near = [p for p in large.all[low:high] if left[p] != own]
            else:
                near = [p for word, places in large.by_left.items() if word != own for p in places[bisect_left(places, x - depth) : bisect_right(places, x + depth)]]
            found += [(min(p, x), abs(p - x), depth) for p in near if abs(p - x) + depth >= least]
        for x in small.all:
            insort(large.all, x)
        for word, places in small.by_left.items():
            if word in large.by_left:
                kept = large.by_left[word]
                for x in places:
                    insort(kept, x)
            else:
                large.by_left[word] = places
        return large


def maximal_pairs(places: list[int], depths: list[int], left: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(place, distance, depth) of the maximal pairs that are runs.

    ``places`` in suffix order; ``depths[k]`` is the common prefix of place k and the next, 0 where intervals of
    interest end. The stack holds the open intervals, the deepest on top.
    """
    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, Places]] = []
    for place, depth in zip(places, depths, strict=True):
        here = Places(place, left[place])
        while stack and stack[-1][0] >= depth and stack[-1][0] > 0:
            if stack[-1][0] == depth:
                here = stack.pop()[1].merge(here, depth, left, found, least)
                break
            deeper, before = stack.pop()
            here = before.merge(here, deeper, left, found, least)
        if depth:
            stack.append((depth, here))
    return found


def runs_of(words: np.ndarray, ends: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, length, period) rows, rising, of all runs.

    ``words`` numbers the words so that documents share none; ``ends`` is the end of each place's document.
    """
    order, levels = suffix_order(words, ends)
    # a run is distance + depth long with depth >= distance, so pairs of less than half of ``least`` make none
    enough = max(1, -(-least // 2))
    rank = levels[max(k for k, (h, _) in enumerate(levels) if h <= enough)][1] if levels else np.zeros(0, np.int64)
    near = np.flatnonzero(rank[order[1:]] == rank[order[:-1]]) if len(order) else order
    depths = np.zeros(len(order), np.int64)
    found = common_prefixes(order[near], order[near + 1], ends, levels)
    depths[near] = np.where(found >= enough, found, 0)
    part = np.flatnonzero((depths > 0) | np.r_[False, depths[:-1] > 0]) if len(order) else order
    starts_document = np.r_[True, ends[1:] != ends[:-1]] if len(words) else np.zeros(0, bool)
    left = np.where(starts_document, -1, np.r_[-1, words[:-1]]).tolist() if len(part) else []
    best: dict[tuple[int, int], int] = {}
    for place, distance, depth in maximal_pairs(order[part].tolist(), depths[part].tolist(), left, least):
        key = (place, distance + depth)
        best[key] = min(distance, best.get(key, distance))
    return np.array(sorted((a, n, q) for (a, n), q in best.items()), np.int64).reshape(-1, 3)


def periodic_runs(docs: DataFrame, least: int = LEAST, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length and period, rising), collapsed.

    ``collapsed`` has the words, joined by one space, without those that a run holds after its first period.
    ``rewrite`` may replace a document's words, by its id, before.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def find(batches):
        for batch in sliced(batches):
            for some, texts in split_batches(batch, [t or "" for t in batch.column("text").to_pylist()], CHUNK_CHARS):
                doc_ids = some.column("doc_id").to_pylist()
                split = [t.encode("utf-8", "replace").split() for t in texts]
                if rewrite:
                    split = [rewrite(i, words) for i, words in zip(doc_ids, split, strict=True)]
                counts = np.array([len(words) for words in split], np.int64)
                last = np.cumsum(counts)
                table: dict[bytes, int] = {}
                flat = np.fromiter((table.setdefault(w, len(table)) for words in split for w in words), np.int64, int(last[-1]))
                # words of different documents are different
                flat += np.repeat(np.arange(len(split)), counts) * len(table)
                runs = runs_of(flat, np.repeat(last, counts), least)
                cut = np.searchsorted(runs[:, 0], np.r_[0, last])
                kept = []
                for i, words in enumerate(split):
                    own = runs[cut[i] : cut[i + 1]]
                    own[:, 0] -= last[i] - counts[i]
                    if len(own):
                        steps = np.zeros(len(words) + 1, np.int64)
                        np.add.at(steps, own[:, 0] + own[:, 2], 1)
                        np.add.at(steps, own[:, 0] + own[:, 1], -1)
                        words = [w for w, inside in zip(words, np.cumsum(steps)[:-1].tolist(), strict=True) if not inside]
                    kept.append(b" ".join(words).decode())
                columns = [pa.array(runs[:, c].copy()) for c in range(3)]
                listed = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.StructArray.from_arrays(columns, fields=list(kind.value_type)))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(counts), listed, pa.array(kept, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    bounded_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(find, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")


def with_trial_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten, drawn by its id, is made periodic from some word on; those without id are not drawn."""
    from zlib import crc32

    h = 1 if doc_id is None else crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    rest = words[start : start + period]
    return words[:start] + (rest * (-(-(n - start) // len(rest))))[: n - start]


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct(F.negative(r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    length = F.negative(F.col("best.less"))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: Runs need six equal words at a distance of up to their number, so equal six-word windows of a document, as
#: stretches at one distance, give them all.
RUNS_SQL = r"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), crc AS (
  SELECT k, doc_id, ws, CAST(doc_id AS VARCHAR) AS digits, 0 AS pos, 4294967295::BIGINT AS h FROM base WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT k, doc_id, ws, digits, pos + 1, list_reduce(list_prepend(xor(h, ascii(digits[pos + 1])::BIGINT), range(8)::BIGINT[]),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) FROM crc WHERE pos < length(digits)
), drawn AS (
  SELECT b.k, b.doc_id, b.ws, len(b.ws) AS n, coalesce(4294967295 - c.h, 1) AS h, coalesce(4294967295 - c.h, 1) // 10 AS g
  FROM base b LEFT JOIN crc c ON b.k = c.k AND c.pos = length(c.digits)
), planned AS (
  SELECT k, doc_id, ws, n, h % 10 = 0 AND n > 0 AS edited, CASE WHEN n > 0 THEN g % n END AS a,
    CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM drawn
), words AS (
  SELECT k, i, CASE WHEN edited AND i >= a THEN ws[1 + a + (i - a) % p] ELSE ws[1 + i] END AS w
  FROM (SELECT k, ws, edited, a, p, unnest(range(n)) AS i FROM planned)
), windows AS (
  SELECT k, i, md5(string_agg(w, ' ') OVER (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING)) AS six,
    count(*) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS size FROM words
), matches AS (
  SELECT x.k, x.i, y.i - x.i AS q FROM windows x JOIN windows y ON x.k = y.k AND x.six = y.six AND x.i < y.i WHERE x.size = 6 AND y.size = 6
), stretches AS (
  SELECT k, q, min(i) AS start, count(*) + 5 + q AS length
  FROM (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM matches) GROUP BY k, q, island
), runs AS (
  SELECT k, start, length, min(q) AS period FROM stretches WHERE length >= 2 * q AND length >= 12 GROUP BY k, start, length
), best AS (
  SELECT k, count(*) AS n_runs, min({'less': -length, 'start': start, 'period': period}) AS b,
    sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period, length)) AS runs_sha256 FROM runs GROUP BY k
), gone AS (
  SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
  SELECT words.k, string_agg(w, ' ' ORDER BY words.i) AS t FROM words ANTI JOIN gone ON words.k = gone.k AND words.i = gone.i GROUP BY words.k
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b.start AS start, -b.less AS length, b.period AS period, 1000 * -b.less // b.period AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM base LEFT JOIN best ON base.k = best.k LEFT JOIN kept ON base.k = kept.k
"""
