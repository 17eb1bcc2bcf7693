"""Document fingerprints by consistent weighted sampling.

A text is a set of terms (its words, A-Z in lower case) weighted by how often they
occur. For each of ``samples`` draws every weighted term gets a random number that depends on
nothing but term, weight and draw: with r and c from Gamma(2, 1) and b uniform,
t = floor(ln(weight) / r + b) and ln a = ln c - r (t - b) - r. The term of the least a is the sample.
Two texts agree in a draw with a probability equal to their generalised Jaccard similarity,
the sum of the smaller over the sum of the larger weights. One byte of a hash of the sample
(term and t determine a) is kept per draw; the chance agreement of bytes is taken out of a likeness.

Edge cases: a null text counts as empty; a text without words has a fingerprint of zero bytes that
is like no other but those without words (likeness 1); equal texts have equal fingerprints; documents
without id come first, documents with equal ids are ordered by a hash of the text, then by the text; very long texts are
taken whole, one at a time; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmuration.llm.common import mixed, once_per_worker, texts_of, word_hashes
from murmuration.sources.scratch import Scratch

SAMPLES = 128
#: Documents of a block of neighbouring ids, about.
BLOCK_DOCS = 256
#: Quantiles of the ids that blocks are cut between, and the most blocks between two of them.
_QUANTILES = 512
_MOST_PARTS = 1 << 22
#: Weighted terms whose draws a worker keeps.
_KEPT_TERMS = 1 << 17
_CHUNK_DOCS = 256
_CHUNK_CHARS = 2_000_000
_U = np.uint64


def draws(terms: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """ln a of each weighted term (64-bit hash, weight) in each draw, as 32-bit floats."""
    seeds = terms[:, None] + np.arange(1, samples + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    a, b, c = mixed(seeds), mixed(seeds ^ _U(0xC2B2AE3D27D4EB4F)), mixed(seeds + _U(0x165667B19E3779F9))
    unit = lambda x: (x.astype(np.float64) + 0.5) / 4294967296.0
    low = _U(0xFFFFFFFF)
    r = -np.log(unit(a >> _U(32)) * unit(a & low))
    scale = np.log(-np.log(unit(b >> _U(32)) * unit(b & low)))
    beta = unit(c >> _U(32))
    t = np.floor(np.log(weights)[:, None] / r + beta)
    return (scale - r * (t - beta) - r).astype(np.float32)


class Sampler:
    """Fingerprints of many texts at once; draws of common terms are kept."""

    def __init__(self, samples: int):
        self.samples = samples
        self.row: dict[int, int] = {}
        self.kept = np.empty((_KEPT_TERMS, samples), np.float32)

    def _table(self, keys: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        row = self.row
        at = np.fromiter((row.get(k, -1) for k in keys.tolist()), np.int64, len(keys))
        out = np.empty((len(keys), self.samples), np.float32)
        have = at >= 0
        out[have] = self.kept[at[have]]
        new = np.flatnonzero(~have)
        for first in range(0, len(new), 4096):
            some = new[first : first + 4096]
            out[some] = draws(terms[some], weights[some], self.samples)
        room = _KEPT_TERMS - len(row)
        if room > 0 and len(new):
            new = new[:room]
            self.kept[len(row) : len(row) + len(new)] = out[new]
            row.update(zip(keys[new].tolist(), range(len(row), len(row) + len(new)), strict=True))
        return out

    def fingerprints(self, texts: list[str]) -> np.ndarray:
        """One row of bytes per text."""
        counts, (hashes,) = word_hashes([t.encode("utf-8", "replace").lower() for t in texts], lanes=1)
        prints = np.zeros((len(texts), self.samples), np.uint8)
        if not len(hashes):
            return prints
        terms, number = np.unique(hashes, return_inverse=True)
        pairs, times = np.unique((np.repeat(np.arange(len(texts)), counts) << 32) + number, return_counts=True)
        owner, term = pairs >> 32, pairs & 0xFFFFFFFF
        weighted, of = np.unique(times * (len(terms) + 1) + term, return_inverse=True)
        weight, term = weighted // (len(terms) + 1), weighted % (len(terms) + 1)
        keys = mixed(terms[term] + weight.astype(np.uint64) * _U(0xD1B54A32D192ED03))
        table = self._table(keys, terms[term], weight.astype(np.float64))
        texts_with, starts = np.unique(owner, return_index=True)
        ends = np.r_[starts[1:], len(owner)]
        lane = np.arange(self.samples, dtype=np.uint64) << _U(32)
        for first in range(0, len(texts_with), 32):
            a, b = starts[first], ends[min(first + 31, len(ends) - 1)]
            least = np.minimum.reduceat(table[of[a:b]], starts[first : first + 32] - a, axis=0)
            prints[texts_with[first : first + 32]] = (mixed(least.view(np.uint32).astype(np.uint64) + lane) >> _U(56)).astype(np.uint8)
        # zero bytes alone mean "no words"
        prints[texts_with[~prints[texts_with].any(axis=1)], 0] = 1
        return prints


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of the fingerprints in each row."""
    equal = (a == b).mean(axis=1)
    empty = (~a.any(axis=1)).astype(int) + (~b.any(axis=1)).astype(int)
    return np.where(empty == 1, 0.0, np.clip((equal - 1 / 256) / (1 - 1 / 256), 0.0, 1.0))


def edited_text(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the beginning of ``following``."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def _compare(ids: list, texts: list[str], following: list[str], samples: int) -> list:
    """Columns of the result; where ``following`` are the texts that come next."""
    sampler = once_per_worker(("sampler", samples), lambda: Sampler(samples))
    edited = [edited_text(t, f) for t, f in zip(texts, following, strict=True)]
    # most texts also come next, and copies are many: each different one is sampled once
    number = {t: i for i, t in enumerate(dict.fromkeys([*texts, *following, *edited]))}
    found = sampler.fingerprints(list(number))
    prints, after, changed = (found[[number[t] for t in some]] for some in (texts, following, edited))
    return [
        pa.array(ids, pa.int64()),
        pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited]),
        pa.array([p.tobytes() for p in prints], pa.binary()),
        pa.array([p.tobytes() for p in changed], pa.binary()),
        pa.array(likeness(prints, changed)),
        pa.array(likeness(prints, after)),
    ]


def _blocks(placed: DataFrame, block_docs: int):
    """Number of the block of each document, rising with (doc_id, h), null ids first.

    Blocks are cut between the approximate quantiles of the ids, in as many equal widths as the documents between
    two of them ask for, so clusters of ids far apart fill blocks of their own. An id that is
    the value of several quantiles, and the lack of one, is cut by the hash of the text instead.
    """
    at = [i / _QUANTILES for i in range(_QUANTILES + 1)]
    seen = placed.agg(F.count("doc_id").alias("n"), F.count(F.lit(1)).alias("rows"), F.percentile_approx("doc_id", at, 20 * _QUANTILES).alias("q")).first()
    stride = 1
    while stride < _QUANTILES and stride * seen.n < _QUANTILES * block_docs:
        stride *= 2
    times = Counter((seen.q or [])[::stride])
    each = seen.n * stride / _QUANTILES

    def parts(docs: float, most: int) -> int:
        return max(1, min(most, math.ceil(docs / block_docs)))

    none_parts = number = parts(seen.rows - seen.n, _MOST_PARTS)
    # segments: least id, parts cut by hash (0: by width), ids in a part, first block
    segments = []
    borders = sorted(times)
    for border, following in zip(borders, [*borders[1:], None][: len(borders)], strict=True):
        start = border
        if times[border] > 1:
            cut = parts(times[border] * each, _MOST_PARTS)
            segments.append((border, cut, 1, number))
            number, start = number + cut, border + 1
        ids = 1 if following is None else following - start
        if ids > 0 and start < 1 << 63:
            n = parts(each, min(_MOST_PARTS, ids))
            segments.append((start, 0, -(-ids // n), number))
            number += n
    leasts, cuts, widths, firsts = zip(*(segments or [(0, 0, 1, number)]), strict=True)
    leasts, cuts, firsts = (np.array(c, np.int64) for c in (leasts, cuts, firsts))
    widths = np.array(widths, np.uint64)
    lasts = np.r_[firsts[1:], number] - 1

    @F.arrow_udf("long")
    def block_of(doc_id: pa.Array, h: pa.Array) -> pa.Array:
        missing = doc_id.is_null().to_numpy(zero_copy_only=False)
        given = doc_id.fill_null(0).to_numpy(zero_copy_only=False)
        high = (h.to_numpy(zero_copy_only=False) >> 32) + (1 << 31)
        segment = np.maximum(np.searchsorted(leasts, given, side="right") - 1, 0)
        ids = np.maximum(given, leasts[segment])
        # unsigned, since ids may lie more than 2^63 apart
        step = ((ids.astype(np.uint64) - leasts[segment].astype(np.uint64)) // widths[segment]).astype(np.int64)
        step = np.where(cuts[segment] > 0, high * cuts[segment] >> 32, step)
        # an id before the least quantile goes before all parts of the first segment
        step = np.where(given < leasts[segment], 0, step)
        found = np.minimum(firsts[segment] + step, lasts[segment])
        return pa.array(np.where(missing, high * none_parts >> 32, found))

    return block_of("doc_id", "h")


def neighbours(docs: DataFrame, samples: int = SAMPLES, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and the likeness to it and to the next document's.

    Next is by ascending doc_id, after the last comes the first. Texts travel once, to blocks
    of neighbouring ids that are read in order; only the first and the last
    text of a block travel again, to meet across the border.
    """
    scratch = Scratch(docs.sparkSession, "fingerprints")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    placed = plain.withColumn("h", F.xxhash64("text"))
    block = _blocks(placed, block_docs)
    dealt = placed.withColumn("block", block).repartition("block").sortWithinPartitions("block", "doc_id", "h", "text")
    names = ["kind", "block", "text", *[c.split()[0] for c in _RESULT.split(", ")]]

    def border(kind, block, doc_id, text):
        columns = [pa.array([kind]), pa.array([block], pa.int64()), pa.array([text]), pa.array([doc_id], pa.int64()), *[pa.nulls(1, k) for k in _KINDS[1:]]]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def finished(ids, texts, following):
        n = len(ids)
        return pa.RecordBatch.from_arrays([pa.array(["done"] * n), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), *_compare(ids, texts, following, samples)], names=names)

    def stream(batches):
        last = None  # (block, doc_id, text) whose next document is not known yet
        ids, texts, following, chars = [], [], [], 0
        for batch in batches:
            for row in zip(batch.column("block").to_pylist(), batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                if last is not None and last[0] == row[0]:
                    ids.append(last[1])
                    texts.append(last[2])
                    following.append(row[2])
                    chars += len(last[2])
                    if len(ids) >= _CHUNK_DOCS or chars > _CHUNK_CHARS:
                        yield finished(ids, texts, following)
                        ids, texts, following, chars = [], [], [], 0
                else:
                    if last is not None:
                        yield border("last", *last)
                    yield border("first", *row)
                last = row
        if ids:
            yield finished(ids, texts, following)
        if last is not None:
            yield border("last", *last)

    stage = scratch.put(dealt.mapInArrow(stream, "kind string, block long, text string, " + _RESULT), "blocks")
    firsts = stage.where("kind = 'first'").select("block", "text")
    # the block after each, by groups of blocks so that no task orders all of them
    grouped = firsts.select("block", (F.col("block") - F.pmod("block", F.lit(4096))).alias("g"))
    groups = grouped.groupBy("g").agg(F.min("block").alias("least"))
    all_groups = Window.orderBy("g")
    after = F.coalesce(F.lead("least").over(all_groups), F.first("least").over(all_groups))
    groups = groups.select(F.col("g").alias("_g"), after.alias("_after"))
    within = F.lead("block").over(Window.partitionBy("g").orderBy("block"))
    order = grouped.withColumn("within", within).join(groups, F.col("g") == F.col("_g")).select(F.col("block").alias("_block"), F.coalesce("within", "_after").alias("_next"))
    lasts = stage.where("kind = 'last'").select("block", "doc_id", "text").join(order, F.col("block") == F.col("_block"))
    met = lasts.join(firsts.select(F.col("block").alias("_of"), F.col("text").alias("following")), F.col("_next") == F.col("_of")).select("doc_id", "text", "following")

    def meet(batches):
        for batch in batches:
            ids, texts, following = batch.column("doc_id").to_pylist(), texts_of(batch), texts_of(batch, "following")
            for a in range(0, len(ids), _CHUNK_DOCS):
                b = a + _CHUNK_DOCS
                yield pa.RecordBatch.from_arrays(_compare(ids[a:b], texts[a:b], following[a:b], samples), names=names[3:])

    done = stage.where("kind = 'done'").select(*names[3:])
    both = done.unionByName(met.mapInArrow(meet, _RESULT))
    hexed = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return both.withColumns(hexed)
