"""Substring dedup: windows of words that occur more than once, behind a count-min prefilter.

A window is ``width`` consecutive words of one document. Every word that a repeated window
covers is removed, in each of its places.

1. Sketch. A window is counted under its anchor: of the runs of ``anchor`` words inside it the one with
   the least hash. Equal windows have equal anchors at the same place within them, so an
   anchor occurs at least as often as any window that has it; windows with a common anchor at the same
   place of the text are counted once, which keeps the sketch about a tenth as large. A task's
   sketch is sent as the counters it has touched, the sketches are merged per block of counters, and
   what is left is one bit per counter: touched twice or more. A count-min
   estimate is the least of an anchor's counters, so it is never too low.
2. Exact groups. A window whose anchor is estimated to be single is single. The others are
   grouped by 128 bits of hashes of their word sequence (64 of the anchor, 64 of the window), made from the halves of a
   128-bit hash of each word. A task reports each hash once per chunk of
   documents, however often it occurs there, so that copies do not meet in one task row by row.
3. Candidates that turn out to be single return to the chunks that hold them; the words that the
   others cover are removed. Only documents with candidates are stored with their text.

The bitmap is the only thing broadcast: ``rows`` bits per counter, at most 2^max_bits counters, whatever
the input. With more anchors than counters the estimates become loose and more windows are
grouped exactly; the result stays the same.

Edge cases: a null text counts as empty; documents of fewer words than a window lose nothing;
a document without id is treated like any other; repeated rows are documents of their own (their windows
repeat); a very long text is a chunk of its own; an empty table gives no rows. Other columns are not read by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.llm.common import bounded_batches, mixed, sliced, split_batches, texts_of, word_hashes
from murmuration.sources.scratch import Scratch

WIDTH = 35
ANCHOR = 10
ROWS = 2
#: A sketch row has at most 2^30 counters: a bitmap of 128 MB.
MAX_BITS = 30
#: Counters that are merged together.
BLOCK_BITS = 20
#: Characters of a chunk of documents; a longer document is a chunk of its own.
CHUNK_CHARS = 2_000_000
#: Documents of a chunk, at most.
CHUNK_DOCS = 600
_U = np.uint64


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on, by doubling; as long as there are n words."""
    size, part, done, out = 1, words, 0, None
    while True:
        if n & size:
            out = part if out is None else _join(out, part, done)
            done += size
        if 2 * size > n:
            return out[: max(0, len(words) - n + 1)]
        part = _join(part, part, size)
        size *= 2


def _join(a: np.ndarray, b: np.ndarray, gap: int) -> np.ndarray:
    """Hash of what a[i] stands for followed by what b[i + gap] stands for."""
    n = max(0, min(len(a), len(b) - gap))
    return mixed(a[:n] * _U(0xD6E8FEB86659FD93) + b[gap : gap + n] + _U(gap))


def least_places(values: np.ndarray, n: int) -> np.ndarray:
    """Place of the least of ``n`` values from each place on, the leftmost if equal."""
    total = len(values) - n + 1
    if total <= 0:
        return np.zeros(0, np.int64)
    best, at, size = values, np.arange(len(values)), 1
    while size < n:
        step = min(size, n - size)
        a, b = best[:-step], best[step:]
        right = b < a
        best, at = np.where(right, b, a), np.where(right, at[step:], at[:-step])
        size += step
    return at[:total]


class Chunk:
    """The words and windows of a few documents laid end to end."""

    def __init__(self, texts: list[str], width: int, anchor: int):
        self.encoded = [t.encode("utf-8", "replace") for t in texts]
        self.counts, (self.low, self.high) = word_hashes(self.encoded)
        self.ends = np.cumsum(self.counts)
        runs = run_hashes(self.low, anchor)
        place = least_places(runs, width - anchor + 1)
        # a window may not reach over the end of its document
        left = np.repeat(self.ends, self.counts) - np.arange(len(self.low))
        self.starts = np.flatnonzero(left[: len(place)] >= width)
        self.place = place[self.starts]
        self.anchors = runs


def _counters(anchors: np.ndarray, bits: int, row: int) -> np.ndarray:
    """The counter of each anchor in a row of the sketch."""
    return mixed(anchors + _U(row) * _U(0xA24BAED4963EE407)) >> _U(64 - bits)


def partition_sketches(docs: DataFrame, bits: int, width: int, anchor: int) -> DataFrame:
    """(row, block, once, more): per task, counters of a block that were touched once and more often."""
    block_bits = min(bits, BLOCK_BITS)

    def sketch(batches):
        for batch in batches:
            found = []
            for part in sliced([batch], CHUNK_DOCS):
                for _, texts in split_batches(part, texts_of(part), CHUNK_CHARS):
                    chunk = Chunk(texts, width, anchor)
                    found.append(chunk.anchors[np.unique(chunk.place)])
            anchors = np.concatenate(found) if found else np.zeros(0, _U)
            out = []
            for row in range(ROWS):
                touched, times = np.unique(_counters(anchors, bits, row), return_counts=True)
                block = (touched >> _U(block_bits)).astype(np.int64)
                inside = (touched & _U((1 << block_bits) - 1)).astype("<u4")
                at = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.zeros(0, np.int64)
                for a, b in zip(at, np.r_[at[1:], len(block)] if len(at) else at, strict=True):
                    more = times[a:b] > 1
                    out.append((row, int(block[a]), inside[a:b][~more].tobytes(), inside[a:b][more].tobytes()))
            if out:
                columns = zip(*out, strict=True)
                kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["row", "block", "once", "more"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(sketch, "row int, block int, once binary, more binary")


def merged_bitmaps(sketches: DataFrame, bits: int) -> DataFrame:
    """(row, block, repeated): the counters of a block that were touched twice or more, one bit each."""
    block_bits = min(bits, BLOCK_BITS)

    def merge(batches):
        seen: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row, block, once, more in zip(*(batch.column(c).to_pylist() for c in ("row", "block", "once", "more")), strict=True):
                if (row, block) not in seen:
                    seen[row, block] = np.zeros(1 << block_bits, bool), np.zeros(1 << block_bits, bool)
                touched, repeated = seen[row, block]
                once, more = np.frombuffer(once, "<u4"), np.frombuffer(more, "<u4")
                repeated[once[touched[once]]] = True
                repeated[more] = True
                touched[once] = True
                touched[more] = True
        for (row, block), (_, repeated) in seen.items():
            if repeated.any():
                packed = np.packbits(repeated, bitorder="little").tobytes()
                yield pa.RecordBatch.from_pydict({"row": pa.array([row], pa.int32()), "block": pa.array([block], pa.int32()), "repeated": [packed]})

    blocks = ROWS << (bits - block_bits)
    return sketches.repartition(min(blocks, 256), "row", "block").mapInArrow(merge, "row int, block int, repeated binary")


def repeated_bits(docs: DataFrame, bits: int, width: int, anchor: int) -> np.ndarray:
    """The merged sketch: a row of bytes per sketch row, one bit per counter."""
    block_bits = min(bits, BLOCK_BITS)
    found = np.zeros((ROWS, 1 << (bits - 3)), np.uint8)
    size = 1 << (block_bits - 3)
    merged = merged_bitmaps(partition_sketches(docs, bits, width, anchor), bits)
    for r in merged.toLocalIterator():  # at most ROWS * 2^bits bits
        found[r.row, r.block * size : (r.block + 1) * size] = np.frombuffer(r.repeated, np.uint8)
    return found


def _estimated_repeated(bitmap: np.ndarray, anchors: np.ndarray, bits: int) -> np.ndarray:
    out = np.ones(len(anchors), bool)
    for row in range(ROWS):
        c = _counters(anchors, bits, row)
        out &= (bitmap[row][(c >> _U(3)).astype(np.int64)] >> (c & _U(7)).astype(np.uint8)) & 1 == 1
    return out


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that starts at one of ``starts``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + width, n), -1)
    return np.cumsum(steps)[:n] > 0


_STORED = "kind string, chunk long, pos int, doc_id long, n_words long, kept_sha256 string, text string, runs binary, anchors binary, sizes binary, windows binary"
_KINDS = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.binary()] * 4]
#: Keys of a chunk's rows in step 2 that go into one row of the stored table.
_KEYS_A_ROW = 20_000


def runs_of(numbers: np.ndarray) -> np.ndarray:
    """Rising numbers as (first, how many) of each run without gaps."""
    first = np.flatnonzero(np.r_[True, np.diff(numbers) > 1]) if len(numbers) else np.zeros(0, np.int64)
    return np.stack([numbers[first], np.diff(np.r_[first, len(numbers)])], axis=1).astype("<u4")


def numbers_of(runs: np.ndarray) -> np.ndarray:
    first, size = runs[:, 0].astype(np.int64), runs[:, 1].astype(np.int64)
    return np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())


def _distinct(anchors: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchors, windows of each, windows): one entry per distinct pair, two if it occurs more often."""
    order = np.lexsort((windows, anchors))
    anchors, windows = anchors[order], windows[order]
    same = np.r_[False, (anchors[1:] == anchors[:-1]) & (windows[1:] == windows[:-1])]
    third = same & np.r_[False, same[:-1]]
    anchors, windows = anchors[~third], windows[~third]
    first = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
    return anchors[first], np.diff(np.r_[first, len(anchors)]), windows


def _candidates(docs: DataFrame, bitmap, bits: int, width: int, anchor: int, carry: bool) -> DataFrame:
    """Rows of kind ``doc`` (with text and candidate windows only if there are any) and, per chunk,
    ``keys``: its distinct candidate windows, by anchor. ``carry`` keeps all texts and, as ``rest``, the other columns."""
    names = [c.split()[0] for c in _STORED.split(", ")]
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    schema = _STORED
    if carry:
        rest = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"])
        columns.append(rest.alias("rest"))
        schema += f", rest {docs.select(rest.alias('rest')).schema['rest'].dataType.simpleString()}"

    def find(batches):
        part, nth = TaskContext.get().partitionId(), 0
        for batch in sliced(batches, CHUNK_DOCS):
            raw = batch.column("text").to_pylist()
            done = 0
            for some, texts in split_batches(batch, [t or "" for t in raw], CHUNK_CHARS):
                number = (part << 32) + nth
                nth += 1
                chunk = Chunk(texts, width, anchor)
                near = np.flatnonzero(_estimated_repeated(bitmap.value, chunk.anchors[chunk.place], bits))
                starts = chunk.starts[near]
                cut = np.searchsorted(starts, np.r_[0, chunk.ends])
                rows = []
                for i, doc_id in enumerate(some.column("doc_id").to_pylist()):
                    a, b = cut[i], cut[i + 1]
                    n = int(chunk.counts[i])
                    if a == b:
                        sha = hashlib.sha256(b" ".join(chunk.encoded[i].split())).hexdigest()
                        rows.append(("doc", number, i, doc_id, n, sha, raw[done + i] if carry else None, *[None] * 4))
                    else:
                        own = runs_of(starts[a:b] - (chunk.ends[i] - n))
                        rows.append(("doc", number, i, doc_id, n, None, texts[i], own.tobytes(), *[None] * 3))
                done += len(texts)
                n_docs = len(rows)
                if len(near):
                    keys, sizes, windows = _distinct(chunk.anchors[chunk.place[near]], window_hashes(chunk.low, chunk.high, width)[starts])
                    ends = np.cumsum(sizes)
                    for a in range(0, len(keys), _KEYS_A_ROW):
                        b = min(a + _KEYS_A_ROW, len(keys))
                        parts = keys[a:b].tobytes(), sizes[a:b].astype("<u4").tobytes(), windows[ends[a] - sizes[a] : ends[b - 1]].tobytes()
                        rows.append(("keys", number, *[None] * 6, *parts))
                out = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _KINDS, strict=True)]
                if carry:
                    rest = some.column("rest")
                    out.append(pa.concat_arrays([rest, pa.nulls(len(rows) - n_docs, rest.type)]))
                yield pa.RecordBatch.from_arrays(out, names=[*names, "rest"][: len(out)])

    return docs.select(*columns).mapInArrow(find, schema)


def window_hashes(low: np.ndarray, high: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of the words of each window, from the other lane than the anchors."""
    return run_hashes(high ^ (low << _U(1)), width)


def _single(stored: DataFrame) -> DataFrame:
    """(chunk, window): candidate windows that occur only once in all.

    A window's key is its anchor's hash and its own, 64 bits each; both together spread the windows, so those around
    one frequent run of words do not meet in one task.
    """

    def unpack(batches):
        for batch in batches:
            for chunk, anchors, sizes, windows in zip(*(batch.column(c).to_pylist() for c in ("chunk", "anchors", "sizes", "windows")), strict=True):
                windows = np.frombuffer(windows, np.int64)
                anchors = np.repeat(np.frombuffer(anchors, np.int64), np.frombuffer(sizes, "<u4"))
                columns = [pa.array(np.full(len(windows), chunk, np.int64)), pa.array(anchors), pa.array(windows)]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "anchor", "window"])

    flat = stored.where("kind = 'keys'").select("chunk", "anchors", "sizes", "windows").mapInArrow(unpack, "chunk long, anchor long, window long")
    # counted per chunk, so copies inside a chunk are one row
    counted = flat.groupBy("anchor", "window").agg(F.count(F.lit(1)).alias("n"), F.first("chunk").alias("chunk"))
    return counted.where("n = 1").select("chunk", "window")


def _found(docs: DataFrame, width: int, anchor: int, max_bits: int, carry: bool) -> tuple[DataFrame, DataFrame]:
    """The stored candidates, and the result for those documents that have any."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "substring")
    chars = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about one anchor in seven words; four counters or more for each
    bits = int(np.clip(np.ceil(np.log2(max(1, chars / 6 / 7 * 4))), 10, max_bits))
    bitmap = spark.sparkContext.broadcast(repeated_bits(docs, bits, width, anchor))
    stored = scratch.put(_candidates(docs, bitmap, bits, width, anchor, carry), "candidates")
    bitmap.unpersist()
    names = ["chunk", "pos", "doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]

    def remove(rows: pd.DataFrame, single: pd.DataFrame) -> pd.DataFrame:
        alone = np.sort(single["window"].to_numpy(np.int64).view(_U))
        encoded = [t.encode("utf-8", "replace") for t in rows["text"]]
        counts, (low, high) = word_hashes(encoded)
        hashes = window_hashes(low, high, width)
        first = np.cumsum(counts) - counts
        out = []
        for i, r in enumerate(rows.itertuples(index=False)):
            starts = numbers_of(np.frombuffer(r.runs, "<u4").reshape(-1, 2))
            own = hashes[starts + first[i]]
            at = np.minimum(np.searchsorted(alone, own), max(0, len(alone) - 1))
            hit = alone[at] != own if len(alone) else np.ones(len(own), bool)
            gone = covered(starts[hit], width, int(counts[i]))
            words = encoded[i].split()
            kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
            removed = int(gone.sum())
            text = kept.decode() if removed else r.text if carry else None
            out.append((r.chunk, r.pos, r.doc_id, len(words), removed, hashlib.sha256(kept).hexdigest(), text))
        return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    suspects = stored.where("kind = 'doc' AND runs IS NOT NULL").select("chunk", "pos", "doc_id", "text", "runs")
    result = "chunk long, pos int, doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return stored, suspects.groupBy("chunk").cogroup(_single(stored).groupBy("chunk")).applyInPandas(remove, result)


_CLEAN = "kind = 'doc' AND runs IS NULL"


def remove_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept_text.

    ``kept_text`` has the kept words joined by one space, and is null where nothing was removed.
    """
    stored, found = _found(docs, width, anchor, max_bits, carry=False)
    nothing = (F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept_text"))
    return stored.where(_CLEAN).select("doc_id", "n_words", *nothing).unionByName(found.drop("chunk", "pos"))


def without_repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents with all their columns and without the repeated words.

    Where words were removed, ``text`` has the kept words joined by one space, and ``n_chars``, if there
    is such a column, its length.
    """
    stored, found = _found(docs, width, anchor, max_bits, carry=True)
    clean = stored.where(_CLEAN).select("rest", "text", F.lit(0).cast("long").alias("n_removed"))
    rest = stored.where("kind = 'doc' AND runs IS NOT NULL").select("chunk", "pos", "rest")
    changed = found.select("chunk", "pos", F.col("kept_text").alias("text"), "n_removed").join(rest, ["chunk", "pos"])
    both = clean.unionByName(changed.select("rest", "text", "n_removed"))

    def column(i: int, name: str):
        if name == "text":
            return F.col("text")
        value = F.col(f"rest.c{i}")
        if name == "n_chars":
            value = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(value).cast(docs.schema[name].dataType)
        return value.alias(name)

    return both.select(*[column(i, c) for i, c in enumerate(docs.columns)])
