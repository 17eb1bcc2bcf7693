"""What several operators share: word rule, per-worker memory, row and table helpers."""

from __future__ import annotations

import ctypes
import sys
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and return.
#: ``bytes.split()`` cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes whose words are hashed at a time.
_HASHED_BYTES = 500_000


def once_per_worker(key: tuple, make):
    """``make()``, kept by a Python worker until another key is asked for: functions shipped by value
    have no module of their own that would keep it from one task to the next. Workers outlive
    queries, so only one such object is held at a time."""
    kept = sys.__dict__.setdefault("_murmuration_kept", {})
    if key not in kept:
        kept.clear()
        give_back()
        kept[key] = make()
    return kept[key]


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Send rows to Python in batches of a few megabytes, unless the session names a size itself: texts have no
    common length, so a number of rows bounds nothing. A longer text is a batch of its own."""
    sized = "spark.murmuration.batchBytes"
    if spark.conf.get(_BATCH_BYTES, None) in (None, "67108864b", "64MB", "67108864", spark.conf.get(sized, None)):
        spark.conf.set(_BATCH_BYTES, size)
        spark.conf.set(sized, size)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def give_back() -> None:
    """Hand freed memory back to the system: a worker outlives its task and shares its executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries do so by themselves
    if trim:
        trim(0)


def sliced(batches, rows: int = 500):
    """The batches in slices of a few rows, so that few texts are Python strings at a time."""
    for batch in batches:
        for first in range(0, len(batch), rows):
            yield batch.slice(first, rows)
    give_back()


def n_words(text: Column) -> Column:
    """Number of words, as long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def split_batches(batch: pa.RecordBatch, texts: list[str], max_chars: int):
    """(batch, texts) in slices of at most ``max_chars`` characters; a longer text stands alone."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if i > start and chars + len(text) > max_chars:
            yield batch.slice(start, i - start), texts[start:i]
            start, chars = i, 0
        chars += len(text)
    if texts:
        yield batch.slice(start), texts[start:]


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number, scattered."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class _Numbers(dict):
    """Numbers words in the order in which they are met."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def word_hashes(encoded: list[bytes], lanes: int = 2) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per text, and a 64-bit hash per lane of every word of all texts: the halves of a 128-bit hash of each
    different word."""
    counts, hashes = [np.zeros(0, np.int64)], [np.zeros((0, 2), np.uint64)]
    first = size = 0
    for i, text in enumerate(encoded):
        size += len(text)
        if size >= _HASHED_BYTES or i == len(encoded) - 1:
            split = [e.split() for e in encoded[first : i + 1]]
            own = np.fromiter(map(len, split), np.int64, len(split))
            table = _Numbers()
            numbers = np.fromiter(map(table.__getitem__, chain.from_iterable(split)), np.int64, int(own.sum()))
            digests = np.frombuffer(b"".join(map(xxh3_128_digest, table)), "<u8").reshape(-1, 2)
            counts.append(own)
            hashes.append(digests[numbers])
            first, size = i + 1, 0
    whole = np.concatenate(hashes)
    return np.concatenate(counts), [np.ascontiguousarray(whole[:, lane]) for lane in range(lanes)]
