"""Token-id output: Simple-8b words with per-block offsets.

A file row ("segment") holds consecutive documents. Its payload starts with a header and
the documents' ids and lengths, then come a table of word offsets, one per block of ids,
the 64-bit words and the escaped values. The top four bits of a word select how many ids
of how many bits its other sixty bits hold. Ids of more than sixty bits are escaped: their
word holds an index into the escaped values. Blocks are coded on their own, so one block
can be decoded without the others.

Files are a Parquet table of segments, written through Spark so that any file system it
reaches will do. Parts are ranges of doc_id in ascending order.

Edge cases: a null text counts as empty (only its end id is written); documents without
id come first; documents with equal ids are ordered by text; a longer text has a segment for itself; the string of a special
token becomes that token; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmuration.llm.common import bounded_batches, sliced, texts_of
from murmuration.llm.tokens import encoder, with_end

# Ids per word and bits per id, by selector; selector 1 is the escape.
COUNTS = (240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 1
BLOCK = 16384
MAGIC = b"S8B1"
END_ID = 2
#: Ids in a segment, about; a longer document still has one segment for itself.
SEGMENT_IDS = 1 << 20
_HEADER = "<4sIQQI"  # magic, documents, ids, words, escapes


#: Bits of each id of up to 16 bits.
_SHORT = np.frexp(np.arange(1 << 16))[1].astype(np.uint8)


def bit_widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each unsigned 64-bit value, as bytes."""
    if len(ids) and ids.max() < len(_SHORT):
        return _SHORT[ids.astype(np.int64)]
    high, low = (ids >> np.uint64(32)).astype(np.float64), (ids & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.uint8)


def encode_block(ids: np.ndarray, first_escape: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(words, escaped values) of one run of unsigned 64-bit ids."""
    n = len(ids)
    bits = bit_widths(ids)
    longest = np.concatenate([bits, np.zeros(COUNTS[0], np.uint8)])  # what lies behind the end fits anywhere
    # reach[i]: the most bits among the ids from i on, for as many as the selector takes
    selector = np.full(n, ESCAPE, np.uint8)
    size, reach = 1, longest.copy()
    for s in range(len(COUNTS) - 1, -1, -1):
        if s == ESCAPE:
            continue
        while size < COUNTS[s]:
            step = min(size, COUNTS[s] - size)
            reach = np.maximum(reach, np.concatenate([reach[step:], np.zeros(step, np.uint8)]))
            size += step
        selector[reach[:n] <= WIDTHS[s]] = s
    step = np.array(COUNTS, np.uint8)[selector].tobytes()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    chosen = selector[starts]
    words = np.zeros(len(starts), np.uint64)
    padded = np.concatenate([ids, np.zeros(COUNTS[0], np.uint64)])
    for s in np.unique(chosen):
        here = np.flatnonzero(chosen == s)
        word = np.full(len(here), np.uint64(int(s) << 60))
        if s == ESCAPE:
            word |= np.arange(first_escape, first_escape + len(here), dtype=np.uint64)
        elif WIDTHS[s]:
            for j in range(COUNTS[s]):
                word |= padded[starts[here] + j] << np.uint64(j * WIDTHS[s])
        words[here] = word
    return words, ids[starts[chosen == ESCAPE]]


def decode_words(words: np.ndarray, n: int, escapes: np.ndarray) -> np.ndarray:
    """The first ``n`` ids that ``words`` hold."""
    selector = (words >> np.uint64(60)).astype(np.uint8)
    counts = np.array(COUNTS, np.int64)[selector]
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    out = np.zeros(starts[-1], np.uint64)
    for s in np.unique(selector):
        here = np.flatnonzero(selector == s)
        if s == ESCAPE:
            out[starts[here]] = escapes[(words[here] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif WIDTHS[s]:
            mask = np.uint64((1 << WIDTHS[s]) - 1)
            for j in range(COUNTS[s]):
                out[starts[here] + j] = (words[here] >> np.uint64(j * WIDTHS[s])) & mask
    return out[:n]


def pack_segment(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    """The payload of consecutive documents whose ids are laid end to end."""
    parts, offsets, escaped, n_escaped, n_words = [], [], [], 0, 0
    for at in range(0, len(ids), BLOCK):
        offsets.append(n_words)
        words, rare = encode_block(ids[at : at + BLOCK], n_escaped)
        parts.append(words)
        escaped.append(rare)
        n_words += len(words)
        n_escaped += len(rare)
    return b"".join(
        [
            struct.pack(_HEADER, MAGIC, len(doc_ids), len(ids), n_words, n_escaped),
            bytes(d is None for d in doc_ids),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array(lengths, "<u8").tobytes(),
            np.array(offsets, "<u8").tobytes(),
            *[p.astype("<u8").tobytes() for p in parts],
            *[e.astype("<u8").tobytes() for e in escaped],
        ]
    )


class Segment:
    """A payload, read back."""

    def __init__(self, payload: bytes):
        magic, n_docs, self.n_ids, n_words, n_escapes = struct.unpack_from(_HEADER, payload)
        if magic != MAGIC:
            raise ValueError("not a Simple-8b segment")
        at = struct.calcsize(_HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(payload, kind, n, at)
            at += found.nbytes
            return found

        missing = take("u1", n_docs)
        self.doc_ids = [None if gone else d for gone, d in zip(missing, take("<i8", n_docs).tolist(), strict=True)]
        self.lengths = take("<u8", n_docs).astype(np.int64)
        self.offsets = np.append(take("<u8", -(-self.n_ids // BLOCK)).astype(np.int64), n_words)
        self.words = take("<u8", n_words)
        self.escapes = take("<u8", n_escapes)

    def block(self, b: int) -> np.ndarray:
        """The ids of block ``b`` alone."""
        n = min(BLOCK, self.n_ids - b * BLOCK)
        return decode_words(self.words[self.offsets[b] : self.offsets[b + 1]], n, self.escapes)

    def ids(self) -> np.ndarray:
        blocks = [self.block(b) for b in range(len(self.offsets) - 1)]
        return np.concatenate(blocks) if blocks else np.zeros(0, np.uint64)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of all documents, each with the end id, in ascending doc_id order.

    Rows: part, seq (segment within the part), n_docs, n_ids, first (ids of the part
    before it) and payload.
    """
    kinds = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first", pa.int64()), ("payload", pa.binary())])

    def write(batches):
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        seq, first, names, lengths, parts = 0, 0, [], [], []

        def segment():
            ids = np.concatenate(parts)
            payload = pack_segment(names, lengths, ids.astype(np.uint64))
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "n_docs": [len(names)], "n_ids": [len(ids)], "first": [first], "payload": [payload]}, schema=kinds)

        for batch in sliced(batches):
            doc_ids = batch.column("doc_id").to_pylist()
            ids, counts = with_end(*encode(texts_of(batch)), end_id)
            ends = np.cumsum(counts)
            low = 0
            while low < len(counts):
                # as many documents as the segment still has room for
                done = int(ends[low - 1]) if low else 0
                high = int(np.searchsorted(ends, done + segment_ids - sum(lengths), side="right"))
                if high <= low and names:
                    yield segment()
                    seq, first, names, lengths, parts = seq + 1, first + sum(lengths), [], [], []
                    continue
                high = max(high, low + 1)
                names += doc_ids[low:high]
                lengths += counts[low:high].tolist()
                parts.append(ids[done : int(ends[high - 1])])
                low = high
        if names:
            yield segment()

    bounded_batches(docs.sparkSession)
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = plain.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, "part int, seq int, n_docs long, n_ids long, first long, payload binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 (and its ids)."""

    def read(batches):
        for batch in batches:
            for part, first, payload in zip(*(batch.column(c).to_pylist() for c in ("part", "first", "payload")), strict=True):
                segment = Segment(payload)
                raw = segment.ids().astype("<u4").tobytes()
                ends = np.cumsum(segment.lengths) * 4
                texts = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                columns = [
                    pa.array([part] * len(texts), pa.int32()),
                    pa.array(segment.doc_ids, pa.int64()),
                    pa.array(first + ends // 4 - segment.lengths, pa.int64()),
                    pa.array(segment.lengths, pa.int64()),
                    pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                ]
                names = ["part", "doc_id", "local", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(texts, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    stored = spark.read.schema("part int, seq int, n_docs long, n_ids long, first long, payload binary").parquet(path)
    schema = "part int, doc_id long, local long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    found = stored.select("part", "first", "payload").mapInArrow(read, schema)
    # one row per file part, so this window stays small however large the parts are
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    kept = ["n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    return found.join(bases, "part").select("doc_id", (F.col("_base") + F.col("local")).alias("start"), *kept)
