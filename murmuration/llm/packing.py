"""Packing: first-fit decreasing over a tournament tree of bin capacities.

Documents become token ids with an end id and are cut into pieces of at most one
sequence. The pieces are dealt at random into groups of bounded size, and each group is
packed on its own: in falling length, a piece goes to the first open sequence with room.
A tournament tree over the rooms left finds that sequence in logarithmic time.

Edge cases: a null text counts as empty and is packed as its end id alone; a document
without id is packed like any other; repeated rows are packed once each; a text of any length is cut into as many pieces as
it needs; the string of a special token becomes that token; an empty table gives no rows. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.llm.common import bounded_batches, sliced, texts_of
from murmuration.llm.tokens import encoder, with_end
from murmuration.sources.scratch import Scratch

CAPACITY = 1024
END_ID = 0
#: Pieces in a group, on average: enough for first-fit to fill sequences, little for a task.
GROUP_PIECES = 8192
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, nth long"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` must fall and none may exceed ``capacity``."""
    full = int((lengths == capacity).sum())
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bins[:full] = np.arange(full)
    rest = lengths[full:].tolist()
    leaves = 1
    while leaves < len(rest):
        leaves *= 2
    room = [capacity] * (2 * leaves)  # room[1] is the root; a node holds the larger of its children
    for i, length in enumerate(rest):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins[full + i], offsets[full + i] = full + node - leaves, capacity - room[node]
        room[node] -= length
        node //= 2
        while node:
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
            node //= 2
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Each document's ids with the end id, cut into pieces of at most ``capacity``.

    ``nth`` numbers the pieces of a task. ``with_ids`` adds the ids themselves, four
    little-endian bytes each.
    """
    schema = _PIECE + (", ids binary" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def cut(batches):
        encode, nth = encoder(tokenizer).encode, 0
        for batch in sliced(batches):
            doc_ids = batch.column("doc_id")
            ids, tokens = with_end(*encode(texts_of(batch)), end_id)
            pieces = -(-tokens // capacity)  # of each document, all full but the last
            document = np.repeat(np.arange(len(tokens)), pieces)
            start = capacity * (np.arange(len(document)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            length = np.minimum(capacity, tokens[document] - start)
            raw = memoryview(ids.astype("<u4").tobytes())
            at = 4 * (np.repeat(np.cumsum(tokens) - tokens, pieces) + start)
            held = [raw[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
            crc = pa.array(map(zlib.crc32, held), pa.int64())
            columns = [doc_ids.take(pa.array(document)), pa.array(start), pa.array(length), crc, pa.array(tokens[document]), pa.array(nth + np.arange(len(document)))]
            if with_ids:
                columns.append(pa.array(map(bytes, held), pa.binary()))
            nth += len(document)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def place(pieces: DataFrame, n_groups: int, capacity: int = CAPACITY, seed: int = 17) -> DataFrame:
    """Sequence and offset of each piece, packed within ``n_groups`` random groups.

    The group follows from the piece's own columns, so a repeated task deals alike.
    """
    keys = ["doc_id", "start", "ids_crc32", "nth"]
    group = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(n_groups))
    extra = ", ids binary" if "ids" in pieces.columns else ""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", *keys], ascending=[False, True, True, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(rows["length"].to_numpy(), capacity)
        rows = rows.assign(sequence_id=(rows["_group"].to_numpy(np.int64) << 32) + bins, offset=offsets)
        return rows.drop(columns=["_group", "nth"])[[c.split()[0] for c in (_PLACED + extra).split(", ")]]

    return pieces.withColumn("_group", group).groupBy("_group").applyInPandas(pack, _PLACED + extra)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, group_pieces: int = GROUP_PIECES, with_ids: bool = False) -> DataFrame:
    """Packed sequences as pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.put(token_pieces(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    n_groups = max(1, -(-pieces.count() // group_pieces))
    return place(pieces, n_groups, capacity)
