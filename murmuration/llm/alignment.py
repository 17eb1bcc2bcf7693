"""Cross-tokenizer alignment: how the tokens of two vocabularies stand over the same text.

1. Texts are shuffled whole, and equal ones become one row with their number.
2. Each distinct text is encoded by both tokenizers and aligned once. Where both have a token end the text is cut into groups;
   tokens whose bytes overlap are linked. Byte offsets are sums over whole batches, so this is array work. A row
   keeps its measures and its distinct linked id pairs.
3. The pairs are counted, weighted by the number of equal texts and added up in each task before they travel. A
   pair's count is the number of documents that hold it linked.
4. Rows look up the counts of their pairs. The table of pairs is dealt into parts of at most about ``part_pairs``; each is
   broadcast on its own and read against all rows, so that what is broadcast at a time is bounded whatever the vocabularies.
5. The measures return to the documents by a digest of the text.

Edge cases: a text that is null or empty, or whose tokens do not spell a blank and the text byte by byte, has no tokens: its
measures are 0 and its groups are ''. The strings of special tokens in a text are plain text. Texts of any length are
treated whole. A document without id is treated like any other; repeated rows each have their row; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuration.llm.common import bounded_batches, give_back, once_per_worker, sliced, split_batches
from murmuration.llm.tokens import Encoder
from murmuration.sources.scratch import Scratch

#: Characters that are aligned at once; a longer text stands alone.
CHUNK_CHARS = 1_000_000
#: Longer texts go to the second tokenizer in parts of about so many characters.
PART_CHARS = 1 << 16
#: Pairs of a part of the counted table (13 bytes each when broadcast).
PART_PAIRS = 2_000_000
#: Pairs that a task holds before it passes on their sums.
_HELD = 2_000_000
_B_BITS = 15
_CODEC = "zstd"


class PieceEncoder:
    """A sentencepiece vocabulary, with the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.spelt = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes_of = np.fromiter(map(len, self.spelt), np.int64, n)
        #: No piece goes on over a blank behind another character, so a text may be cut there.
        self.cuttable = not any(a != "▁" and b == "▁" for p in pieces for a, b in itertools.pairwise(p))

    def _parts(self, text: str) -> list[str]:
        """The text in parts that can be encoded alone; each loses the blank that the tokenizer adds before it."""
        out, start = [], 0
        while self.cuttable and len(text) - start > PART_CHARS:
            at = text.find(" ", start + PART_CHARS)
            while at > 0 and text[at - 1] in " ▁":
                at = text.find(" ", at + 1)
            if at < 0 or at + 1 == len(text):  # nothing would be left to encode
                break
            out.append(text[start:at])
            start = at + 1
        return [*out, text[start:]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each)."""
        parts = [self._parts(t) for t in texts]
        found = self.model.encode([p for own in parts for p in own], num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), np.int64, int(sizes.sum()))
        last = np.cumsum([len(own) for own in parts])
        return ids, np.diff(np.r_[0, np.r_[0, np.cumsum(sizes)][last]])


class Aligner:
    """Both tokenizers, and the decimal ids that the groups are written with."""

    def __init__(self, first: str, second: str):
        self.a, self.b = Encoder(first, special=False), PieceEncoder(second)
        numbers = [str(i).encode() for i in range(max(len(self.a.spelt), len(self.b.spelt)))]
        self.written = [np.array([n + mark for n in numbers], object) for mark in (b",", b"|", b";")]

    def align(self, texts: list[str]) -> Aligned:
        return Aligned(self, texts)


class Aligned:
    """Tokens, groups and links of some texts that are not empty. Arrays run over all texts that have tokens."""

    def __init__(self, by: Aligner, texts: list[str]):
        self.by, n = by, len(texts)
        a, n_a = by.a.encode([" " + t for t in texts])
        b, n_b = by.b.encode(texts)
        whole = [b" " + t.encode() for t in texts]
        usable = np.ones(n, bool)
        for coder, ids, counts in ((by.a, a, n_a), (by.b, b, n_b)):
            spelt = b"".join(map(coder.spelt.__getitem__, ids.tolist()))
            ends = np.r_[0, np.cumsum(coder.bytes_of[ids])][np.r_[0, np.cumsum(counts)]].tolist()
            usable &= np.array([spelt[x:y] == t for x, y, t in zip(ends, ends[1:], whole, strict=False)], bool)
        self.usable = usable
        self.a, self.b = a[np.repeat(usable, n_a)].astype(np.int64), b[np.repeat(usable, n_b)]
        self.n_a, self.n_b = np.where(usable, n_a, 0), np.where(usable, n_b, 0)
        self.end_a, self.end_b = np.cumsum(by.a.bytes_of[self.a]), np.cumsum(by.b.bytes_of[self.b])
        self.bounds = np.intersect1d(self.end_a, self.end_b, assume_unique=False)
        self.group_a, self.group_b = np.searchsorted(self.bounds, self.end_a), np.searchsorted(self.bounds, self.end_b)

    def n_groups(self) -> np.ndarray:
        last = np.r_[0, self.group_a + 1][np.cumsum(self.n_a)] if len(self.a) else np.zeros(len(self.n_a), np.int64)
        return np.diff(np.r_[0, last])

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place among the first tokens, place among the second) of all overlapping pairs."""
        start_a, start_b = np.r_[0, self.end_a[:-1]], np.r_[0, self.end_b[:-1]]
        first = np.searchsorted(self.end_b, start_a, side="right")
        many = np.searchsorted(start_b, self.end_a, side="left") - first
        at_a = np.repeat(np.arange(len(self.a)), many)
        at_b = np.arange(len(at_a)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
        return np.repeat(np.arange(len(self.n_a)), self.n_a)[at_a], at_a, at_b

    def written_groups(self) -> list[bytes]:
        """The groups of each text as a1,a2|b1;a3|b2,b3."""
        comma, bar, semicolon = self.by.written
        size_a, size_b = (np.bincount(g, minlength=len(self.bounds)) for g in (self.group_a, self.group_b))
        before_a, before_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        out = np.empty(len(self.a) + len(self.b), object)
        for ids, group, mark, other in ((self.a, self.group_a, bar, before_b), (self.b, self.group_b, semicolon, before_a + size_a)):
            last = np.r_[group[1:] != group[:-1], True] if len(group) else np.zeros(0, bool)
            out[np.arange(len(ids)) + other[group]] = np.where(last, mark[ids], comma[ids])
        ends = np.cumsum(self.n_a + self.n_b)
        listed = out.tolist()
        return [b"".join(listed[x:y])[:-1] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _packed(codes: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    """Rising codes and how often each occurs, compressed."""
    step = np.diff(codes, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return tuple(pa.compress(raw, _CODEC, asbytes=True) for raw in (step, times.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()))


def _unpacked(n: int, packed: bytes) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(packed, 4 * n, _CODEC, asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    return np.ascontiguousarray(raw.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


_MEASURES = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ALIGNED = f"key binary, copies long, {_MEASURES}, n_pairs int, codes binary, times binary"


def aligned_texts(docs: DataFrame, first: str, second: str, with_groups: bool = False) -> DataFrame:
    """One row per distinct text: its key, copies, measures and distinct linked pairs (and its groups)."""
    schema = _ALIGNED + (", groups string" if with_groups else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def align(batches):
        aligner = once_per_worker(("aligner", first, second), lambda: Aligner(first, second))
        for batch in sliced(batches):
            for some, texts in split_batches(batch, batch.column("text").to_pylist(), CHUNK_CHARS):
                found = aligner.align(texts)
                of, at_a, at_b = found.links()
                pairs, times = np.unique(of << 32 | found.a[at_a] << _B_BITS | found.b[at_b], return_counts=True)
                cut = np.searchsorted(pairs, np.arange(len(texts) + 1) << 32)
                groups = found.written_groups()
                packed = [_packed(pairs[x:y] & 0xFFFFFFFF, times[x:y]) for x, y in itertools.pairwise(cut.tolist())]
                shas = [hashlib.sha256(g).hexdigest() if ok else "" for g, ok in zip(groups, found.usable.tolist(), strict=True)]
                columns = [some.column("key"), some.column("copies"), found.n_a, found.n_b, found.n_groups(), np.bincount(of, minlength=len(texts)), shas, np.diff(cut).astype(np.int32)]
                columns += [pa.array(c, pa.binary()) for c in zip(*packed, strict=True)]
                if with_groups:
                    columns.append([g.decode() for g in groups])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    bounded_batches(docs.sparkSession)
    distinct = docs.where("text <> ''").groupBy(F.col("text").cast("string").alias("text")).agg(F.count(F.lit(1)).alias("copies"))
    keyed = distinct.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), "copies", "text")
    return keyed.mapInArrow(align, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, code, n, best): how many documents hold a pair, and whether no pair with its first id has more."""

    def add(batches):
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def summed(codes, counts):
            codes, of = np.unique(codes, return_inverse=True)
            total = np.zeros(len(codes), np.int64)
            np.add.at(total, of, counts)
            return codes, total

        new_codes, new_counts, held = [codes], [counts], 0
        for batch in batches:
            for copies, n, packed in zip(*(batch.column(c).to_pylist() for c in ("copies", "n_pairs", "codes")), strict=True):
                new_codes.append(np.cumsum(_unpacked(n, packed)))
                new_counts.append(np.full(n, copies, np.int64))
                held += n
                if held > _HELD:
                    codes, counts = summed(np.concatenate(new_codes), np.concatenate(new_counts))
                    if len(codes) > _HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])
                        codes, counts = codes[:0], counts[:0]
                    new_codes, new_counts, held = [codes], [counts], 0
        codes, counts = summed(np.concatenate(new_codes), np.concatenate(new_counts))
        for x in range(0, len(codes), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(codes[x : x + 100_000]), pa.array(counts[x : x + 100_000])], names=["code", "n"])
        give_back()

    parts = aligned.select("copies", "n_pairs", "codes").mapInArrow(add, "code long, n long")
    counted = parts.groupBy("code").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("code", _B_BITS))
    # an id has as many pairs at most as the second vocabulary has ids
    highest = counted.groupBy("a").agg(F.max("n").alias("most"))
    return counted.join(highest, "a").select("a", "code", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, first: str, second: str, part_pairs: int = PART_PAIRS, with_groups: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and its groups).

    ``n_best`` are the links whose count is the highest of their first id, ``count_sum`` is the sum of the counts of all links.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "alignment")
    aligned = scratch.put(aligned_texts(docs, first, second, with_groups), "aligned")
    counts = scratch.put(pair_counts(aligned), "pairs")
    parts = max(1, -(-counts.count() // part_pairs))
    part = F.pmod(F.xxhash64("code"), F.lit(parts))

    def scored(number: int) -> DataFrame:
        rows = counts.where(part == number).select("code", "n", "best").toArrow()  # about part_pairs rows
        order = np.argsort(rows["code"].to_numpy())
        table = spark.sparkContext.broadcast((rows["code"].to_numpy()[order].astype(np.uint32), rows["n"].to_numpy()[order], rows["best"].to_numpy()[order]))

        def score(batches):
            codes, n, best = table.value
            for batch in batches:
                n_best, total = [], []
                for m, packed, times in zip(*(batch.column(c).to_pylist() for c in ("n_pairs", "codes", "times")), strict=True):
                    own, often = np.cumsum(_unpacked(m, packed)).astype(np.uint32), _unpacked(m, times)
                    at = np.minimum(np.searchsorted(codes, own), max(0, len(codes) - 1))
                    here = codes[at] == own if len(codes) else np.zeros(len(own), bool)
                    n_best.append(int(often[here & best[at]].sum()) if len(codes) else 0)
                    total.append(int((often * n[at])[here].sum()) if len(codes) else 0)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(n_best, pa.int64()), pa.array(total, pa.int64())], names=["key", "n_best", "count_sum"])
            give_back()

        return aligned.select("key", "n_pairs", "codes", "times").mapInArrow(score, "key binary, n_best long, count_sum long")

    by_text = scored(0)
    for number in range(1, parts):
        by_text = by_text.unionByName(scored(number))
    by_text = by_text.groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    kept = [c.split()[0] for c in _MEASURES.split(", ")] + (["groups"] if with_groups else [])
    measures = aligned.select("key", *kept).join(by_text, "key")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    held = plain.where("text <> ''").select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *kept[5:]]
    found = held.join(measures, "key").select(*columns)
    zero = [F.lit(0).cast("long").alias(c) for c in columns[1:7]] + [F.lit("").alias(c) for c in columns[7:]]
    return found.unionByName(plain.where("text IS NULL OR text = ''").select("doc_id", *zero))
