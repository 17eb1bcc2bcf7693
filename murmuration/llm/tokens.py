"""Token ids of whole texts, by a public byte-level BPE vocabulary.

The library's own encoder spends most of its time on splitting and on words it has merged
before. A text may be cut before every blank that stands before a non-blank character
without changing its ids: the splitting rule attaches such a blank to what follows, and
no rule reaches across. So each different piece between such cuts is encoded once per worker and
remembered under a hash of its bytes, in flat arrays without an object per piece.

The unknown pieces of some texts are encoded by one call of the library, laid end to end; their ids are told
apart by the bytes that each stands for. The bytes of all ids found are compared with the texts: should two pieces
share a hash, the text goes to the library whole. So does a text with the string of a special token, since that
is looked for before any splitting. The ids come from the library in every case.
"""

from __future__ import annotations

import os
import re

import numpy as np

from murmuration.llm.common import mixed, once_per_worker

#: Bytes of remembered pieces that a worker keeps, about; then it starts anew.
CACHE_BYTES = 48_000_000
#: What a piece takes besides its ids: hash and number in a table half full, place and size.
_PIECE_BYTES = 40
#: Bytes of a piece that is remembered, at most.
_LONGEST = 100
_U = np.uint64
_VALUES = np.random.default_rng(20_240_301).integers(1, 1 << 63, 256, np.uint64)
_ODD = _U(0x9E3779B97F4A7C15)


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


#: Bytes that surely begin a character that is no white space: ASCII signs, and the first bytes of
#: characters from U+00C0 to U+07FF, from U+4000 to U+FFFF and beyond. Not to cut is never wrong.
_SOLID = np.zeros(256, bool)
_SOLID[33:127] = _SOLID[0xC3:0xE0] = _SOLID[0xE4:0xF5] = True


_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[33:127] = True


def cuts(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin: at texts (which end at ``ends``), before a blank that a solid character follows, before a single mark
    behind a letter and before white space or the end, and around a single line feed between a sign and a letter.
    The splitting rule never reaches across these places."""
    last = np.zeros(len(flat), bool)
    last[ends - 1] = True
    first = np.r_[True, last[:-1]]
    after, before = np.r_[flat[1:], np.uint8(0)], np.r_[np.uint8(0), flat[:-1]]
    out = first | ((flat == 32) & _SOLID[after] & ~last)
    out |= _MARK[flat] & _LETTER[before] & ((after == 32) | (after == 10) | last)
    feed = (flat == 10) & _GRAPHIC[before] & _LETTER[after] & ~first & ~last
    out |= feed
    out[1:] |= feed[:-1]
    return out


def laid_out(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of runs end to end: ``sizes[k]`` numbers from ``starts[k]`` on."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))


class HashTable:
    """Numbers by 64-bit keys: open addressing over arrays, at most half full."""

    def __init__(self, bits: int = 14):
        self.bits, self.used = bits, 0
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 if it has none."""
        out = np.full(len(keys), -1, np.int64)
        open_, at = np.arange(len(keys)), self._place(keys)
        while len(open_):
            here = self.keys[at]
            hit = here == keys[open_]
            out[open_[hit]] = self.values[at[hit]]
            on = ~hit & (here != 0)
            open_, at = open_[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """New, distinct keys."""
        if 2 * (self.used + len(keys)) > 1 << self.bits:
            old = self.keys != 0
            keys, values = np.concatenate([self.keys[old], keys]), np.concatenate([self.values[old], values])
            bits = self.bits
            while 2 * len(keys) > 1 << bits:
                bits += 1
            self.__init__(bits)
        self.used += len(keys)
        at = self._place(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] == 0)
            _, one = np.unique(at[free], return_index=True)  # one key for each free place
            put = free[one]
            self.keys[at[put]], self.values[at[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, at = keys[rest], values[rest], (at[rest] + 1) & ((1 << self.bits) - 1)


class Encoder:
    """Encodes texts. With ``special`` the string of a special token becomes this token, as the library does by
    default; without, it is plain text."""

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, added))) if special and added else None
        letters = {c: b for b, c in byte_letters().items()}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        spelt = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            spelt[i] = token.encode() if token in added else bytes(letters[c] for c in token)
        #: The bytes that each id stands for, and all end to end.
        self.spelt = spelt
        self.bytes_of = np.fromiter(map(len, spelt), np.int64, len(spelt))
        self.letters_at = np.cumsum(self.bytes_of) - self.bytes_of
        self.letters = np.frombuffer(b"".join(spelt), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.table = HashTable()
        self.ids, self.n_ids = np.zeros(1 << 16, np.uint16 if len(self.spelt) <= 1 << 16 else np.uint32), 0
        self.starts, self.sizes, self.n_pieces = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), 0

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text by one call of the library."""
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def bytes_for(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the ids stand for."""
        return self.letters[laid_out(self.letters_at[ids], self.bytes_of[ids])]

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers for new pieces, whose ids are laid end to end."""
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n_pieces + len(sizes) > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        numbers = np.arange(self.n_pieces, self.n_pieces + len(sizes))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.starts[numbers], self.sizes[numbers] = self.n_ids + np.cumsum(sizes) - sizes, sizes
        self.n_ids, self.n_pieces = self.n_ids + len(ids), self.n_pieces + len(sizes)
        return numbers

    def _learn(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Numbers for unknown pieces. Those that begin with a blank and a solid character can follow each other."""
        follows = (sizes > 1) & (flat[starts] == 32) & _SOLID[flat[np.minimum(starts + 1, len(flat) - 1)]]
        numbers = np.zeros(len(starts), np.int64)
        if follows.any():
            first, size = starts[follows], sizes[follows]
            ids = self.whole(flat[laid_out(first, size)].tobytes().decode())
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(size)) + 1
            numbers[follows] = self._add(ids, np.diff(np.r_[0, ends]))
        if not follows.all():
            alone = [flat[a : a + n].tobytes().decode() for a, n in zip(starts[~follows].tolist(), sizes[~follows].tolist(), strict=True)]
            found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
            numbers[~follows] = self._add(np.concatenate(found), np.array([len(f) for f in found]))
        return numbers

    def _by_pieces(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text) of texts that are not empty and have no special token."""
        if 2 * self.n_ids + _PIECE_BYTES * self.n_pieces > CACHE_BYTES:
            self._forget()
        flat = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        starts = np.flatnonzero(cuts(flat, ends))
        sizes = np.diff(np.r_[starts, len(flat)])
        place = np.arange(len(flat)) - np.repeat(starts, sizes)
        powers = np.cumprod(np.r_[_U(1), np.full(int(sizes.max()) - 1, _ODD)], dtype=np.uint64)
        hashes = mixed(np.add.reduceat(_VALUES[flat] * powers[place], starts) + sizes.astype(np.uint64)) | _U(1)
        del place
        numbers = self.table.get(hashes)
        unknown = np.flatnonzero(numbers < 0)
        long, before = np.zeros(0, np.int64), None
        if len(unknown):
            new, first, of = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            first = unknown[first]
            short = sizes[first] <= _LONGEST
            found = np.zeros(len(new), np.int64)
            if short.any():
                found[short] = self._learn(flat, starts[first[short]], sizes[first[short]])
                self.table.add(new[short], found[short])
            before = self.n_ids, self.n_pieces
            long = first[~short]
            if len(long):
                found[~short] = self._learn(flat, starts[long], sizes[long])
            numbers[unknown] = found[of]
        n = self.sizes[numbers].astype(np.int64)
        ids = self.ids[laid_out(self.starts[numbers], n)].astype(np.uint32)
        upto = np.r_[0, np.cumsum(n)][np.searchsorted(starts, ends)]
        if len(long):  # long pieces are not remembered
            self.n_ids, self.n_pieces = before
        return ids, np.diff(np.r_[0, upto])

    def _proven(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same, compared with the texts."""
        ids, counts = self._by_pieces(texts)
        spelt, flat = self.bytes_for(ids), b"".join(texts)
        if len(spelt) == len(flat) and (spelt == np.frombuffer(flat, np.uint8)).all():
            return ids, counts
        if len(texts) > 1:
            found = [self._proven([t]) for t in texts]
        else:
            found = [(own := self.whole(texts[0].decode()), [len(own)])]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each)."""
        counts = np.zeros(len(texts), np.int64)
        parts, plain = [], []  # runs of texts to be cut, as (first, encoded texts)

        def flush() -> None:
            if plain:
                ids, n = self._proven([t for _, t in plain])
                parts.append(ids)
                counts[[i for i, _ in plain]] = n
                plain.clear()

        for i, text in enumerate(texts):
            if self.special and self.special.search(text):
                flush()
                parts.append(self.whole(text))
                counts[i] = len(parts[-1])
            elif text:
                plain.append((i, text.encode("utf-8", "replace")))
        flush()
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), counts


def encoder(path: str, special: bool = True) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return once_per_worker(("encoder", path, special), lambda: Encoder(path, special))


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with the end id after each text."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end_id)), counts + 1
