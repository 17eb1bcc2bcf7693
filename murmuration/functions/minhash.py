"""MinHash signatures and LSH bands from built-in expressions.

The base hash has two lanes, the first and the second 32 bits of md5, a function
that other SQL engines share. Permutations take turns between the lanes, so texts
of a single shingle only agree by chance if both lanes do. The permutations are
affine maps modulo a Mersenne prime, so every product stays inside a signed
64-bit integer.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1


@lru_cache(maxsize=None)
def permutation(i: int) -> tuple[int, int]:
    """Multiplier and offset of permutation ``i``, drawn from a seeded digest."""
    digest = hashlib.sha256(f"permutation {i}".encode()).digest()
    a = int.from_bytes(digest[:8], "big") % (PRIME - 1) + 1
    b = int.from_bytes(digest[8:16], "big") % PRIME
    return a, b


@lru_cache(maxsize=None)
def band_layout(threshold: float, num_perm: int, steps: int = 1000) -> tuple[int, int]:
    """(bands, rows) that balance missed and spurious collisions around ``threshold``.

    A pair of similarity s shares a band with probability 1 - (1 - s^rows)^bands;
    the layout minimises the area of that curve below the threshold plus the
    area above the curve beyond it.
    """
    points = [(i + 0.5) / steps for i in range(steps)]
    best, best_error = (1, num_perm), float("inf")
    for bands in range(1, num_perm + 1):
        for rows in range(1, num_perm // bands + 1):
            error = 0.0
            for s in points:
                collide = 1.0 - (1.0 - s**rows) ** bands
                error += collide if s < threshold else 1.0 - collide
            if error < best_error:
                best, best_error = (bands, rows), error
    return best


def shingle_starts(tokens: Column, k: int) -> Column:
    """Index of the first token of every shingle: each run of ``k`` consecutive tokens, one run if there are fewer."""
    return F.sequence(F.lit(0), F.greatest(F.size(tokens) - k, F.lit(0)))


def shingle_at(tokens: Column, start: Column, k: int) -> Column:
    """The shingle of ``k`` tokens from ``start`` on.

    Single elements are read in constant time where a slice would copy the array, and those
    past the end are null, which the join leaves out.
    """
    return F.concat_ws(" ", *[F.get(tokens, start + j) for j in range(k)])


def shingles(tokens: Column, k: int) -> Column:
    """All shingles as an array. ``tokens`` must be a plain attribute (not a split expression): it is read per shingle."""
    return F.transform(shingle_starts(tokens, k), lambda start: shingle_at(tokens, start, k))


LANES = 2


def base_hashes(digest: Column) -> list[Column]:
    """Both lanes of the md5 digest of a shingle, modulo the prime, from one conversion of its first 64 bits."""
    bits = F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")
    return [F.shiftrightunsigned(bits, 32) % PRIME, bits.bitwiseAND(F.lit((1 << 32) - 1)) % PRIME]


def permuted(h: Column, i: int) -> Column:
    a, b = permutation(i)
    return (h * F.lit(a) + F.lit(b)) % F.lit(PRIME)


def band_keys(minima: list[Column], bands: int, rows: int) -> Column:
    """Array of one key per band; equal keys mean all minima of that band are equal."""
    keys = []
    for band in range(bands):
        part = minima[band * rows : (band + 1) * rows]
        joined = F.concat_ws(",", *[m.cast("string") for m in part])
        keys.append(F.concat(F.lit(f"{band}:"), F.md5(joined.cast("binary"))))
    return F.array(*keys)
