"""Texts as byte arrays inside tasks: Arrow string columns seen through numpy.

A batch is cut into pieces of whole texts of at most ``PIECE_BYTES`` (a longer text is
a piece of its own), so the arrays made from a piece stay small and in cache.
"""

from __future__ import annotations

import hashlib
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19
LONG_WORD = 64                # bytes
HASH_SEED = 20_240_229
HASH_BASE = 0x9E3779B97F4A7C15


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow string column, null as empty, as one byte array with
    offsets (n + 1 of them)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges (i, j) of whole texts of at most ``size`` bytes together."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def byte_values() -> np.ndarray:
    """A random odd 64-bit number per byte value, the same everywhere."""
    draw = np.random.Generator(np.random.PCG64(HASH_SEED))
    return draw.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> "Powers":
        if len(self.up) < n:
            n = max(n, PIECE_BYTES + 1)
            for name, base in (("up", HASH_BASE), ("down", pow(HASH_BASE, -1, 1 << 64))):
                run = np.full(n, base, np.uint64)
                run[0] = 1
                setattr(self, name, np.multiply.accumulate(run))
        return self


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def lower(raw: np.ndarray) -> np.ndarray:
    """A-Z lowered."""
    return raw + (((raw >= 65) & (raw <= 90)).view(np.uint8) << 5)


def words_of(raw: np.ndarray, offsets: np.ndarray, values: np.ndarray, powers: Powers
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs of non-space bytes) of the texts, in order, where
    they start and end, and the index of the first word of every text (n + 1 of them).
    Words end with their text. A word beyond ``LONG_WORD`` bytes is hashed by BLAKE2b:
    polynomials modulo 2^64 have collisions that hold for every base, but only between
    words of several hundred letters."""
    n = len(raw)
    none = np.zeros(0, np.int64)
    if n == 0:
        return none.view(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begins, finishes = ~space, ~space
    begins[1:] &= space[:-1] | edge[1:n]
    finishes[:-1] &= space[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    if not len(starts):
        return none.view(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    powers.need(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values[raw] * powers.up[:n], out=total[1:])
    hashed = mix((total[ends] - total[starts]) * powers.down[starts])
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        word = raw[starts[i]:ends[i]].tobytes()
        hashed[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest())
    return hashed, starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray, values: np.ndarray, powers: Powers
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the index of the first word of every text (``words_of``)."""
    hashed, _, _, first = words_of(raw, offsets, values, powers)
    return hashed, first
