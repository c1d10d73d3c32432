"""Vectorised text helpers that run inside tasks, on chunks of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C13  # 3 modulo 4: powers differ in their low bits
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20_240_601).integers(0, 1 << 64, 256, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit numbers that depend on the seed alone."""
    return np.random.default_rng(seed).integers(0, 1 << 64, n, dtype=np.uint64) | np.uint64(1)


@cache
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int, base: int) -> np.ndarray:
    """base ** i for i < n, modulo 2 ** 64; kept by sizes that double."""
    return _powers(max(1 << 12, 1 << max(0, n - 1).bit_length()), base)[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and n + 1 offsets; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about so many bytes: first row, end row, bytes, offsets."""
    data, at = raw(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and n + 1 bounds: words of row i are bounds[i]:bounds[i + 1]."""
    inside = ~_GAP[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    heads = at[:-1][at[1:] > at[:-1]]
    tails = at[1:][at[1:] > at[:-1]] - 1
    first[heads], last[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """From these, span_hashes gives the hash of any span."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data), _BASE), out=total[1:])
    return total


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span of bytes; it depends on the bytes alone."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), _INVERSE)[starts])


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """The same, with A-Z lower-cased first."""
    return span_hashes(prefix_sums(_LOWER[data] if lower else data), starts, ends)


def shingles(hashed: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of all runs of so many words; all words if there are fewer."""
    if not len(hashed):
        return hashed
    multipliers = constants(size, size)
    width = min(size, len(hashed))
    n = len(hashed) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out += hashed[k : k + n] * multipliers[k]
    return np.unique(mix(out))
