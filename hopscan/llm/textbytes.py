"""Words and hashes of whole texts as arrays over the UTF-8 bytes of Arrow columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240229)
#: A random number for each byte; A-Z share those of a-z, white space adds nothing.
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
FOLDED = _BYTE.copy()
FOLDED[65:91] = FOLDED[97:123]
FOLDED[SPACE] = 0
#: The same with A-Z apart.
EXACT = _BYTE.copy()
EXACT[SPACE] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_R1, _R2 = np.uint64(pow(int(_M1), -1, 1 << 64)), np.uint64(pow(int(_M2), -1, 1 << 64))
_S33 = np.uint64(33)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """Powers of the base, at least n of them."""
    global _powers
    if len(_powers) < n:
        size = 1 << (n - 1).bit_length()
        out = np.full(size, _BASE)
        out[0] = 1
        _powers = np.multiply.accumulate(out)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x ^ (x >> _S33)
    x *= _M1
    x ^= x >> _S33
    x *= _M2
    x ^= x >> _S33
    return x


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    x = x ^ (x >> _S33)
    x *= _R2
    x ^= x >> _S33
    x *= _R1
    x ^= x >> _S33
    return x


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null row is empty."""
    if column.null_count:
        column = column.fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    _, offsets, data = column.buffers()
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``limit`` bytes, never less than one whole row: first, end, bytes, offsets."""
    data, at = buffers(column)
    first, n = 0, len(at) - 1
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def word_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte position of each word; a row's first byte begins a word unless it is white space."""
    if not len(data):
        return np.zeros(0, np.int64)
    word = ~SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    rows = at[:-1][at[:-1] < at[1:]]
    begins[rows] |= word[rows]
    return np.flatnonzero(begins)


def word_hashes(data: np.ndarray, at: np.ndarray, letters: np.ndarray = FOLDED) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word, and the words' offsets by row. ``letters``: FOLDED lower-cases A-Z, EXACT does not."""
    starts = word_starts(data, at)
    rows = np.searchsorted(starts, at)
    if not len(starts):
        return np.zeros(0, np.uint64), rows
    n = len(data)
    place = np.arange(n, dtype=np.int64)
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, n)))
    place[: starts[0]] = 0
    value = powers(int(place.max()) + 1)[place]
    value *= letters[data]
    return mix(np.add.reduceat(value, starts)), rows


def pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as byte planes of their gaps, which compress well."""
    gaps = np.diff(keys, prepend=np.zeros(1, np.uint64))
    return np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return np.ascontiguousarray(counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack_counts(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


class Tally:
    """Distinct 64-bit keys with summed counts; memory follows the distinct keys."""

    def __init__(self, spill: int = 1 << 21) -> None:
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.spill = 0, spill

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> None:
        if counts is None:
            keys, counts = np.unique(keys, return_counts=True)
        self.pending.append((keys, counts.astype(np.uint64)))
        self.size += len(keys)
        if self.size > max(self.spill, len(self.keys)):
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.pending:
            keys = np.concatenate([self.keys, *(k for k, _ in self.pending)])
            counts = np.concatenate([self.counts, *(c for _, c in self.pending)])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, int)
            self.keys = keys[first]
            self.counts = np.add.reduceat(counts, first) if len(first) else counts
            self.pending, self.size = [], 0
        return self.keys, self.counts
