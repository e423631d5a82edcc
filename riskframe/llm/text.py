"""Vectorised reading of Arrow text columns: bytes, words and hashes in numpy.

Everything here works on the UTF-8 bytes of whole texts. A batch is walked in chunks of
half a megabyte, so memory does not depend on the batch; a longer text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_U = np.uint64
WORD_LENGTH_FACTOR = _U(0x9E3779B97F4A7C15)
_FACTOR = _U(0xD6E8FEB86659FD93)
_FACTOR_INVERSE = _U(pow(int(_FACTOR), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


BYTE_CODE = mix((np.arange(256, dtype=np.uint64) + _U(1)) * WORD_LENGTH_FACTOR)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
        up[1:], down[1:] = _FACTOR, _FACTOR_INVERSE
        tables = [np.cumprod(up), np.cumprod(down)]
        if size > CHUNK_BYTES + 1:  # only for one very long text
            return tables[0], tables[1]
        _powers[:] = tables
    return _powers[0], _powers[1]


@dataclass
class Chunk:
    """Some whole texts. ``start`` holds len + 1 byte offsets into ``data``."""

    first: int
    data: np.ndarray
    start: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1


@dataclass
class Words:
    """The words of a chunk: byte ranges, the text each belongs to and a 64-bit hash."""

    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    per_text: np.ndarray


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Split a text column (null counts as empty) into chunks of whole texts."""
    data, at = _bytes_of(column)
    i, n = 0, len(at) - 1
    if not n:
        yield Chunk(0, data[:0], np.zeros(1, np.int64))
    while i < n:
        j = max(int(np.searchsorted(at, at[i] + size, side="right")) - 1, i + 1)
        yield Chunk(i, data[at[i] : at[j]], at[i : j + 1] - at[i])
        i = j


def range_hash(chunk: Chunk, begin: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of each byte range; equal bytes give equal hashes wherever they stand."""
    n = len(chunk.data)
    up, down = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_CODE[LOWER[chunk.data] if lower else chunk.data] * up[:n], out=total[1:])
    size = (end - begin).astype(np.uint64) * WORD_LENGTH_FACTOR
    return mix((total[end] - total[begin]) * down[begin] + size)


def sequence_hash(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each consecutive run of ``counts`` values; their order matters."""
    n = len(values)
    up, down = _power_tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=total[1:])
    end = np.cumsum(counts)
    begin = end - counts
    return mix((total[end] - total[begin]) * down[begin] + counts.astype(np.uint64) * WORD_LENGTH_FACTOR)


def words(chunk: Chunk, lower: bool = True) -> Words:
    """Words are runs of bytes other than space and 0x09-0x0D; ``lower`` folds A-Z for the hash."""
    data, n = chunk.data, len(chunk.data)
    space = SPACE[data]
    gap = np.ones(n + 1, bool)
    gap[1:] = False
    gap[1:n] = space[:-1]
    inner = chunk.start[:-1]
    gap[inner[inner < n]] = True  # a text's first byte starts a word whatever precedes it
    first = gap[:n] & ~space
    begin = np.flatnonzero(first)
    stop = np.ones(n + 1, bool)
    stop[:n] = space
    stop[inner[inner < n]] = True
    stops = np.flatnonzero(stop)
    end = stops[np.searchsorted(stops, begin, side="right")] if len(begin) else begin
    h = range_hash(chunk, begin, end, lower)
    text = np.searchsorted(chunk.start, begin, side="right") - 1
    return Words(begin, end, text, h, np.bincount(text, minlength=len(chunk)))


GRAM_CODE = (BYTE_CODE >> _U(32)).astype(np.uint32)
_GRAM_FACTOR = np.uint32(0x85EBCA6B)


def grams(data: np.ndarray, sizes: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the ascending ``sizes``: a 32-bit hash of the run of bytes at every position."""
    code = GRAM_CODE[data]
    h, n = code, 1
    for size in sizes:
        while n < size:
            if len(h) <= 1:
                return
            h = h[:-1] * _GRAM_FACTOR + code[n:]
            n += 1
        yield size, h ^ (h >> np.uint32(15))


def sum_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` rows; empty runs give 0."""
    out = np.zeros((len(counts), *values.shape[1:]), np.float64)
    full = counts > 0
    if full.any():
        at = np.concatenate([[0], np.cumsum(counts)[:-1]])[full]
        out[full] = np.add.reduceat(values, at, axis=0, dtype=np.float64)
    return out
