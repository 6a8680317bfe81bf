"""Flat numpy views of Arrow text batches: words, their hashes, and hashes of word runs.

A chunk holds the UTF-8 bytes of some rows side by side, with row offsets; no function here loops
over words or characters. Chunks are cut by bytes, so memory does not depend on rows per batch;
only a text longer than the bound has a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BYTE = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64)

WHITE_SPACE = np.ones(256, dtype=bool)
WHITE_SPACE[[0x20, *range(0x09, 0x0E)]] = False

ALPHANUMERIC = np.ones(256, dtype=bool)
ALPHANUMERIC[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


class Chunk:
    """Rows ``first`` to ``first + len(offsets) - 2`` of a batch, as bytes; a null text is empty."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of an Arrow string column in chunks of about ``limit`` bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), n)
        yield Chunk(start, data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start])
        start = stop


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def inverse(odd: int) -> int:
    return pow(int(odd), -1, 1 << 64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base, n: int) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2 ** 64; tables up to a few MB are kept."""
    base = _U(base)
    known = _POWERS.get(int(base))
    if known is not None and len(known) >= n:
        return known[:n]
    steps = np.full(max(n, 1), base, dtype=np.uint64)
    steps[0] = 1
    table = np.multiply.accumulate(steps)
    if n <= 1 << 21:
        _POWERS[int(base)] = table
    return table[:n]


class Words:
    """The words of a chunk: byte spans, their row, and how many each row has."""

    def __init__(self, start: np.ndarray, end: np.ndarray, row_first: np.ndarray):
        self.start, self.end, self.row_first = start, end, row_first

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.row_first)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row_first) - 1), self.counts)

    def __len__(self) -> int:
        return len(self.start)


def words(chunk: Chunk, inside: np.ndarray) -> Words:
    """Maximal runs of bytes for which ``inside`` is true, never across rows."""
    edge = np.zeros(len(chunk.data) + 1, dtype=bool)
    edge[chunk.offsets] = True
    member = inside[chunk.data]
    before = np.empty_like(member)
    before[:1] = False
    before[1:] = member[:-1]
    begins = member & (~before | edge[:-1])
    after = np.empty_like(member)
    after[-1:] = False
    after[:-1] = member[1:]
    ends = member & (~after | edge[1:])
    start = np.flatnonzero(begins)
    return Words(start, np.flatnonzero(ends) + 1, np.searchsorted(start, chunk.offsets))


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, from one prefix sum over the bytes."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=total[1:])
    back = powers(inverse(_BASE), len(data) + 1)
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))


def runs(word_hashes: np.ndarray, length: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """The hash of each run of ``length`` consecutive values; run ``i`` starts at value ``i``."""
    n = len(word_hashes)
    if n < length:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(word_hashes * powers(base, n), out=total[1:])
    return mix((total[length:] - total[:-length]) * powers(inverse(base), n - length + 1))


def starts_within(row_first: np.ndarray, length: int) -> np.ndarray:
    """The word indexes at which a run of ``length`` words stays inside its row."""
    n = int(row_first[-1])
    if n < length:
        return np.zeros(0, dtype=np.int64)
    room = np.repeat(row_first[1:], np.diff(row_first)) - np.arange(n)
    return np.flatnonzero(room >= length)


def window_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` consecutive values, in doubling steps."""
    result, have = values, 1
    while have < width:
        step = min(have, width - have)
        result = np.minimum(result[:-step], result[step:])
        have += step
    return result


def shingles(word_hashes: np.ndarray, row_first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size``-word runs of each row, sorted, with their row bounds.

    A row with fewer words, but not none, has one shingle: all its words.
    """
    counts = np.diff(row_first)
    at = starts_within(row_first, size)
    rows = np.repeat(np.arange(len(counts)), counts)
    value, row = runs(word_hashes, size)[at], rows[at]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = [runs(word_hashes[row_first[r] : row_first[r + 1]], counts[r])[0] for r in short]
        value, row = np.concatenate([value, np.array(whole, dtype=np.uint64)]), np.concatenate([row, short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[fresh], row[fresh]
    return value, np.searchsorted(row, np.arange(len(counts) + 1))
