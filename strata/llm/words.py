"""Words of Arrow text columns as numpy arrays: positions and 64-bit codes.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D), which is the same as
``[^\\x20\\x09-\\x0D]+`` on code points. Words never cross documents. Codes are a polynomial
hash of the word's UTF-8 bytes, found for all words of a batch by one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is handled alone.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Bytes with A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    got = _powers.get(str(base))
    if got is None or len(got) < n:
        got = np.full(max(n, CHUNK * 2), base, dtype=np.uint64)
        got[0] = 1
        got = np.cumprod(got, dtype=np.uint64)
        _powers[str(base)] = got
    return got[:n]


@dataclass
class Chunk:
    """Rows ``first`` to ``last`` of a batch. ``offsets``: bytes of each document in ``data``."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row]:self.offsets[row + 1]].tobytes()


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[Chunk]:
    """Slices of whole documents with about ``limit`` bytes; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
        yield Chunk(first, last, data[ends[first]:ends[last]], ends[first:last + 1] - ends[first])
        first = last


@dataclass
class Words:
    """``starts``/``ends``: bytes of each word; ``bounds[d]`` to ``bounds[d + 1]``: the words of document d."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    codes: np.ndarray

    @property
    def docs(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def words(chunk: Chunk, lower: bool = False, codes: bool = True) -> Words:
    """Find the words of a chunk; ``lower`` takes A-Z as a-z in the codes."""
    data, n = chunk.data, len(chunk.data)
    inside = ~SPACE[data]
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[chunk.offsets] = True  # a document begins (or the data end)
    before = np.empty(n, dtype=bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | fresh[:-1]))
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | fresh[1:])) + 1
    bounds = np.searchsorted(starts, chunk.offsets)
    if not codes:
        return Words(starts, ends, bounds, np.empty(0, np.uint64))
    return Words(starts, ends, bounds, span_codes(LOWER[data] if lower else data, starts, ends))


def span_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit codes of the bytes of each span."""
    return run_codes(_BYTES[data], starts, ends)


def run_codes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit codes of runs of 64-bit values."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * _power(_BASE, n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _power(_INVERSE, n + 1)[starts])


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Codes of the ``n`` words from each word on (fewer rows than words by n - 1)."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(_BASE) + codes[j:j + m]
    return mix(out)


def whole(bounds: np.ndarray, n: int) -> np.ndarray:
    """For each word but the last n - 1: whether the n words from it on lie in one document."""
    total = int(bounds[-1])
    left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(total)
    return (left >= n)[:max(0, total - n + 1)]
