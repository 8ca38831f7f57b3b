"""Text columns of Arrow batches as flat numpy arrays, in bounded slices.

The operators that hash words or bytes work on a whole slice of documents at once: the UTF-8 bytes of the
texts laid end to end and the places where documents start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20

_MULT = np.uint64(0x9E3779B97F4A7C15)
#: The multiplier's inverse modulo 2**64.
_INV = np.uint64(pow(int(_MULT), -1, 1 << 64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null rows are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``max_bytes`` of text each, or of one row."""
    if not len(column):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first, done = 0, 0
    while first < len(column):
        last = max(int(np.searchsorted(ends, done + max_bytes, side="right")), first + 1)
        yield first, last
        first, done = last, int(ends[last - 1])


def mix(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit hashes spread."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out) if n else out


_CACHE: dict[str, np.ndarray] = {}


def _powers_of(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _CACHE.get(name)
    if have is None or len(have) < n:
        have = _CACHE[name] = _powers(max(n, 1 << 16), base)
    return have[:n]


class RangeHash:
    """64-bit hashes of any ranges of a sequence of 64-bit codes, equal for equal content wherever it lies."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * _powers_of("up", _MULT, n), out=self.sums[1:])
        self.down = _powers_of("down", _INV, n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * _MULT)


#: One 64-bit code per byte value.
BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _MULT) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray,
               separator: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte ranges of the words, and for each document (and the end) its first word."""
    solid = ~separator[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = solid[heads]
    starts = np.flatnonzero(begins)
    tails = np.empty(len(data), bool)
    if len(data):
        tails[:-1] = solid[:-1] & (~solid[1:] | begins[1:])
        tails[-1] = solid[-1]
    ends = np.flatnonzero(tails) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    return RangeHash(BYTE_CODES[LOWER[data] if lower else data])(starts, ends)
