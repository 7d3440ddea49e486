"""Whole columns of text as flat byte arrays: words, hashes and sliding windows without a loop over rows.

An Arrow string column is one buffer plus offsets. Everything here works on that buffer, so the
cost per byte is that of a few numpy operations and the memory that of one piece of a batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text handled at once; a longer single text is a piece of its own.
PIECE_BYTES = 1 << 20

WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = False

_RNG = np.random.default_rng(20240229)
_BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASES = tuple(int(b) * 8 + 5 for b in _RNG.integers(2**40, 2**58, 4))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes: first row, end row, bytes, offsets."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), rows)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``table``, and the first word of each row.

    The third array has one entry more than there are rows. Words never cross rows.
    """
    inside = table[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    opens[edge] = inside[edge]
    closes[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(len(values)).bit_length())
    up, down = _powers(base, size)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums, down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    """One 64-bit hash per span of bytes, of its content and length alone."""
    sums, down = _sums(_BYTE_VALUES[data], base)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


# Strings of 1024 bytes exist whose polynomials modulo 2**64 agree whatever the base; a span from here on is hashed by other means.
LONG_SPAN = 512


def content_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``span_hashes``, with spans of ``LONG_SPAN`` bytes and more hashed by BLAKE2."""
    hashes = span_hashes(data, starts, ends)
    for i in np.flatnonzero(ends - starts >= LONG_SPAN):
        hashes[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8).digest(), "little")
    return hashes


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def window_hashes(values: np.ndarray, size: int, base: int = BASES[1]) -> np.ndarray:
    """Hash of ``values[i:i + size]`` for every i; windows over row ends are for the caller to skip."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    sums, down = _sums(values, base)
    return mix((sums[size:] - sums[:-size]) * down[: len(values) - size + 1])


def window_starts(bounds: np.ndarray, size: int) -> np.ndarray:
    """Positions where a window of ``size`` units lies within one row; ``bounds`` are the rows' first units."""
    lengths = np.maximum(np.diff(bounds) - size + 1, 0)
    return ranges(bounds[:-1], lengths)


def ranges(firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``firsts[j], firsts[j] + 1, ...`` of each length, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(np.asarray(firsts) - before, lengths)


# A hash without so many lower bits and a place in an array fit one sort key.
PLACE_BITS = 24
_PLACE = np.uint64((1 << PLACE_BITS) - 1)
# Windows compared at once, so that a step stays in the cache.
_BLOCK = 1 << 16


def sliding_argmin(values: np.ndarray, size: int) -> np.ndarray:
    """Position of the smallest of ``values[i:i + size]`` by the upper 40 bits, the leftmost of equals, for every i.

    ``size`` is below half of 2 ** ``PLACE_BITS``.
    """
    total = len(values) - size + 1
    out = np.zeros(max(0, total), np.int64)
    for first in range(0, total, _BLOCK):
        part = values[first : first + _BLOCK + size - 1]
        best, have = (part & ~_PLACE) | np.arange(len(part), dtype=np.uint64), 1
        while have < size:
            step = min(have, size - have)
            best = np.minimum(best[:-step], best[step:])
            have += step
        out[first : first + _BLOCK] = (best & _PLACE).astype(np.int64) + first
    return out


def distinct(hashes: np.ndarray, bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The distinct of some evenly spread values of so many bits, sorted, and the place of every value among them."""
    if len(hashes) >> PLACE_BITS or not len(hashes):
        return np.unique(hashes, return_inverse=True)
    both = (hashes << np.uint64(64 - bits) & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    both.sort()
    order = (both & _PLACE).astype(np.int64)
    values = hashes[order]
    if (values[1:] < values[:-1]).any():  # some values differ in their lower bits alone
        run = np.cumsum(np.diff(both >> np.uint64(PLACE_BITS), prepend=both[0] >> np.uint64(PLACE_BITS)) != 0)
        mixed = np.zeros(run[-1] + 1, bool)
        mixed[run[1:][values[1:] < values[:-1]]] = True
        some = np.flatnonzero(mixed[run])
        within = np.argsort(values[some], kind="stable")
        order[some], values[some] = order[some][within], values[some][within]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    place = np.empty(len(hashes), np.int64)
    place[order] = np.cumsum(new) - 1
    return values[new], place


def covered(starts: np.ndarray, size: int, total: int) -> np.ndarray:
    """Which of ``total`` units lie in a window of ``size`` units at one of ``starts``."""
    change = np.zeros(total + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + size, total), -1)
    return np.cumsum(change[:-1]) > 0


def group_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for every i, empty groups included."""
    sums = np.zeros(len(values) + 1, np.result_type(values.dtype, np.int64))
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]
