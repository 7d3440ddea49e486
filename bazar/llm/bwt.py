"""Burrows-Wheeler transforms of collections of byte strings, and their merge by interleave refinement.

Every string of a shard gets a terminator that sorts before all bytes. The transform of a shard lists, for its rotations in sorted
order, the symbol before each. The merge works on the transforms alone: no string is rebuilt and no suffix compared. It starts from an interleave that
lists the rows of one shard after the other, in one block, and walks it in order; each row hands its place to the row of the suffix ``STEP`` symbols longer in the same
transform, which goes to the bucket of the symbols passed. Rows of one shard never overtake each other in a bucket, as each transform is sorted already. After round t the
interleave is right for the first t * STEP symbols; neighbours are in one block if they agree in all of these, so a boundary that is new in round t stands between suffixes
whose common prefix has t * STEP - STEP symbols or more, but not t * STEP. A suffix alone in its block is settled, as are all that would follow from it, and leaves the walk.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from bazar.llm.text import ranges

STEP = 5
# Symbols sorted at once, in at most so many shards: their number and _FIRST symbols of nine bits fit one sort key.
BATCH, MOST_SHARDS, _FIRST = 1 << 18, 512, 6
# Symbols of eight times STEP bits and a place of so many fit one sort key.
PLACE_BITS = 24


@dataclass
class Shard:
    """``symbols`` is the transform, with 0 also where a terminator stands; ``ends`` are those places. ``strings`` numbers the
    input strings in sorted order, the order in which an inversion finds them."""

    symbols: np.ndarray
    ends: np.ndarray
    strings: np.ndarray


def transforms(data: np.ndarray, lengths: np.ndarray, shard: np.ndarray) -> list[Shard]:
    """Transforms of the strings that ``data`` holds one after the other, by prefix doubling over the rotations.

    ``shard`` is the shard of each string, ascending from 0 without gaps. As many shards as make about ``BATCH`` symbols are sorted at once.
    """
    out: list[Shard] = []
    sizes = lengths + 1
    per_shard = np.bincount(shard, weights=sizes).astype(np.int64) if len(shard) else np.zeros(0, np.int64)
    strings = np.searchsorted(shard, np.arange(len(per_shard) + 1))
    from_byte = np.concatenate([[0], np.cumsum(lengths)])
    lo = 0
    while lo < len(per_shard):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(per_shard[lo : lo + MOST_SHARDS]), BATCH)))
        a, b = strings[lo], strings[min(hi, len(per_shard))]
        out += _transforms(data[from_byte[a] : from_byte[b]], lengths[a:b], shard[a:b] - lo)
        lo = hi
    return out


def _transforms(data: np.ndarray, lengths: np.ndarray, shard: np.ndarray) -> list[Shard]:
    sizes = lengths + 1
    firsts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    symbols = np.zeros(n, np.uint16)
    symbols[ranges(firsts, lengths)] = data.astype(np.uint16) + 1
    owner = np.repeat(np.arange(len(lengths)), sizes)
    size_at, first_at = sizes[owner], firsts[owner]
    following = np.arange(1, n + 1)
    following[firsts + lengths] = firsts
    # shards stay apart as they differ in the highest bits
    key, at = shard[owner].astype(np.uint64), np.arange(n)
    for _ in range(_FIRST):
        key = (key << np.uint64(9)) | symbols[at]
        at = following[at]
    order = np.argsort(key)
    new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    have, longest = _FIRST, int(sizes.max())
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while have < longest:
        single = new & np.append(new[1:], True)
        open_places = np.flatnonzero(~single)
        if not len(open_places):
            break
        some = order[open_places]
        ahead = rank[first_at[some] + (some - first_at[some] + have) % size_at[some]]
        key = rank[some].astype(np.uint64) << np.uint64(32) | ahead.astype(np.uint64)
        within = np.argsort(key)
        order[open_places] = some[within]
        key = key[within]
        new[open_places] = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[open_places]] = open_places[np.maximum.accumulate(np.where(new[open_places], np.arange(len(open_places)), 0))]
        have *= 2
    before = np.where(order == first_at[order], first_at[order] + size_at[order] - 1, order - 1)
    out = symbols[before]
    found: list[Shard] = []
    begin = 0
    counts = np.bincount(shard)
    first_string = 0
    for strings, total in zip(counts, np.bincount(shard, weights=sizes).astype(np.int64)):
        own = out[begin : begin + total]
        # rotations that begin with a terminator come first, one per string
        found.append(Shard((own - (own > 0)).astype(np.uint8), np.flatnonzero(own == 0), owner[order[begin : begin + strings]] - first_string))
        begin += total
        first_string += strings
    return found


@dataclass
class Texts:
    """Rows of several transforms, shard after shard, and the strings they stand for, each with a terminator, one after the other."""

    symbols: np.ndarray  # before the suffix of each row, one more than the byte; 0 for a terminator
    back: np.ndarray  # the row of the suffix one symbol longer
    firsts: np.ndarray
    lengths: np.ndarray
    suffixes: np.ndarray  # where the suffix of each row begins

    @property
    def data(self) -> np.ndarray:
        """The strings themselves, which the merge does without."""
        out = np.zeros(len(self.symbols), np.uint8)
        real = self.symbols != 0
        out[self.suffixes[real] - 1] = self.symbols[real] - 1
        return out


def invert(shards: list[Shard]) -> Texts:
    """The rows of all shards; their strings are in sorted order within each."""
    sizes = np.array([len(s.symbols) for s in shards], np.int64)
    bases = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    number = np.int32 if total < 1 << 31 else np.int64
    symbols = np.zeros(total, np.uint16)
    if total:
        symbols += np.concatenate([s.symbols for s in shards])
        symbols += 1
        symbols[np.concatenate([s.ends.astype(np.int64) + base for s, base in zip(shards, bases)])] = 0
    # stable by symbol within each shard
    order = np.argsort(symbols, kind="stable")
    order = order[_in_buckets(np.repeat(np.arange(len(shards)), sizes)[order])]
    back = np.empty(total, number)
    back[order] = np.arange(total, dtype=number)
    starts = [base + np.arange(len(s.ends)) for s, base in zip(shards, bases)]
    at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    # from every terminator backwards to the start of its string, all strings at once
    count = len(at)
    lengths = np.zeros(count, np.int64)
    alive, place = np.arange(count), at
    walked = [(alive, place)]
    while len(alive):
        going = symbols[place] != 0
        alive, place = alive[going], back[place[going]]
        lengths[alive] += 1
        if len(alive):
            walked.append((alive, place))
    sizes = lengths + 1
    firsts = np.cumsum(sizes) - sizes
    where = np.empty(total, np.int64)
    for step, (alive, place) in enumerate(walked):
        where[place] = firsts[alive] + lengths[alive] - step
    return Texts(symbols, back, firsts, lengths, where)


def _in_buckets(codes: np.ndarray) -> np.ndarray:
    """Stable order by code, one counting pass per 16 bits."""
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    high = codes >> 16
    if len(codes) and high.max():
        order = order[np.argsort(high[order].astype(np.uint16), kind="stable")]
    return order


def _stable(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of symbols of ``8 * STEP`` bits, and the symbols in it: one sort of symbol and place together."""
    if len(symbols) >> PLACE_BITS:
        order = np.argsort(symbols, kind="stable")
        return order, symbols[order]
    both = symbols << np.uint64(PLACE_BITS) | np.arange(len(symbols), dtype=np.uint64)
    both.sort()
    return (both & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int32), both >> np.uint64(PLACE_BITS)


def repeated_intervals(texts: Texts, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first ``depth`` bytes with another, and the bounds of the intervals of equal ones among them."""
    if not len(texts.symbols):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    # from every row one symbol back: the row, the symbol passed, and whether it is one of the string
    one = texts.back, np.maximum(texts.symbols, 1).astype(np.uint64) - np.uint64(1), texts.symbols != 0
    two = _joined(one, one, 8)
    five = _joined(_joined(two, two, 16), one, 32)
    order, block = np.arange(len(texts.symbols), dtype=texts.back.dtype), np.zeros(len(texts.symbols), np.int32)
    for back, passed, inside in [one] * (depth % STEP) + [five] * (depth // STEP):
        order, block = order[inside[order]], block[inside[order]]
        place, symbols = _stable(passed[order])
        order, block = back[order[place]], block[place]
        new = np.ones(len(order) + 1, bool)
        new[1:-1] = (symbols[1:] != symbols[:-1]) | (block[1:] != block[:-1])
        kept = ~(new[:-1] & new[1:])
        order, block = order[kept], np.cumsum(new[:-1][kept], dtype=np.int32)
    begin = np.flatnonzero(np.diff(block, prepend=-1))
    return texts.suffixes[order], np.append(begin, len(order))


def _joined(first: tuple[np.ndarray, ...], then: tuple[np.ndarray, ...], bits: int) -> tuple[np.ndarray, ...]:
    """Two walks as one; the symbols of the second come before those of the first, which have so many bits."""
    (at, passed, inside), (further, more, still) = first, then
    return further[at], passed | more[at] << np.uint64(bits), inside & still[at]
