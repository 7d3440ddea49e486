"""Removal of byte strings that a smaller document has too, by merging Burrows-Wheeler transforms.

1. Every ``length``-byte string has an anchor, its half-length shingle of the smallest hash. A count-min sketch over the anchors of all
   chunks tells which may occur twice. Consecutive strings with one such anchor form a segment; the rest of the text takes no further part.
2. Equal segments are counted once: the slice of their anchor tells each chunk which of its segments some smaller document of another chunk has whole,
   and whether the anchor has different segments. Where all are equal the first document keeps its own whole and there is nothing to merge.
   The chunk notes its segments, so later steps need no hashes.
3. The first owner of each other segment sends it to the slice of its anchor, as part of a shard: the transform of all segments a chunk has for that
   slice. The slice merges the transforms and finds the intervals of suffixes that agree in ``length`` bytes. In an interval the
   smallest document keeps its string and all others lose theirs. Equal strings have equal anchors, so all copies of a string meet in one slice.
4. Each chunk cuts out what its documents lost.

An anchor that occurs very often, as in a line half of all documents have, would bring a slice as many different segments as it has
neighbourhoods. The strings of such anchors are segments of their own: step 2 decides them, spread by their own hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from bazar.llm import bwt, exchange
from bazar.llm.tables import stored
from bazar.llm.text import BASES, byte_values, covered, flat, group_sums, mix, pieces, ranges, sliding_argmin, span_hashes, window_hashes, window_starts

LENGTH = 50
# From so many occurrences on the strings of an anchor are decided one by one.
HOT_ANCHOR = 2000
# Bytes of text whose byte hashes are held at once.
PIECE = 1 << 18
CHUNK_BYTES = 4 << 20
SLICES_PER_CHUNK = 2
SEGMENT_TAG, STRING_TAG, NOTE_TAG = 8, 9, 10
# Bits of an anchor's hash that are sent; anchors that agree in them are merged together, which changes no result.
ROUTE_BITS = 48


@dataclass
class Bytes:
    """A chunk as bytes, in document order."""

    docs: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, chunk: pa.Table) -> Bytes:
        return cls(exchange.doc_numbers(chunk), *flat(chunk["text"]))

    def runs(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Runs of strings that share an anchor: hash of the anchor, first string, number of strings."""
        size = length // 2
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for first, _, part, bounds in pieces(self.data, self.offsets, PIECE):
            starts = window_starts(bounds, length)
            if len(starts):
                shingles = window_hashes(byte_values(part), size)
                place = sliding_argmin(shingles, length - size + 1)[starts]
                run = np.flatnonzero(np.diff(place, prepend=-1))
                found.append((shingles[place[run]], starts[run] + self.offsets[first], np.diff(run, append=len(place))))
        keys, starts, counts = (np.concatenate(c) for c in zip(*found))
        return keys, starts, counts

    def owners(self, starts: np.ndarray) -> np.ndarray:
        return self.docs[np.searchsorted(self.offsets, starts, side="right") - 1]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of spans in ascending order of their starts."""
        one, other = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for first, end, part, _ in pieces(self.data, self.offsets, PIECE):
            base = self.offsets[first]
            a, b = np.searchsorted(starts, [base, self.offsets[end]])
            if b > a:
                one[a:b] = span_hashes(part, starts[a:b] - base, ends[a:b] - base)
                other[a:b] = span_hashes(part, starts[a:b] - base, ends[a:b] - base, BASES[3])
        return one, other


def _changes(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where any of some arrays differs from the entry before."""
    new = np.ones(len(sorted_keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in sorted_keys])
    return new


def _planes(values: np.ndarray) -> np.ndarray:
    """The lowest bytes of all values, then the next: bytes that are the same throughout take no room once compressed."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.ravel()


def _from_planes(planes: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


@dataclass
class Segments:
    """Segments of a chunk that may hold something repeated. The distinct ones among them are sorted by route, so those of each slice are together."""

    starts: np.ndarray
    counts: np.ndarray
    order: np.ndarray  # equal ones one after the other
    new: np.ndarray  # where in this order another one begins

    def __post_init__(self):
        self.first = self.order[self.new]  # first places of the distinct ones
        self.kind = np.empty(len(self.order), np.int64)  # for every segment its distinct one
        self.kind[self.order] = np.cumsum(self.new) - 1

    @classmethod
    def of(cls, text: Bytes, sketch: exchange.Sketch, length: int, answers: dict[int, list[bytes]]) -> tuple[Segments, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The segments, and of the distinct ones the route, a hash of the anchor or for strings of very frequent anchors of the string, and 96 bits of hash."""
        keys, starts, counts = text.runs(length)
        repeated, hot = sketch.repeated(answers, keys), sketch.hot(answers, keys)
        normal, split = repeated & ~hot, repeated & hot
        singles = ranges(starts[split], counts[split])
        # anchors have small hashes, as the smallest of many: mixed again they are even
        routes = np.concatenate([mix(keys[normal]), np.zeros(len(singles), np.uint64)])
        alone = np.arange(len(routes)) >= len(routes) - len(singles)
        starts = np.concatenate([starts[normal], singles])
        counts = np.concatenate([counts[normal], np.ones(len(singles), np.int64)])
        if len(singles):
            order = np.argsort(starts, kind="stable")
            routes, alone, starts, counts = routes[order], alone[order], starts[order], counts[order]
        high, low = text.hashes(starts, starts + counts + length - 1)
        routes = np.where(alone, low, routes) >> np.uint64(64 - ROUTE_BITS) << np.uint64(64 - ROUTE_BITS)
        low = (low >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((low, high, routes))
        own = cls(starts, counts, order, _changes(routes[order], high[order], low[order]))
        return own, (routes[own.first], high[own.first], low[own.first])

    def note(self) -> bytes:
        numbers = np.diff(self.starts, prepend=0), self.counts, self.order
        return exchange.pack(*(_planes(a.astype(np.uint32)) for a in numbers), np.packbits(self.new))

    @classmethod
    def noted(cls, heard: list[exchange.Message]) -> Segments:
        """The segments as the chunk found them; a chunk without rows has no note."""
        for _, _, tag, payload in heard:
            if tag == NOTE_TAG:
                *numbers, new = exchange.unpack(payload, *[np.uint8] * 4)
                steps, counts, order = (_from_planes(a, np.uint32).astype(np.int64) for a in numbers)
                return cls(np.cumsum(steps), counts, order, np.unpackbits(new, count=len(order)).astype(bool))
        return cls(*[np.zeros(0, np.int64)] * 3, np.zeros(0, bool))

    def sent(self, heard: list[exchange.Message], slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which distinct segments a smaller document has; the segments to merge, those of each slice together, and where the slices begin."""
        told = [(s, payload) for s, _, tag, payload in heard if tag == SEGMENT_TAG]
        later, mixed = exchange.bits_of([payload for _, payload in told], 2 * len(self.first)).reshape(-1, 2).T
        mine = mixed & ~later
        # each slice answers as many as it was asked
        of = np.repeat(np.array([s for s, _ in told], np.int64), [int(exchange.unpack(payload, np.int64)[0][0]) // 2 for _, payload in told])
        return later, self.first[mine], np.searchsorted(of[mine], np.arange(slices + 1))


def suffix_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts in a row with a smaller ``key``.

    Texts are UTF-8 bytes; strings never cross documents, overlaps count, and strings are judged on the input. Adds
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) as long and ``kept_bytes`` (binary, the rest) to every row; columns called like them are
    replaced. NULL and empty texts have no bytes. A NULL key is smaller than all others. Rows that repeat a key are the same document as far as the rule goes, so
    they take nothing from each other. An empty table stays empty.
    """
    added = StructType([StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_bytes", BinaryType())])
    kept = [c for c in docs.columns if c not in added.names]
    chunks = exchange.chunked(docs, key, text, carry=kept, chunk_bytes=CHUNK_BYTES)
    # a merge needs some hundred bytes of memory per byte of its shards
    plain, slices = chunks.rows.drop("row"), chunks.count * SLICES_PER_CHUNK
    sketch = exchange.Sketch.for_keys(chunks.size // (length // 4) + 1, slices, often=HOT_ANCHOR)

    def count(chunk: int, table: pa.Table):
        return sketch.ask(chunk, Bytes.of(exchange.in_order(table)).runs(length)[0])

    estimates = stored(exchange.answer(exchange.ask(plain, count), sketch.reply))

    def segments(chunk: int, table: pa.Table, heard: list[exchange.Message]) -> pa.Table:
        if chunk < 0:
            return exchange.messages([])
        data = Bytes.of(exchange.in_order(table))
        own, (routes, high, low) = Segments.of(data, sketch, length, exchange.by_tag(heard))
        docs_of = data.owners(own.starts[own.first])
        cuts = exchange.slice_cuts(routes, slices)
        asked = [(s, chunk, SEGMENT_TAG, exchange.pack(_planes(routes[a:b]), high[a:b], low[a:b], _planes(docs_of[a:b]))) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        # no slice has this number, so the note comes back as it is
        return exchange.messages([*asked, (slices + chunk, chunk, NOTE_TAG, own.note())])

    def first_owner(asked: list[exchange.Message]):
        if asked[0][2] == NOTE_TAG:
            yield from asked
            return
        parts = [exchange.unpack(payload, np.uint8, np.uint64, np.uint32, np.uint8) for _, _, _, payload in asked]
        parts = [(_from_planes(route, np.uint64), high, low, _from_planes(owner, np.int64)) for route, high, low, owner in parts]
        route, high, low, owner = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((owner, low, high, route))
        # of every segment whether a smaller document has it, and whether its anchor has others
        told = np.zeros((len(order), 2), bool)
        new, anchor = _changes(route[order], high[order], low[order]), _changes(route[order])
        # rows of one document may be in several chunks, and take nothing from each other
        told[order, 0] = owner[order] > owner[order[new]][np.cumsum(new) - 1]
        of = np.cumsum(anchor) - 1
        told[order, 1] = (np.bincount(of[new]) > 1)[of]
        at = 0
        for (s, chunk, tag, _), part in zip(asked, parts):
            yield s, chunk, tag, exchange.bit_payload(told[at : at + len(part[0])].ravel())
            at += len(part[0])

    owners = stored(exchange.answer(exchange.hear(plain, estimates, segments, exchange.MESSAGE), first_owner))

    def shards(chunk: int, table: pa.Table, heard: list[exchange.Message]) -> pa.Table:
        if chunk < 0:
            return exchange.messages([])
        data, own = Bytes.of(exchange.in_order(table)), Segments.noted(heard)
        _, mine, cuts = own.sent(heard, slices)
        sizes = own.counts[mine] + length - 1
        used = np.flatnonzero(np.diff(cuts))
        shard = np.repeat(np.arange(len(used)), np.diff(cuts)[used])
        made = bwt.transforms(data.data[ranges(own.starts[mine], sizes)], sizes, shard)
        owner = data.owners(own.starts[mine])
        return exchange.messages(
            (int(s), chunk, STRING_TAG, exchange.pack(x.symbols, x.ends.astype(np.uint32), x.strings.astype(np.uint32), owner[cuts[s] : cuts[s + 1]])) for s, x in zip(used, made)
        )

    def merge(asked: list[exchange.Message]):
        parts = [exchange.unpack(payload, np.uint8, np.uint32, np.uint32, np.int64) for _, _, _, payload in asked]
        texts = bwt.invert([bwt.Shard(symbols, ends, strings) for symbols, ends, strings, _ in parts])
        # the strings of a shard are in sorted order
        doc = np.repeat(np.concatenate([docs_of[strings] for _, _, strings, docs_of in parts]), texts.lengths + 1)
        order, bounds = bwt.repeated_intervals(texts, length)
        lost = np.zeros(len(texts.suffixes), bool)
        if len(order):
            least = np.minimum.reduceat(doc[order], bounds[:-1])
            lost[order] = doc[order] > np.repeat(least, np.diff(bounds))
        at = 0
        for (s, chunk, tag, _), (_, _, strings, _) in zip(asked, parts):
            mine = np.arange(at, at + len(strings))[np.argsort(strings)]
            at += len(strings)
            yield s, chunk, tag, exchange.bit_payload(lost[ranges(texts.firsts[mine], texts.lengths[mine] - length + 1)])

    losses = stored(exchange.answer(exchange.hear(plain, owners, shards, exchange.MESSAGE), merge))
    schema = StructType([chunks.rows.schema["row"], *added])

    def cut(chunk: int, table: pa.Table, heard: list[exchange.Message]) -> pa.Table:
        table = exchange.in_order(table) if table.num_rows else table
        data, own = Bytes.of(table), Segments.noted(heard)
        later, mine, _ = own.sent(heard, slices)
        sizes = own.counts[mine]
        bits = exchange.bits_of([payload for _, _, tag, payload in heard if tag == STRING_TAG], int(sizes.sum()))
        # whole segments a smaller document has, in another chunk or in this one
        docs_of = data.owners(own.starts)
        whole = later[own.kind] | (docs_of > docs_of[own.first][own.kind])
        lost = [ranges(own.starts[whole], own.counts[whole])]
        # and single strings of the others; a segment that its document repeats loses the same strings again
        at = np.full(len(own.first), -1)
        at[own.kind[mine]] = np.cumsum(sizes) - sizes
        rest = np.flatnonzero(~whole & (at[own.kind] >= 0))
        entry = ranges(at[own.kind[rest]], own.counts[rest])
        lost.append(ranges(own.starts[rest], own.counts[rest])[bits[entry]])
        removed = covered(np.concatenate(lost), length, len(data.data))
        opens = removed.copy()
        opens[1:] &= ~removed[:-1]
        inner = data.offsets[1:-1]
        inner = inner[inner < len(removed)]
        opens[inner] = removed[inner]
        gone = group_sums(removed, data.offsets)
        rest_bytes = data.data[~removed].tobytes()
        edges = np.concatenate([[0], np.cumsum(np.diff(data.offsets) - gone)])
        made = [
            pa.array(np.diff(data.offsets), pa.int64()),
            pa.array(gone, pa.int64()),
            pa.array(group_sums(opens, data.offsets), pa.int64()),
            pa.array([rest_bytes[a:b] for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
        ]
        return pa.table([table["row"], *made], names=["row", *added.names])

    done = exchange.hear(chunks.rows, owners.unionByName(losses), cut, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], *added.names)


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, chars: str | None = "n_chars") -> DataFrame:
    """The rows with the text that ``suffix_dedup`` leaves, all other columns unchanged.

    What a cut leaves of a split character goes too. ``chars``, if there is such a column, gets the new number of characters. Rows that lose something and
    have no word left are dropped; those that had none to begin with stay.
    """
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    done = suffix_dedup(row, "key", "text", length).select("row", "n_removed", "kept_bytes")
    schema = StructType([done.schema["row"], StructField("changed", BooleanType()), StructField("rest", StringType())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            changed = [n > 0 for n in batch.column(1).to_pylist()]
            rest = [b.decode("utf-8", "ignore") if c else None for b, c in zip(batch.column(2).to_pylist(), changed)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(changed), pa.array(rest, pa.string())], names=schema.names)

    cut = done.mapInArrow(decode, schema).filter(~F.col("changed") | F.col("rest").rlike(r"[^\x20\x09-\x0D]"))
    new = {text: F.col("rest")} | ({chars: F.length("rest").cast(docs.schema[chars].dataType)} if chars in docs.columns else {})
    return cut.select(*[F.when(F.col("changed"), new[c]).otherwise(F.col("row").getField(c)).alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns])
