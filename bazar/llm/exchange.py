"""Chunks of documents that ask slices of a key space what the whole corpus knows about their keys.

A chunk is a bounded group of documents, a slice a range of 64-bit keys. A chunk sends each slice one message with
its distinct keys there, sorted, so a key held by a third of all rows still costs a chunk one entry. A slice answers every message
in the order of its entries, and the chunk, which finds the same keys again when it is read a second time, needs no more than
the answers. Both numbers grow with the input, so neither side outgrows a task.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bazar.llm.tables import stored
from bazar.llm.text import distinct, mix

CHUNK_BYTES = 8 << 20
LEAST_CHUNK_BYTES = 1 << 20
# What a row counts for besides its text.
ROW_BYTES = 64

MESSAGE = "slice int, chunk int, tag int, payload binary"
MESSAGE_TYPES = [("slice", pa.int32()), ("chunk", pa.int32()), ("tag", pa.int32()), ("payload", pa.binary())]

Message = tuple[int, int, int, bytes]


@dataclass(frozen=True)
class Chunks:
    """``rows`` has the columns chunk, doc (bigint), order (a hash of the text), text, and row, the struct of what is carried along."""

    rows: DataFrame
    count: int
    size: int


def chunked(docs: DataFrame, key: str, text: str, carry: Sequence[str] = (), chunk_bytes: int = CHUNK_BYTES) -> Chunks:
    """Deal documents out by a hash of their key and text into chunks of about ``chunk_bytes`` of text.

    Smaller ones, of ``LEAST_CHUNK_BYTES``, are made as long as there are fewer of them than shuffle partitions.
    Rows equal in key and text that would fill half a chunk are spread over all chunks; as nothing in them tells them apart, where each went is stored.
    """
    size, n = docs.agg(F.sum(F.octet_length(text)), F.count(F.lit(1))).first()
    size = size or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(1, math.ceil(size / chunk_bytes), min(partitions, math.ceil(size / LEAST_CHUNK_BYTES)))
    same = F.xxhash64(F.col(key).cast("bigint"), F.col(text))
    weight = F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES)
    equal = docs.groupBy(same.alias("same")).agg(weight.alias("weight"), F.count(F.lit(1)).alias("n"))
    # at most two for each chunk
    many = [r.same for r in equal.filter((F.col("n") > 1) & (F.col("weight") > (size + ROW_BYTES * n) / (2 * count))).select("same").collect()] if count > 1 else []
    rows = docs.select(
        F.pmod(same, F.lit(count)).cast("int").alias("chunk"),
        F.col(key).cast("bigint").alias("doc"),
        F.hash(F.col(text)).alias("order"),
        F.col(text).alias("text"),
        *([F.struct(*carry).alias("row")] if carry else []),
    )
    if many:
        own = F.xxhash64("doc", "text").isin(many)
        spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)).cast("int")
        rows = rows.filter(~own).unionByName(stored(rows.filter(own).withColumn("chunk", spread)))
    return Chunks(rows, count, size)


def in_order(chunk: pa.Table) -> pa.Table:
    """Rows by doc, NULL first; those that repeat a doc by a hash of their text, which is the same order in all chunks."""
    return chunk.take(pc.sort_indices(chunk, [("doc", "ascending"), ("order", "ascending"), ("text", "ascending")], null_placement="at_start"))


def doc_numbers(chunk: pa.Table) -> np.ndarray:
    """Docs as int64 for comparisons; NULL is the smallest."""
    return pc.fill_null(chunk["doc"].combine_chunks(), np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join(part for a in arrays for part in (len(a).to_bytes(8, "little"), np.ascontiguousarray(a).tobytes()))


def unpack(payload: bytes, *types) -> list[np.ndarray]:
    out, at = [], 0
    for t in types:
        n = int.from_bytes(payload[at : at + 8], "little")
        at += 8
        out.append(np.frombuffer(payload, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def slice_cuts(sorted_keys: np.ndarray, slices: int) -> np.ndarray:
    """Where the keys of each slice begin; slice s holds the s-th of ``slices`` equal ranges of keys."""
    edges = ((np.arange(1, slices, dtype=np.uint64) << np.uint64(32)) + np.uint64(slices - 1)) // np.uint64(slices) << np.uint64(32)
    return np.concatenate([[0], np.searchsorted(sorted_keys, edges), [len(sorted_keys)]]).astype(np.int64)


def messages(found: Iterable[Message]) -> pa.Table:
    columns = list(zip(*found)) or [[], [], [], []]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, MESSAGE_TYPES)], names=[n for n, _ in MESSAGE_TYPES])


def read(table: pa.Table) -> list[Message]:
    """Messages in a fixed order, whatever order they arrived in."""
    return sorted(zip(*(table[n].to_pylist() for n, _ in MESSAGE_TYPES)), key=lambda m: m[:3])


def ask(rows: DataFrame, question: Callable[[int, pa.Table], Iterable[Message]], group: str = "chunk") -> DataFrame:
    """Messages of every chunk; ``question`` gets its number and its rows."""

    def run(table: pa.Table) -> pa.Table:
        return messages(question(table[group][0].as_py(), table))

    return rows.groupBy(group).applyInArrow(run, MESSAGE)


def answer(asked: DataFrame, reply: Callable[[list[Message]], Iterable[Message]]) -> DataFrame:
    """Answers of every slice to the messages it got."""
    return asked.groupBy("slice").applyInArrow(lambda table: messages(reply(read(table))), MESSAGE)


def hear(rows: DataFrame, answers: DataFrame, act: Callable[[int, pa.Table, list[Message]], pa.Table], schema: StructType | str, group: str = "chunk") -> DataFrame:
    """Every chunk with the answers it got. A chunk without rows is not called."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table | None:
        return act(left[group][0].as_py(), left, read(right)) if left.num_rows else act(-1, left, [])

    return rows.groupBy(group).cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def by_tag(found: list[Message]) -> dict[int, list[bytes]]:
    """Payloads per tag, in the order of the slices."""
    out: dict[int, list[bytes]] = defaultdict(list)
    for _, _, tag, payload in found:
        out[tag].append(payload)
    return out


def bits_of(payloads: list[bytes], total: int) -> np.ndarray:
    """Answers of one bit per entry, put together."""
    parts = [np.unpackbits(b, count=len(n) and int(n[0])) for n, b in (unpack(p, np.int64, np.uint8) for p in payloads)]
    flags = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
    if len(flags) != total:
        raise RuntimeError(f"{len(flags)} answers to {total} keys: the chunk was not read twice alike")
    return flags


def bit_payload(flags: np.ndarray) -> bytes:
    return pack(np.array([len(flags)], np.int64), np.packbits(flags))


@dataclass(frozen=True)
class Sketch:
    """A count-min sketch of ``depth`` rows, spread over slices.

    The sketch of a chunk is sparse: its cells, sorted, and their counts where above one, up to 255. Slices add the sketches of all chunks up
    in an array of their range of cells. Counters only ever count too much where it matters: a key that occurs twice is never missed.
    ``often`` is the count from which on a key is called hot; as counts of a chunk stop at 255, only keys of several chunks can be.
    """

    bits: int
    slices: int
    often: int = 0
    depth: int = 2

    SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
    HOT_TAG = 4
    # sorted cells are sent as these lower bits, two bytes each, and the number of cells per value of the upper ones
    LOW_BITS = 15

    @classmethod
    def for_keys(cls, keys: int, slices: int, load: int = 8, often: int = 0, depth: int = 2) -> Sketch:
        """At least ``load`` cells per key and row."""
        return cls(min(60, max(16, math.ceil(math.log2(max(1, keys) * load)))), slices, often, depth)

    def cells(self, keys: np.ndarray, row: int) -> np.ndarray:
        return mix(keys ^ np.uint64(self.SEEDS[row])) >> np.uint64(64 - self.bits)

    def edges(self) -> np.ndarray:
        return np.array([-(-(s << self.bits) // self.slices) for s in range(self.slices + 1)], np.uint64)

    def _packed(self, cells: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        blocks = np.bincount((cells >> np.uint64(self.LOW_BITS)).astype(np.int64), minlength=(width >> self.LOW_BITS) + 1)
        return blocks.astype(np.uint16), (cells & np.uint64((1 << self.LOW_BITS) - 1)).astype(np.uint16)

    def _unpacked(self, blocks: np.ndarray, low: np.ndarray) -> np.ndarray:
        return np.repeat(np.arange(len(blocks)) << self.LOW_BITS, blocks) + low

    def ask(self, chunk: int, keys: np.ndarray) -> Iterator[Message]:
        edges = self.edges()
        for row in range(self.depth):
            cells, counts = np.unique(self.cells(keys, row), return_counts=True)
            many = counts > 1
            counts = np.minimum(counts, 255).astype(np.uint8)
            cuts = np.searchsorted(cells, edges)
            for s in range(self.slices):
                lo, hi = cuts[s], cuts[s + 1]
                if hi > lo:
                    yield s, chunk, row, pack(*self._packed(cells[lo:hi] - edges[s], int(edges[s + 1] - edges[s])), np.packbits(many[lo:hi]), counts[lo:hi][many[lo:hi]])

    def reply(self, asked: list[Message]) -> Iterator[Message]:
        edges = self.edges()
        enough = max(2, self.often)
        for row in range(self.depth):
            mine = [(chunk, payload) for _, chunk, tag, payload in asked if tag == row]
            if not mine:
                continue
            s = asked[0][0]
            total = np.zeros(int(edges[s + 1] - edges[s]), np.uint8 if enough < 255 else np.uint32)
            for turn in (self._add, self._tell):
                for chunk, payload in mine:
                    blocks, low, many, counts = unpack(payload, np.uint16, np.uint16, np.uint8, np.uint8)
                    for tag, answer in turn(total, self._unpacked(blocks, low), many, counts, enough):
                        yield s, chunk, tag + row, answer

    def _add(self, total: np.ndarray, cells: np.ndarray, many: np.ndarray, counts: np.ndarray, enough: int) -> Iterator:
        more = np.ones(len(cells), np.uint32)
        more[np.unpackbits(many, count=len(cells)).astype(bool)] = counts
        total[cells] = np.minimum(total[cells] + more, enough)
        return iter(())

    def _tell(self, total: np.ndarray, cells: np.ndarray, many: np.ndarray, counts: np.ndarray, enough: int) -> Iterator:
        yield 0, bit_payload(total[cells] > 1)
        if self.often:
            yield self.HOT_TAG, bit_payload(total[cells] >= enough)

    def _both(self, answers: dict[int, list[bytes]], keys: np.ndarray, tag: int) -> np.ndarray:
        flags = np.ones(len(keys), bool)
        for row in range(self.depth):
            cells, place = distinct(self.cells(keys, row), self.bits)
            flags &= bits_of(answers.get(tag + row, []), len(cells))[place]
        return flags

    def repeated(self, answers: dict[int, list[bytes]], keys: np.ndarray) -> np.ndarray:
        """Which of the keys are estimated to occur twice, from the answers under the tags of the rows."""
        return self._both(answers, keys, 0)

    def hot(self, answers: dict[int, list[bytes]], keys: np.ndarray) -> np.ndarray:
        return self._both(answers, keys, self.HOT_TAG)
