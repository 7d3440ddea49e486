"""Benchmark decontamination by a broadcast hash set of normalised n-grams.

Every n-gram of the benchmark items goes into a sorted array of 64-bit hashes. Each text is scanned
window by window against it; a hit is compared word by word with the item before it counts. A benchmark
beyond ``BLOCK_BYTES`` of words is dealt into blocks of about that size, each with a hash set of its own. Each block is a job of its own over the
texts, stored with what was found so far, so only one broadcast and one hash set are alive at a time.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from bazar.llm.tables import stored
from bazar.llm.text import covered, flat, pieces, ranges, span_hashes, window_hashes, window_starts, word_spans

WINDOW = 10
# Words of the benchmark looked for at once; the arrays of one block take some ten times as much.
BLOCK_BYTES = 8 << 20

# Letters, digits and every byte of a non-ASCII character; upper case is gone before.
WORDS = np.zeros(256, bool)
WORDS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

HITS = [StructField("n_words", LongType()), StructField("hit_words", ArrayType(LongType())), StructField("items", ArrayType(LongType()))]


class NGrams:
    """The windows of some items as flat arrays: the words of all items in one buffer, and by length the windows' hashes in order, each with
    its place in the buffer and its item. They take some ten times the words; what hashes that hit stand for is remembered for ``REMEMBERED`` of them."""

    REMEMBERED = 1 << 14

    def __init__(self, items: Sequence[tuple[int | None, str]], window: int):
        self.ids = [i for i, _ in items]
        buffers: list[bytes] = []
        parts: dict[int, list[tuple[np.ndarray, ...]]] = defaultdict(list)
        base = 0
        for first, _, data, offsets in pieces(*flat(pa.array([t for _, t in items], pa.string()))):
            data = LOWER[data]
            starts, ends, bounds = word_spans(data, offsets, WORDS)
            hashes = span_hashes(data, starts, ends)
            # words one after the other with a space between, so a window is a slice
            to = base + np.cumsum(ends - starts + 1) - (ends - starts + 1)
            buffers += [data[x:y].tobytes() + b" " for x, y in zip(starts.tolist(), ends.tolist())]
            stop = to + (ends - starts)
            sizes = np.minimum(window, np.diff(bounds))
            for size in np.unique(sizes[sizes > 0]).tolist():
                rows = np.flatnonzero(sizes == size)
                counts = np.diff(bounds)[rows] - size + 1
                at = ranges(bounds[rows], counts)
                parts[size].append((window_hashes(hashes, size)[at], to[at], stop[at + size - 1], np.repeat(first + rows, counts)))
            base = int(stop[-1]) + 1 if len(stop) else base
        self.words = b"".join(buffers)
        self.sorted: dict[int, tuple[np.ndarray, ...]] = {}
        for size, found in parts.items():
            columns = [np.concatenate(c) for c in zip(*found)]
            order = np.argsort(columns[0], kind="stable")
            self.sorted[size] = tuple(c[order] for c in columns)
        self.memory: dict[tuple[int, int], dict[bytes, set[int | None]]] = {}

    @property
    def nbytes(self) -> int:
        return len(self.words) + sum(c.nbytes for columns in self.sorted.values() for c in columns)

    def owners(self, size: int, value: np.uint64) -> dict[bytes, set[int | None]]:
        """The texts of the windows with a hash, and the items of each."""
        found = self.memory.get((size, int(value)))
        if found is None:
            hashes, to, stop, item = self.sorted[size]
            found = {}
            for i in range(np.searchsorted(hashes, value), np.searchsorted(hashes, value, side="right")):
                found.setdefault(self.words[to[i] : stop[i]], set()).add(self.ids[item[i]])
            if len(self.memory) >= self.REMEMBERED:
                self.memory.clear()
            self.memory[size, int(value)] = found
        return found

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[set[int]]]:
        """First word of each row, hit words, and the items found in each row."""
        data = LOWER[data]
        starts, ends, bounds = word_spans(data, offsets, WORDS)
        words = span_hashes(data, starts, ends)
        hit = np.zeros(len(starts), bool)
        items: list[set[int]] = [set() for _ in range(len(offsets) - 1)]
        for size, (known, *_) in self.sorted.items():
            at = window_starts(bounds, size)
            if not len(at):
                continue
            hashes = window_hashes(words, size)[at]
            likely = np.flatnonzero(known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes)
            verified = []
            for j in likely:
                i = at[j]
                text = b" ".join(data[a:b].tobytes() for a, b in zip(starts[i : i + size], ends[i : i + size]))
                owners = self.owners(size, hashes[j]).get(text)
                if owners:
                    verified.append(i)
                    items[int(np.searchsorted(bounds, i, side="right")) - 1] |= owners
            hit |= covered(np.array(verified, np.int64), size, len(starts))
        return bounds, hit, items


@lru_cache(maxsize=1)
def _ngrams(block: tuple[tuple[int, str], ...], window: int) -> NGrams:
    return NGrams(block, window)


def _last(item: int | None) -> tuple[bool, int]:
    """Order of items, those without an id behind all others."""
    return item is None, item or 0


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: Sequence[str] | None = None,
    unnamed: bool = False,
) -> DataFrame:
    """Add ``n_words``, ``hit_words`` (numbers of the words hit, ascending) and ``items`` (ids found) to every row.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window. A
    word inside any occurrence of a window is hit. NULL and empty texts have no words; NULL and empty items no windows. Items
    without an id have none either, but if ``unnamed``: then they hit like others and are one NULL at the end of ``items``. Equal items are all reported. An empty benchmark hits nothing. Columns called like the new ones are
    replaced. Item ids are whole numbers; others stop the job. Only the benchmark is broadcast, in blocks of at most about ``block_bytes``.
    """
    names = [f.name for f in HITS]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    entries = benchmark.select(F.col(item).cast("bigint").alias("item"), F.col(item_text).alias("words")).dropna(subset=["words"] if unnamed else None)
    size = entries.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    # the words each pass needs are in the text; what it found so far travels along
    found = docs.select(*kept, F.col(text).alias("__text"), F.lit(None).cast("array<bigint>").alias("__hits"), F.lit(None).cast("array<bigint>").alias("__items"), F.lit(0).cast("bigint").alias("__n"))
    for number in range(blocks):
        block = entries if blocks == 1 else entries.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == number)
        shared = docs.sparkSession.sparkContext.broadcast(tuple(sorted(((r.item, r.words) for r in block.collect()), key=lambda r: (_last(r[0]), r[1]))))
        found = found.mapInArrow(_scanner(shared, window, len(kept), found.columns), found.schema)
        if number < blocks - 1:
            found = stored(found)
            shared.unpersist()
    return found.select(*kept, F.col("__n").alias("n_words"), F.col("__hits").alias("hit_words"), F.col("__items").alias("items"))


def _scanner(shared, window: int, kept: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = _ngrams(shared.value, window)
        for batch in batches:
            data, offsets = flat(batch.column(kept))
            for first, end, part, part_offsets in pieces(data, offsets):
                bounds, hit, items = grams.scan(part, part_offsets)
                rows = batch.slice(first, end - first)
                hits = []
                for row, (old_hits, old_items) in enumerate(zip(rows.column(kept + 1).to_pylist(), rows.column(kept + 2).to_pylist())):
                    new = np.flatnonzero(hit[bounds[row] : bounds[row + 1]])
                    hits.append(np.union1d(old_hits, new).astype(np.int64) if old_hits else new)
                    items[row] |= set(old_items or ())
                made = [pa.array(hits, pa.list_(pa.int64())), pa.array([sorted(x, key=_last) for x in items], pa.list_(pa.int64())), pa.array(np.diff(bounds), pa.int64())]
                yield pa.RecordBatch.from_arrays([*(rows.column(i) for i in range(kept + 1)), *made], names=names)

    return run


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows without a hit, with their own columns unchanged."""
    row = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__words"))
    return find_leaks(row, benchmark, "__words", keep=["__row"], **how).filter(F.size("hit_words") == 0).select("__row.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """All rows, with the hit words cut out of the text; the text between two words stays with the first.

    A NULL text stays NULL. This is the gentler treatment where a leak is a small part of a document.
    """
    row = docs.select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__words"))
    found = find_leaks(row, benchmark, "__words", keep=["__row", "__words"], **how)
    schema = StructType([StructField("__row", row.schema["__row"].dataType), StructField("__words", row.schema["__words"].dataType)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for value, hits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if hits:
                    raw = value.encode()
                    data = np.frombuffer(raw, np.uint8)
                    starts, _, _ = word_spans(LOWER[data], np.array([0, len(data)]), WORDS)
                    edges = np.append(starts, len(data))
                    keep = np.ones(len(data), bool)
                    for i in hits:
                        keep[edges[i] : edges[i + 1]] = False
                    value = data[keep].tobytes().decode("utf-8", "ignore")
                texts.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["__row", "__words"])

    mended = found.select("__row", "__words", "hit_words").mapInArrow(cut, schema)
    return mended.select(F.col("__row").withField(text, F.col("__words")).alias("__row")).select("__row.*")
