"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a variant in common that is at most half the radius away from
either. So every distinct fingerprint emits all variants within half the radius, and fingerprints that share a variant are linked, which
also bounds their distance. Nothing depends on how the bits are distributed, and no link is missed.

With 2081 variants per fingerprint nearly all of them are met by no other. Variants first pass a count-min sketch; only those estimated to occur twice
are shuffled. The fingerprints of one variant are linked to the smallest of them, not to each other, so a large group of near copies makes no pairs.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from bazar.llm import exchange
from bazar.llm.components import components
from bazar.llm.tables import stored, with_text_columns
from bazar.llm.text import ranges, window_starts, word_spans

SHINGLE = 4
RADIUS = 4
SEED = 42
# Distinct fingerprints whose variants are made at once.
CHUNK_FINGERPRINTS = 1000
VARIANT_TAG = 8

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def fingerprints(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of every row as signed 64-bit numbers: a bit is 1 if set in over half the XXH64 of the shingles."""
    data = LOWER[data]
    starts, ends, bounds = word_spans(data, offsets)
    sizes = ends - starts + 1
    to = np.cumsum(sizes) - sizes
    joined = np.full(int(sizes.sum()), 0x20, np.uint8)
    joined[ranges(to, sizes - 1)] = data[ranges(starts, sizes - 1)]
    raw, stop = joined.tobytes(), to + sizes - 1
    counts = np.diff(bounds)
    short = (counts > 0) & (counts < shingle)
    first = np.sort(np.concatenate([window_starts(bounds, shingle), bounds[:-1][short]]))
    row = np.searchsorted(bounds, first, side="right") - 1
    last = np.minimum(first + shingle, bounds[row + 1]) - 1
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(raw[a:b], SEED) for a, b in zip(to[first].tolist(), stop[last].tolist())], np.uint64)
    out = np.zeros(len(counts), np.uint64)
    if len(hashes):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = np.flatnonzero(np.diff(row, prepend=-1))
        ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        total = np.diff(begin, append=len(row))[:, None]
        out[row[begin]] = np.packbits(2 * ones > total, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out.view(np.int64)


def masks(radius: int) -> np.ndarray:
    """All 64-bit values with at most ``radius`` bits set."""
    return np.array([sum(1 << i for i in some) for n in range(radius + 1) for some in combinations(range(64), n)], np.uint64)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect all fingerprints within ``radius`` bits of each other, from their distinct values (column fingerprint).

    Fingerprints that share a variant get an edge to the smallest among them, so the edges connect what all pairs would.
    """
    half = (radius + 1) // 2
    flips = masks(half)
    distinct = stored(distinct.select("fingerprint"))
    n = distinct.count()
    chunks = max(1, -(-n // CHUNK_FINGERPRINTS))
    slices = chunks * 4
    # variants are many and little each: one row, but with cells to spare
    sketch = exchange.Sketch.for_keys(n * len(flips), slices, load=16, depth=1)
    rows = distinct.select(F.pmod(F.xxhash64("fingerprint"), F.lit(chunks)).cast("int").alias("chunk"), "fingerprint")

    def variants(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        own = np.sort(table["fingerprint"].to_numpy().astype(np.int64).view(np.uint64))
        return own, (own[:, None] ^ flips).ravel()

    def count(chunk: int, table: pa.Table):
        return sketch.ask(chunk, variants(table)[1])

    estimates = stored(exchange.answer(exchange.ask(rows, count), sketch.reply))

    def meet(chunk: int, table: pa.Table, heard: list[exchange.Message]) -> pa.Table:
        if chunk < 0:
            return exchange.messages([])
        own, all_variants = variants(table)
        at = np.flatnonzero(sketch.repeated(exchange.by_tag(heard), all_variants))
        at = at[np.argsort(all_variants[at], kind="stable")]
        found, flip = all_variants[at], (at % len(flips)).astype(np.uint16)
        cuts = exchange.slice_cuts(found, slices)
        return exchange.messages((s, chunk, VARIANT_TAG, exchange.pack(found[a:b], flip[a:b])) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a)

    def verify(table: pa.Table) -> pa.Table:
        found, flip = (np.concatenate(c) for c in zip(*(exchange.unpack(m[3], np.uint64, np.uint16) for m in exchange.read(table))))
        owner = found ^ flips[flip]
        order = np.lexsort((owner, found))
        found, owner = found[order], owner[order]
        begin = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        hub = np.repeat(owner[begin], np.diff(begin, append=len(found)))
        near = (owner != hub) & (np.bitwise_count(owner ^ hub) <= radius)
        pairs = np.unique(np.stack([owner[near], hub[near]], axis=1).view([("a", np.uint64), ("b", np.uint64)]))
        return pa.table([pa.array(pairs[c].view(np.int64)) for c in "ab"], names=["a", "b"])

    met = exchange.hear(rows, estimates, meet, exchange.MESSAGE)
    return met.groupBy("slice").applyInArrow(verify, "a bigint, b bigint").distinct()


def classes(marked: DataFrame, key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row per distinct fingerprint of ``marked`` (columns ``key``, fingerprint): fingerprint, component_id and
    the fingerprint of the row that gives the component its id."""
    firsts = stored(marked.groupBy("fingerprint").agg(F.min(key).alias("first")))
    roots = components(links(firsts, radius))
    placed = firsts.join(roots, firsts.fingerprint == roots.node, "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"), F.min_by("fingerprint", F.struct(F.col("first").isNull(), "first", "fingerprint")).alias("keeper"))
    return placed.join(named, "root").select("fingerprint", "component_id", "keeper")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``key``, ``fingerprint`` (bigint) and ``component_id`` for every row.

    The component of a row is the smallest key of the rows it can reach over fingerprints that differ in at most ``radius`` bits, itself included. Texts
    of fewer than ``shingle`` words are one shingle; NULL and empty texts have fingerprint 0 and are linked like others. A NULL key is never the
    smallest, so a component of such rows alone has a NULL id. Rows that repeat a key are linked by their own texts. An empty table gives no rows.
    """
    marked = stored(_marked(docs, text, shingle, [key]))
    return marked.join(classes(marked, key, radius).drop("keeper"), "fingerprint").select(key, "fingerprint", "component_id")


def _marked(docs: DataFrame, text: str, shingle: int, keep: Sequence[str] | None = None) -> DataFrame:
    return with_text_columns(docs, text, [StructField("fingerprint", LongType())], lambda data, offsets: [fingerprints(data, offsets, shingle)], keep)


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each component, that of its smallest key, with its own columns unchanged; of rows that repeat both key and
    fingerprint one stays."""
    row = docs.select(F.struct(*docs.columns).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    marked = stored(_marked(row, "text", shingle, ["row", "key"]))
    keepers = classes(marked.select("key", "fingerprint"), "key", radius).filter("fingerprint = keeper").select(F.col("component_id").alias("__id"), F.col("keeper").alias("__print"))
    same = F.col("key").eqNullSafe(F.col("__id")) & (F.col("fingerprint") == F.col("__print"))
    return marked.join(keepers, same, "left_semi").dropDuplicates(["key", "fingerprint"]).select("row.*")
