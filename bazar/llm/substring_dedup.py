"""Removal of repeated passages of words: a count-min prefilter, then exact groups.

Every window of ``window`` words has an anchor, its half-length shingle of the smallest hash. Equal windows have equal
anchors, so the count of its anchor is never below that of a window. Neighbouring windows mostly share one anchor, so a sketch of the
anchors is six times smaller than one of the windows. The sketches of all chunks are merged; in a second pass the windows whose anchor
is estimated to occur twice, and only they, are grouped exactly.

A window is known by 96 bits of hash besides the slice they select. A chunk sends each of its distinct windows once, with the smallest document it has it in; the slice
tells every chunk which of them some other chunk has in a smaller document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bazar.llm import exchange
from bazar.llm.tables import stored
from bazar.llm.text import BASES, content_hashes, covered, flat, group_sums, pieces, ranges, sliding_argmin, window_hashes, window_starts, word_spans

WINDOW = 20
WINDOWS_TAG = 8


@dataclass
class Words:
    """The words of a chunk, in document order."""

    docs: np.ndarray
    orders: np.ndarray  # among rows of one doc
    hashes: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, chunk: pa.Table) -> Words:
        hashes, counts = [], [np.zeros(0, np.int64)]
        for _, _, data, offsets in pieces(*flat(chunk["text"])):
            starts, ends, bounds = word_spans(data, offsets)
            hashes.append(content_hashes(data, starts, ends))
            counts.append(np.diff(bounds))
        counts = np.concatenate(counts)
        return cls(exchange.doc_numbers(chunk), chunk["order"].to_numpy().astype(np.int32), np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(counts)]))

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window starts, and per run of windows with one anchor its key and length."""
        starts = window_starts(self.bounds, window)
        if not len(starts):
            return starts, np.zeros(0, np.uint64), starts
        size = window // 2
        shingles = window_hashes(self.hashes, size)
        place = sliding_argmin(shingles, window - size + 1)[starts]
        run = np.flatnonzero(np.diff(place, prepend=-1))
        return starts, shingles[place[run]], np.diff(run, append=len(place))


def _candidates(words: Words, sketch: exchange.Sketch, window: int, answers: dict[int, list[bytes]]):
    """Windows estimated to occur twice: starts, and the distinct ones as (high, low, first start), sorted."""
    starts, keys, lengths = words.anchors(window)
    starts = starts[np.repeat(sketch.repeated(answers, keys), lengths)]
    high = window_hashes(words.hashes, window)[starts] if len(starts) else np.zeros(0, np.uint64)
    low = (window_hashes(words.hashes, window, BASES[2])[starts] >> np.uint64(32)).astype(np.uint32) if len(starts) else np.zeros(0, np.uint32)
    order = np.lexsort((low, high))  # stable: equal windows stay in document order
    new = np.ones(len(order), bool)
    new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
    first = order[new]
    return starts, high[first], low[first], first


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts earlier.

    Earlier is a smaller ``key``, or the same document further ahead; windows are judged on the input. Adds ``n_words``, ``n_removed`` (long) and
    ``kept_text``, the words left joined by one space, to every row; columns called like them are replaced. NULL and empty texts have no words,
    and a text shorter than a window keeps all. A NULL key is smaller than all others. Rows that repeat a key count as one after the other, in the
    order of a hash of their texts, so the second of two equal rows loses what the first has. An empty table stays empty.
    """
    added = StructType([StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())])
    kept = [c for c in docs.columns if c not in added.names]
    chunks = exchange.chunked(docs, key, text, carry=kept)
    plain, slices = chunks.rows.drop("row"), chunks.count
    # about one anchor to six words of six bytes
    sketch = exchange.Sketch.for_keys(chunks.size // 30 + 1, chunks.count)

    def count(chunk: int, table: pa.Table):
        return sketch.ask(chunk, Words.of(exchange.in_order(table)).anchors(window)[1])

    estimates = stored(exchange.answer(exchange.ask(plain, count), sketch.reply))

    def group(chunk: int, table: pa.Table, heard: list[exchange.Message]) -> pa.Table:
        if chunk < 0:
            return exchange.messages([])
        words = Words.of(exchange.in_order(table))
        starts, high, low, first = _candidates(words, sketch, window, exchange.by_tag(heard))
        row = np.searchsorted(words.bounds, starts[first], side="right") - 1
        owner, among = words.docs[row], words.orders[row]
        cuts = exchange.slice_cuts(high, slices)
        sent = ((s, cuts[s], cuts[s + 1]) for s in range(slices))
        return exchange.messages((s, chunk, WINDOWS_TAG, exchange.pack(high[a:b], low[a:b], owner[a:b], among[a:b])) for s, a, b in sent if b > a)

    def judge(asked: list[exchange.Message]):
        parts = [exchange.unpack(payload, np.uint64, np.uint32, np.int64, np.int32) for _, _, _, payload in asked]
        high, low, owner, among = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((among, owner, low, high))  # stable: then by chunk
        later = np.zeros(len(order), bool)
        later[order[1:]] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
        at = 0
        for (s, chunk, tag, _), part in zip(asked, parts):
            yield s, chunk, tag, exchange.bit_payload(later[at : at + len(part[0])])
            at += len(part[0])

    verdicts = stored(exchange.answer(exchange.hear(plain, estimates, group, exchange.MESSAGE), judge))
    schema = StructType([chunks.rows.schema["row"], *added])

    def remove(chunk: int, table: pa.Table, heard: list[exchange.Message]) -> pa.Table:
        table = exchange.in_order(table) if table.num_rows else table
        answers = exchange.by_tag(heard)
        words = Words.of(table)
        starts, high, _, first = _candidates(words, sketch, window, answers)
        gone = np.ones(len(starts), bool)
        gone[first] = exchange.bits_of(answers.get(WINDOWS_TAG, []), len(high))
        removed = covered(starts[gone], window, len(words.hashes))
        texts: list[bytes] = []
        at = 0
        for _, _, data, offsets in pieces(*flat(table["text"])):
            opens, closes, bounds = word_spans(data, offsets)
            stay = ~removed[at : at + len(opens)]
            at += len(opens)
            texts += _joined(data, opens[stay], closes[stay], group_sums(stay, bounds))
        made = [pa.array(np.diff(words.bounds), pa.int64()), pa.array(group_sums(removed, words.bounds), pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
        return pa.table([table["row"], *made], names=["row", *added.names])

    done = exchange.hear(chunks.rows, estimates.unionByName(verdicts), remove, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], *added.names)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The words of each row with one space between them."""
    sizes = ends - starts + 1
    to = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), 0x20, np.uint8)
    out[ranges(to, sizes - 1)] = data[ranges(starts, sizes - 1)]
    edges = np.concatenate([to, [len(out)]])[np.concatenate([[0], np.cumsum(counts)])]
    raw = out.tobytes()
    return [raw[a : b - 1] if b > a else b"" for a, b in zip(edges[:-1], edges[1:])]
