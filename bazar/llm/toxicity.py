"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters the network as the sum of two projections: of its own vector, if the training texts have it often enough,
and of the mean vector of its hashed character sequences of several lengths. Two gated recurrent units read a window of words from both
ends; attention weighs their states, and the weighted mean gives the log odds of the window. Overlapping windows cover
every text from its first to its last word; the score of a text is that of its most toxic window, calibrated on the training texts.

Training sees a bounded sample of labelled texts (parameters of ``fit``); scoring sees all windows of all texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from bazar.llm.tables import hash_sample, with_text_columns
from bazar.llm.text import byte_values, flat, pieces, ranges, span_hashes, window_hashes, word_spans

WINDOW, STRIDE = 48, 36
HIDDEN = 8
VECTOR = 8
CHAR_SLOTS = 1 << 15
# Bytes per character sequence; one byte for the border counts on either side of a word.
CHAR_SIZES = (3, 5, 8)
# A word of the training sample has a vector of its own from so many texts on; there are at most VOCABULARY of them.
LEAST_TEXTS, VOCABULARY = 8, 30_000
# Labelled texts learned from, of each label, and the longest of them in bytes.
SAMPLE, LONGEST = 2000, 6000
EPOCHS, BATCH, RATE = 6, 192, 0.01
# Share of word vectors hidden in training, and what vectors lose per step, in units of the rate.
DROPPED, DECAY = 0.3, 0.02

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def char_slots(text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the character sequences of words, whose bytes stand one after the other, and the bounds of each word's.

    A word gets a border byte on both sides; sequences that run over the border of a short word are left out.
    """
    lengths = sizes + 2
    firsts = np.cumsum(lengths) - lengths
    padded = np.full(int(lengths.sum()), 0x20, np.uint8)
    padded[ranges(firsts + 1, sizes)] = text
    values = byte_values(padded)
    per_size = [np.maximum(lengths - size + 1, 0) for size in CHAR_SIZES]
    counts = sum(per_size)
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    slots, at = np.zeros(int(counts.sum()), np.int32), bounds[:-1].copy()
    for size, n in zip(CHAR_SIZES, per_size):
        if n.sum():
            slots[ranges(at, n)] = (window_hashes(values, size)[ranges(firsts, n)] % np.uint64(CHAR_SLOTS)).astype(np.int32)
        at += n
    return slots, bounds


@dataclass
class Words:
    """Words of a piece: distinct words, and which of them stands where."""

    hashes: np.ndarray  # of the distinct words
    place: np.ndarray  # for every word of the piece its distinct word
    bounds: np.ndarray  # first word of every row
    slots: np.ndarray  # character sequence slots of the distinct words, one after the other
    slot_bounds: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Words:
        hashes, counts, texts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
        places, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for _, _, part, bounds in pieces(data, offsets):
            part = LOWER[part]
            starts, ends, firsts = word_spans(part, bounds)
            distinct, first, place = np.unique(span_hashes(part, starts, ends), return_index=True, return_inverse=True)
            places.append(place + sum(len(h) for h in hashes))
            hashes.append(distinct)
            sizes.append(ends[first] - starts[first])
            texts.append(part[ranges(starts[first], sizes[-1])])
            counts.append(np.diff(firsts))
        hashes, first, merged = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        sizes, text = np.concatenate(sizes), np.concatenate(texts)
        begin = (np.cumsum(sizes) - sizes)[first]
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        return cls(hashes, merged[np.concatenate(places)], bounds, *char_slots(text[ranges(begin, sizes[first])], sizes[first]))

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, first word and length of every window; a row without words has none."""
        counts = np.diff(self.bounds)
        n = np.where(counts > 0, 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE)), 0)
        rows = np.repeat(np.arange(len(counts)), n)
        inner = ranges(np.zeros(len(n), np.int64), n) * STRIDE
        return rows, self.bounds[rows] + inner, np.minimum(WINDOW, counts[rows] - inner)


@dataclass
class Network:
    known: np.ndarray  # sorted hashes of the words that have a vector
    weights: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def new(cls, known: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        gates = 3 * HIDDEN
        normal = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        weights = {
            "word": np.concatenate([normal(len(known), VECTOR, scale=0.1), np.zeros((1, VECTOR), np.float32)]),
            "char": normal(CHAR_SLOTS, VECTOR, scale=0.1),
            "query": np.zeros(2 * HIDDEN, np.float32),
            "out": normal(2 * HIDDEN, scale=0.3),
            "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            weights |= {f"word_{side}": normal(VECTOR, gates, scale=0.5), f"char_{side}": normal(VECTOR, gates, scale=0.5), f"again_{side}": normal(HIDDEN, gates, scale=0.3), f"gate_{side}": np.zeros(gates, np.float32)}
        return cls(known, weights)

    def inputs(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Vector number and mean character vector of every distinct word; number -1 is the zero vector."""
        at = np.minimum(np.searchsorted(self.known, words.hashes), max(0, len(self.known) - 1))
        number = np.where(self.known[at] == words.hashes, at, len(self.known)) if len(self.known) else np.zeros(len(words.hashes), np.int64)
        sizes = np.diff(words.slot_bounds)
        chars = np.zeros((len(sizes), VECTOR), np.float32)
        for lo in range(0, len(sizes), 1 << 15):  # the gathered vectors of some words at a time
            some = np.flatnonzero(sizes[lo : lo + (1 << 15)]) + lo
            if len(some):
                gathered = self.weights["char"][words.slots[words.slot_bounds[some[0]] : words.slot_bounds[some[-1] + 1]]]
                chars[some] = np.add.reduceat(gathered, words.slot_bounds[some] - words.slot_bounds[some[0]], axis=0) / sizes[some, None]
        return number, chars

    def run(self, gates: dict[str, np.ndarray], place: np.ndarray, there: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Log odds of windows. ``place`` is (time, window) of distinct words, ``there`` which of them exist."""
        time, n = place.shape
        states = {}
        for side in "fb":
            steps = range(time) if side == "f" else range(time - 1, -1, -1)
            again = self.weights[f"again_{side}"]
            h = np.zeros((n, HIDDEN), np.float32)
            kept = np.zeros((time, n, HIDDEN), np.float32)
            for t in steps:
                x, old = gates[side][place[t]], h
                rz = sigmoid(x[:, : 2 * HIDDEN] + old @ again[:, : 2 * HIDDEN])
                r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
                back = old @ again[:, 2 * HIDDEN :]
                new = np.tanh(x[:, 2 * HIDDEN :] + r * back)
                h = np.where(there[t][:, None], z * old + (1 - z) * new, old)
                kept[t] = h
                if trace is not None:
                    trace[side, t] = (old, r, z, back, new)
            states[side] = kept
        both = np.concatenate([states["f"], states["b"]], axis=2)
        energy = np.where(there, both @ self.weights["query"], -1e9)
        share = np.exp(energy - energy.max(axis=0))
        share = share / share.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, both)
        if trace is not None:
            trace["pool"] = (both, share, pooled)
        return pooled @ self.weights["out"] + self.weights["bias"][0]

    def gates(self, number: np.ndarray, chars: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        vectors = w["word"][number]
        return {side: vectors @ w[f"word_{side}"] + chars @ w[f"char_{side}"] + w[f"gate_{side}"] for side in "fb"}

    def window_odds(self, words: Words, batch: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        rows, firsts, sizes = words.windows()
        odds = np.zeros(len(rows), np.float32)
        if len(rows):
            gates = self.gates(*self.inputs(words))
            order = np.argsort(sizes, kind="stable")
            for i in range(0, len(order), batch):
                part = order[i : i + batch]
                steps = np.arange(sizes[part].max())[:, None]
                there = steps < sizes[part]
                place = words.place[np.minimum(firsts[part] + steps, len(words.place) - 1)]
                odds[part] = self.run(gates, place, there)
        return rows, odds

    def text_odds(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The largest log odds over the windows of each row; without words, those of no evidence at all."""
        words = Words.of(data, offsets)
        rows, odds = self.window_odds(words)
        best = np.full(len(offsets) - 1, -np.inf)
        np.maximum.at(best, rows, odds)
        return np.where(np.isinf(best), min(0.0, float(self.weights["bias"][0])), best)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.text_odds(data, offsets) + self.shift)


def gradients(net: Network, words: Words, number: np.ndarray, chars: np.ndarray, place: np.ndarray, there: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> dict[str, np.ndarray]:
    """Back-propagation of the mean logistic loss through one batch of windows."""
    w, trace = net.weights, {}
    gates = net.gates(number, chars)
    odds = net.run(gates, place, there, trace)
    n = len(labels)
    d_odds = (sigmoid(odds) - labels) * weights / n
    both, share, pooled = trace["pool"]
    slope = {"out": pooled.T @ d_odds, "bias": np.array([d_odds.sum()])}
    d_pooled = d_odds[:, None] * w["out"]
    d_both = share[:, :, None] * d_pooled
    d_share = np.einsum("tnh,nh->tn", both, d_pooled)
    d_energy = share * (d_share - (share * d_share).sum(axis=0))
    slope["query"] = np.einsum("tn,tnh->h", d_energy, both)
    d_both = d_both + d_energy[:, :, None] * w["query"]
    d_word = np.zeros_like(w["word"])
    d_chars = np.zeros_like(chars)
    vectors = w["word"][number]
    for side, lo in (("f", 0), ("b", HIDDEN)):
        again = w[f"again_{side}"]
        d_again = np.zeros_like(again)
        d_x = np.zeros((*place.shape, 3 * HIDDEN), np.float32)
        d_h = np.zeros((n, HIDDEN), np.float32)
        steps = range(place.shape[0] - 1, -1, -1) if side == "f" else range(place.shape[0])
        for t in steps:
            old, r, z, back, new = trace[side, t]
            d_h = d_h + d_both[t, :, lo : lo + HIDDEN]
            d_now = d_h * there[t][:, None]
            d_new = d_now * (1 - z) * (1 - new * new)
            d_z = d_now * (old - new) * z * (1 - z)
            d_r = d_new * back * r * (1 - r)
            d_rz = np.concatenate([d_r, d_z], axis=1)
            d_again[:, : 2 * HIDDEN] += old.T @ d_rz
            d_again[:, 2 * HIDDEN :] += old.T @ (d_new * r)
            d_x[t] = np.concatenate([d_rz, d_new], axis=1)
            d_h = d_h * ~there[t][:, None] + d_now * z + d_rz @ again[:, : 2 * HIDDEN].T + (d_new * r) @ again[:, 2 * HIDDEN :].T
        d_gates = _sum_rows(d_x.reshape(-1, 3 * HIDDEN), place.ravel(), len(gates[side]))
        slope[f"again_{side}"] = d_again
        slope[f"gate_{side}"] = d_gates.sum(axis=0)
        slope[f"word_{side}"] = vectors.T @ d_gates
        slope[f"char_{side}"] = chars.T @ d_gates
        d_word += _sum_rows(d_gates @ w[f"word_{side}"].T, number, len(d_word))
        d_chars += d_gates @ w[f"char_{side}"].T
    d_word[-1] = 0
    slope["word"] = d_word
    sizes = np.diff(words.slot_bounds)
    slope["char"] = _sum_rows(np.repeat(d_chars / np.maximum(sizes, 1)[:, None], sizes, axis=0), words.slots, CHAR_SLOTS)
    return slope


def _sum_rows(values: np.ndarray, groups: np.ndarray, n: int) -> np.ndarray:
    """Sum of the rows of each of ``n`` groups."""
    out = np.zeros((n, values.shape[1]), np.float32)
    if len(groups):
        order = np.argsort(groups, kind="stable")
        at = np.flatnonzero(np.diff(groups[order], prepend=-1))
        out[groups[order[at]]] = np.add.reduceat(values[order], at, axis=0)
    return out


def train(texts: Sequence[str | None], labels: Sequence[int], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Learn from windows under the label of their text, then calibrate on whole texts.

    At first every window of a text with label 1 counts half; from the third epoch on only the two that score highest
    count, since the others need not hold anything toxic. Texts that occur several times are learned from once. The same texts in the same order give the same network. Without texts of both labels the scores are those of the share of label 1.
    """
    once = {(t or "", y): None for t, y in zip(texts, labels)}
    texts = [t for t, _ in once]
    labels = np.asarray([y for _, y in once], np.float32)
    data, offsets = flat(pa.array(texts, pa.string()))
    words = Words.of(data, offsets)
    counts = np.diff(words.bounds)
    owner = np.repeat(np.arange(len(counts)), counts)
    pairs = np.unique(words.place.astype(np.int64) * len(counts) + owner) if len(counts) else np.zeros(0, np.int64)
    spread = np.bincount(pairs // max(1, len(counts)), minlength=len(words.hashes))
    frequent = np.flatnonzero(spread >= LEAST_TEXTS)
    frequent = frequent[np.argsort(-spread[frequent], kind="stable")[:VOCABULARY]]
    net = Network.new(np.sort(words.hashes[frequent]), seed)
    rows, firsts, sizes = words.windows()
    target = labels[rows] if len(rows) else labels[:0]
    if len(set(labels.tolist())) > 1 and len(rows):
        rng = np.random.default_rng(seed)
        first, second = ({k: np.zeros_like(v) for k, v in net.weights.items()} for _ in range(2))
        steps = 0
        for epoch in range(epochs):
            weight = np.where(target == 1, 0.5, 1.0)
            if epoch >= 2:
                best = np.lexsort((-net.window_odds(words)[1], rows))
                rank = np.arange(len(best)) - np.searchsorted(rows[best], rows[best])
                weight = np.ones(len(rows))
                weight[best[(rank >= 2) & (target[best] == 1)]] = 0
            order = np.flatnonzero(weight)
            order = order[rng.permutation(len(order))]
            for i in range(0, len(order), BATCH):
                part = order[i : i + BATCH]
                time = np.arange(sizes[part].max())[:, None]
                there = time < sizes[part]
                place = words.place[np.minimum(firsts[part] + time, len(words.place) - 1)]
                used, place = np.unique(place, return_inverse=True)
                here = Words(words.hashes[used], place.ravel(), words.bounds, *_slots(words, used))
                number, chars = net.inputs(here)
                number = np.where(rng.random(len(number)) < DROPPED, len(net.known), number)
                slope = gradients(net, here, number, chars, place.reshape(there.shape), there, target[part], weight[part])
                steps += 1
                for k in ("word", "char"):
                    net.weights[k] = net.weights[k] * np.float32(1 - RATE * DECAY)
                for k, g in slope.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    net.weights[k] = (net.weights[k] - RATE * (first[k] / (1 - 0.9**steps)) / (np.sqrt(second[k] / (1 - 0.999**steps)) + 1e-6)).astype(np.float32)
    odds = np.concatenate([net.text_odds(d, o) for _, _, d, o in pieces(data, offsets)]) if len(labels) else np.zeros(0)
    net.slope, net.shift = _calibrate(odds, labels)
    return net


def _slots(words: Words, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(words.slot_bounds)[used]
    return words.slots[ranges(words.slot_bounds[:-1][used], sizes)], np.concatenate([[0], np.cumsum(sizes)])


def _calibrate(odds: np.ndarray, labels: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Slope and shift of a logistic curve over the odds of texts, by damped Newton steps."""
    if not len(odds):
        return 1.0, 0.0
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * odds + b)
        g = np.array([((p - labels) * odds).sum() + 1e-2 * a, (p - labels).sum() + 1e-3 * b])
        v = p * (1 - p)
        curve = np.array([[(v * odds * odds).sum() + 1e-2, (v * odds).sum()], [(v * odds).sum(), v.sum() + 1e-3]])
        step = np.linalg.solve(curve, g)
        step /= max(1.0, np.abs(step).max())
        a, b = a - step[0], b - step[1]
    return float(max(a, 0.0)), float(b)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", sample: int = SAMPLE, longest: int = LONGEST) -> Network:
    """Train on at most ``sample`` labelled texts of each label, the first by a hash of their key.

    Those of them longer than ``longest`` bytes are left out, as are labels other than 0 and 1. The keys are picked before any text is read, so
    what is broadcast and what reaches the driver are bounded by the two parameters.
    """
    picked = [hash_sample(labels.filter(F.col(label) == y).select(key, F.lit(y).alias("__label")), key, sample).distinct() for y in (0, 1)]
    found = docs.select(key, F.col(text).alias("__text")).join(F.broadcast(picked[0].unionByName(picked[1])), key)
    found = found.filter(F.coalesce(F.octet_length("__text"), F.lit(0)) <= longest).dropDuplicates([key, "__label"])
    rows = sorted(((r["__label"], zlib.crc32(str(r[key]).encode()), str(r[key]), r["__text"]) for r in found.collect()), key=lambda r: r[:3])
    return train([r[3] for r in rows], [r[0] for r in rows])


def score(docs: DataFrame, network: Network, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``score`` (double, 0 to 1) to every row, from the text alone.

    NULL and empty texts score as a text without evidence. Repeated rows score the same, an empty table stays empty, a column called
    like the new one is replaced. The network is broadcast; its size is bounded by its vocabulary.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def compute(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        return [shared.value.scores(data, offsets)]

    return with_text_columns(docs, text, [StructField("score", DoubleType())], compute, keep)
