"""Language-model scores from a probabilistic suffix tree over words, A-Z as a-z.

The states of the tree are contexts of up to two words. A context is a candidate if it occurs ``LEAST_OCCURRENCES`` times, however large the corpus, and is
retained if it tells more about the next word than its own suffix does: the log-likelihood of what follows it in the training texts, each
occurrence left out of its own estimate, must gain ``GAIN`` bits over the suffix. The next-word distribution of a state takes
``DISCOUNT`` off every count and gives that mass to the distribution of its suffix; the empty context has the
smoothed word frequencies. A word is scored in the state of the longest retained suffix of what precedes it in its text.

All counts are over the whole training part. Words and contexts are known by 64 bits of hash. Chunks of documents ask slices of
the key space for totals (``bazar.llm.exchange``): words first, then for each length of context the sequences, the mass of contexts, and their gain. Each length starts a round
after the one below, when the occurrences of its contexts are known.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from bazar.llm import exchange
from bazar.llm.simhash import LOWER
from bazar.llm.tables import stored
from bazar.llm.text import content_hashes, distinct, flat, mix, pieces, word_spans

FOLDS = 10
LENGTHS = (1, 2)
# Training occurrences a context must have itself.
LEAST_OCCURRENCES = 10
DISCOUNT = 0.75
GAIN = 8.0
END = np.uint64(0x5E2D8A7C61F3B94D)

WORD, SEQUENCE, MASS, BENEFIT, TOTAL = 0, 10, 20, 30, 99
# values per key, by kind of question; answers have the same but for the types of a context, which are whole in all
KINDS = {WORD: (np.int64,), SEQUENCE: (np.int64,), MASS: (np.int64, np.float64), BENEFIT: (np.float64,)}
COLUMNS = [
    StructField("held_out", BooleanType()),
    *(StructField(n, LongType()) for n in ("n_tokens", "n_known", "train_tokens")),
    StructField("base_score", DoubleType()),
    StructField("score", DoubleType()),
]


def held_out(doc: int | None, folds: int = FOLDS) -> bool:
    """Whether a document is kept from training; one without a key is not."""
    return doc is not None and zlib.crc32(str(doc).encode()) % folds == 0


def least_count(length: int, trained: int) -> int:
    """Training occurrences a word of a sequence must have: any known word takes part, at every length and size."""
    return 1


@dataclass
class Tokens:
    """The tokens of a chunk, each document followed by an end token."""

    words: np.ndarray  # distinct, sorted
    place: np.ndarray  # of every token, its word
    bounds: np.ndarray  # first token of every document
    trains: np.ndarray  # for every token

    @classmethod
    def of(cls, chunk: pa.Table) -> Tokens:
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, _, data, offsets in pieces(*flat(chunk["text"])):
            data = LOWER[data]
            starts, ends, bounds = word_spans(data, offsets)
            hashes.append(content_hashes(data, starts, ends))
            counts.append(np.diff(bounds))
        counts = np.concatenate(counts)
        tokens = np.insert(np.concatenate(hashes), np.cumsum(counts), END)
        words, place = distinct(tokens)
        trains = ~np.array([held_out(d) for d in chunk["doc"].to_pylist()], bool)
        return cls(words, place, np.concatenate([[0], np.cumsum(counts + 1)]), np.repeat(trains, counts + 1))


@dataclass
class Level:
    """Sequences of one context length: distinct ones and contexts, and the tokens that complete them."""

    length: int
    at: np.ndarray  # tokens whose context is a candidate
    context: np.ndarray  # for each of them its context
    contexts: np.ndarray  # hashes, distinct and sorted
    occurrences: np.ndarray  # training occurrences of each
    full: np.ndarray  # which of the tokens are known words
    sequence: np.ndarray  # for those, their sequence
    sequences: np.ndarray  # hashes, distinct and sorted
    local: np.ndarray  # training occurrences in the chunk of each sequence

    @classmethod
    def of(cls, tokens: Tokens, counts: np.ndarray, ending: np.ndarray, below: Level | None, trained: int) -> Level:
        """``ending`` has for every token the training occurrences of the context that ends there: a sequence of the level ``below``, or a word."""
        length = below.length + 1 if below else 1
        known = (counts >= least_count(length, trained))[tokens.place]
        at = np.arange(len(tokens.place))
        at = at[at - np.repeat(tokens.bounds[:-1], np.diff(tokens.bounds)) >= length]
        at = at[ending[at - 1] >= LEAST_OCCURRENCES]
        # contexts are distinct and sorted already, where they are counted
        found, place = (below.sequences, below.completed(len(tokens.place))) if below else (tokens.words, tokens.place)
        place = place[at - 1]
        often = np.zeros(len(found), np.int64)
        often[place] = ending[at - 1]
        used = often > 0
        contexts, occurrences, context = found[used], often[used], (np.cumsum(used) - 1)[place]
        full = known[at]
        hashes = mix(contexts[context[full]] * np.uint64(0xC2B2AE3D27D4EB4F) + tokens.words[tokens.place[at[full]]])
        sequences, sequence = distinct(hashes)
        local = np.bincount(sequence, weights=tokens.trains[at[full]], minlength=len(sequences)).astype(np.int64)
        return cls(length, at, context, contexts, occurrences, full, sequence, sequences, local)

    def completed(self, tokens: int) -> np.ndarray:
        """For every token the sequence it completes; 0 where there is none."""
        out = np.zeros(tokens, np.int64)
        out[self.at[self.full]] = self.sequence
        return out

    def shorter(self) -> np.ndarray:
        """For every sequence one token that completes it."""
        first = np.zeros(len(self.sequences), np.int64)
        first[self.sequence] = self.at[self.full]
        return first


def _small(values: np.ndarray) -> list[np.ndarray]:
    """Counts as one byte each, those from 255 on listed behind; other values as they are."""
    if values.dtype != np.int64:
        return [values]
    return [np.minimum(values, 255).astype(np.uint8), values[values >= 255]]


def _values(payload: bytes, kinds: tuple[type, ...], keyed: bool = False) -> list[np.ndarray]:
    """What ``_small`` made of the values of each kind, behind keys if there are any."""
    types = [t for kind in kinds for t in ((np.uint8, np.int64) if kind is np.int64 else (kind,))]
    parts = iter(exchange.unpack(payload, *([np.uint64] * keyed), *types))
    out = [next(parts)] if keyed else []
    for kind in kinds:
        value = next(parts)
        if kind is np.int64:
            value, large = value.astype(np.int64), next(parts)
            value[value == 255] = large
        out.append(value)
    return out


def _ask(chunk: int, tag: int, slices: int, keys: np.ndarray, *values: np.ndarray):
    """Messages with sorted keys and a value of each kind per key."""
    cuts = exchange.slice_cuts(keys, slices)
    for s, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            yield s, chunk, tag, exchange.pack(keys[a:b], *(part for v in values for part in _small(v[a:b])))


def _totals(asked: list[exchange.Message]):
    """Answers with the totals over all chunks, in the order of the keys; the values are summed in a fixed order."""
    for tag in sorted({m[2] for m in asked}):
        kinds = KINDS[tag // 10 * 10]
        mine = [(m, _values(m[3], kinds, keyed=True)) for m in asked if m[2] == tag]
        keys, place = distinct(np.concatenate([part[0] for _, part in mine]))
        sums = []
        for i, kind in enumerate(kinds, 1):
            total = np.zeros(len(keys), kind)
            np.add.at(total, place, np.concatenate([part[i] for _, part in mine]))
            sums.append(total)
        if tag // 10 * 10 == MASS:  # the shares of a type add up to one
            sums[1] = np.rint(sums[1]).astype(np.int64)
        at = 0
        for (s, chunk, _, _), part in mine:
            own = place[at : at + len(part[0])]
            at += len(own)
            yield s, chunk, tag, exchange.pack(*(part for t in sums for part in _small(t[own])))
        if tag == WORD:
            yield mine[0][0][0], -1, TOTAL, exchange.pack(np.array([(sums[0] > 0).sum(), sums[0].sum()], np.int64))


def _heard(answers: dict[int, list[bytes]], tag: int, size: int, *kinds) -> list[np.ndarray]:
    parts = [_values(p, kinds) for p in answers.get(tag, [])]
    out = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, k) for i, k in enumerate(kinds)]
    if any(len(o) != size for o in out):
        raise RuntimeError("the chunk was not read twice alike")
    return out


class Model:
    """What a chunk knows of the tree after some rounds."""

    def __init__(self, chunk: pa.Table, answers: dict[int, list[bytes]], known: int, trained: int):
        self.tokens = Tokens.of(chunk)
        (self.counts,) = _heard(answers, WORD, len(self.tokens.words), np.int64)
        self.root = ((self.counts + 0.1) / (trained + 0.1 * (known + 1)))[self.tokens.place]
        self.levels, self.seen, self.mass, self.types, self.gain = [], {}, {}, {}, {}
        ending = self.counts[self.tokens.place]
        for n in LENGTHS:
            level = Level.of(self.tokens, self.counts, ending, self.levels[-1] if self.levels else None, trained)
            self.levels.append(level)
            if len(level.sequences) and SEQUENCE + n not in answers:
                break  # not asked yet, so no longer context is known
            (self.seen[n],) = _heard(answers, SEQUENCE + n, len(level.sequences), np.int64)
            ending = self._seen_at(level)
            if MASS + n in answers:
                self.mass[n], self.types[n] = _heard(answers, MASS + n, len(level.contexts), np.int64, np.int64)
            if BENEFIT + n in answers:
                (self.gain[n],) = _heard(answers, BENEFIT + n, len(level.contexts), np.float64)

    def _seen_at(self, level: Level) -> np.ndarray:
        """For every token the training occurrences of the sequence it completes, 0 if that is no candidate."""
        out = np.zeros(len(self.tokens.place), np.int64)
        if level.length in self.seen:
            out[level.at[level.full]] = self.seen[level.length][level.sequence]
        return out

    def back_off(self, level: Level) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of every context and the share of its mass that goes to its suffix."""
        n = level.occurrences
        kept = self.mass[level.length] - DISCOUNT * self.types[level.length]
        return n, np.clip(1 - kept / np.maximum(n, 1), 0, 1)

    def below(self, level: Level) -> np.ndarray:
        """Probability of every token in the context one shorter, as the tests see it."""
        return self.root if level.length == 1 else self.probabilities(self.levels[level.length - 2], self.below(self.levels[level.length - 2]), None)

    def probabilities(self, level: Level, suffix: np.ndarray, retained: np.ndarray | None) -> np.ndarray:
        """Probability of every token: in its context of this length where that is retained (all contexts, if None), else that of ``suffix``."""
        if level.length not in self.mass or not len(level.at):
            return suffix
        n, share = self.back_off(level)
        usable = np.ones(len(n), bool) if retained is None else retained
        seen = self._seen_at(level)[level.at]
        own = np.maximum(seen - DISCOUNT, 0) / np.maximum(n, 1)[level.context] + share[level.context] * suffix[level.at]
        out = suffix.copy()
        use = usable[level.context]
        out[level.at[use]] = own[use]
        return out

    def gains(self, level: Level) -> np.ndarray:
        """What the training tokens of this chunk add to the gain of every context."""
        n, share = self.back_off(level)
        first = level.shorter()
        place = np.zeros(len(self.tokens.place), np.int64)
        place[level.at] = level.context
        context, parent = place[first], self.below(level)[first]
        seen = self.seen[level.length]
        own = np.maximum(seen - 1 - DISCOUNT, 0) / np.maximum(n[context] - 1, 1) + share[context] * parent
        bits = level.local * np.log2(np.maximum(own, 1e-300) / np.maximum(parent, 1e-300))
        return np.bincount(context, weights=bits, minlength=len(level.contexts))

    def retained(self, level: Level) -> np.ndarray:
        n, share = self.back_off(level)
        rest = np.maximum(n - self.mass[level.length], 0) * np.log2(np.maximum(share, 1e-300))
        return self.gain[level.length] + rest >= GAIN

    def scores(self) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of every token under the word frequencies and under the tree."""
        best = self.root
        for level in self.levels:
            if level.length in self.gain:
                best = self.probabilities(level, best, self.retained(level))
        return np.log10(self.root), np.log10(best)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add the columns of ``COLUMNS`` to every row: ``held_out``, ``n_tokens``, ``n_known`` (tokens the training part has),
    ``train_tokens``, ``base_score`` (word frequencies alone) and ``score`` (the tree), both log10 of the probability of the text.

    Rows with crc32(key as text) mod 10 = 0 are held out, all others are learned from; a NULL key is learned from. NULL and empty texts are one
    end token. Repeated rows count as often as they occur and score alike. With nothing to learn from all words are equally unknown. An empty table stays empty. Columns
    called like the new ones are replaced.
    """
    names = [f.name for f in COLUMNS]
    kept = [c for c in docs.columns if c not in names]
    chunks = exchange.chunked(docs, key, text, carry=kept)
    plain, slices = chunks.rows.drop("row"), chunks.count

    def words(chunk: int, table: pa.Table):
        tokens = Tokens.of(exchange.in_order(table))
        counts = np.bincount(tokens.place, weights=tokens.trains, minlength=len(tokens.words)).astype(np.int64)
        return _ask(chunk, WORD, slices, tokens.words, counts)

    answers = stored(exchange.answer(exchange.ask(plain, words), _totals))

    def parse(batches):
        for batch in batches:
            values = [exchange.unpack(p.as_py(), np.int64)[0] for p in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([int(v[i]) for v in values], pa.int64()) for i in (0, 1)], names=["known", "trained"])

    sums = answers.filter(F.col("tag") == TOTAL).select("payload").mapInArrow(parse, "known bigint, trained bigint")
    known, trained = (int(v or 0) for v in sums.agg(F.sum("known"), F.sum("trained")).first())

    def turn(number: int):
        """One more round: what the chunks ask, given all answers so far."""

        def run(chunk: int, table: pa.Table, heard: list[exchange.Message]) -> pa.Table:
            if chunk < 0:
                return exchange.messages([])
            model = Model(exchange.in_order(table), exchange.by_tag(heard), known, trained)
            steps = ((number - level.length, level) for level in model.levels)
            return exchange.messages(m for step, level in steps if 0 <= step < len(asking) for m in asking[step](chunk, model, level))

        return stored(exchange.answer(exchange.hear(plain, answers, run, exchange.MESSAGE), _totals))

    def sequences(chunk: int, model: Model, level: Level):
        return _ask(chunk, SEQUENCE + level.length, slices, level.sequences, level.local)

    def masses(chunk: int, model: Model, level: Level):
        seen = model.seen.get(level.length, np.zeros(0, np.int64))
        place = np.zeros(len(model.tokens.place), np.int64)
        place[level.at] = level.context
        context = place[level.shorter()]
        mass = np.bincount(context, weights=level.local, minlength=len(level.contexts)).astype(np.int64)
        # every sequence counts as one type, in the shares of the chunks that have it
        types = np.bincount(context, weights=level.local / np.maximum(seen, 1), minlength=len(level.contexts))
        return _ask(chunk, MASS + level.length, slices, level.contexts, mass, types)

    def benefits(chunk: int, model: Model, level: Level):
        gains = model.gains(level) if len(level.sequences) else np.zeros(len(level.contexts))
        return _ask(chunk, BENEFIT + level.length, slices, level.contexts, gains)

    asking = (sequences, masses, benefits)
    for number in range(LENGTHS[0], LENGTHS[-1] + len(asking)):
        answers = answers.unionByName(turn(number))
    schema = StructType([chunks.rows.schema["row"], *COLUMNS])

    def finish(chunk: int, table: pa.Table, heard: list[exchange.Message]) -> pa.Table:
        if chunk < 0:
            return pa.table([table["row"], *(pa.array([], t) for t in (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=["row", *names])
        if "text" not in table.column_names:
            table = table.append_column("text", table["row"].combine_chunks().field(text))
        table = exchange.in_order(table)
        model = Model(table, exchange.by_tag(heard), known, trained)
        tokens, first = model.tokens, model.tokens.bounds[:-1]
        base, best = model.scores()
        seen = (model.counts > 0)[tokens.place]
        made = [
            pa.array(~tokens.trains[first]),
            pa.array(np.diff(tokens.bounds), pa.int64()),
            pa.array(np.add.reduceat(seen.astype(np.int64), first), pa.int64()),
            pa.array(np.full(len(first), trained), pa.int64()),
            pa.array(np.add.reduceat(base, first)),
            pa.array(np.add.reduceat(best, first)),
        ]
        return pa.table([table["row"], *made], names=["row", *names])

    # the text is in the row already
    whole = chunks.rows.drop("text") if text in kept else chunks.rows
    done = exchange.hear(whole, answers, finish, schema)
    return done.select(*[F.col("row").getField(c).alias(c) for c in kept], *names)
