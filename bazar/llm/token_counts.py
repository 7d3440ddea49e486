"""Token counts without tokens: best unigram segmentation, of which only score and length are kept.

An Aho-Corasick automaton over the vocabulary yields, for every end position of a text, the pieces
that end there, longest first. The forward pass of Viterbi carries two numbers per position, the best
score and the number of pieces of that path; no piece is stored and nothing is traced back.

Rules kept from the exact tokenizer (a unigram model with byte fallback):
* spaces become the word mark, and a mark is put before the text;
* of two paths with the same score the one whose last piece is longer wins;
* a character that is no piece of its own may be passed at 10 below the worst score of the
  vocabulary, and counts one token per UTF-8 byte.

If a word mark never follows another character inside a piece, no piece spans the place before a
mark. The best path is then made of the best paths of the words between those places, and a word is
segmented once per task however often it occurs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

MARK = "▁"
UNKNOWN_PENALTY = 10.0
# Distinct words a task remembers; it starts anew beyond that.
MEMORY = 400_000
# Longer words are not remembered.
REMEMBERED_CHARS = 64

FIELDS = [StructField("n_tokens", LongType()), StructField("token_score", DoubleType())]


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that may occur in a text, with their scores; byte and control pieces are left out."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        return cls(tuple(model.id_to_piece(i) for i in ids), tuple(model.get_score(i) for i in ids))


class Counter:
    """Counts and scores texts under one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in zip(vocabulary.pieces, vocabulary.scores):
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(vocabulary.scores) - UNKNOWN_PENALTY
        self.splits = not any(re.search(f"[^{MARK}]{MARK}", piece) for piece in vocabulary.pieces)
        self.memory: dict[str, tuple[int, float]] = {}

    def segment(self, text: str) -> tuple[int, float]:
        """Piece count and score of the best path over an already marked text."""
        best: list[float | None] = [None] * (len(text) + 1)
        count = [0] * (len(text) + 1)
        best[0] = 0.0
        done, single = 0, False
        for last, (size, score) in self.automaton.iter(text):
            end = last + 1
            while done < end - 1:  # positions the automaton has passed: settle unknown characters
                self._step(text, best, count, done, single)
                done, single = done + 1, False
            start = best[end - size]
            if size == 1:
                single = True
            if start is not None and (best[end] is None or start + score > best[end]):
                best[end], count[end] = start + score, count[end - size] + 1
        while done < len(text):
            self._step(text, best, count, done, single)
            done, single = done + 1, False
        return count[-1], best[-1]

    def _step(self, text: str, best: list, count: list, at: int, single: bool) -> None:
        """After all pieces ending behind character ``at``: the unknown step, if it is no piece."""
        if not single:
            score = best[at] + self.unknown
            if best[at + 1] is None or score > best[at + 1]:
                best[at + 1], count[at + 1] = score, count[at] + len(text[at].encode())

    def word(self, word: str) -> tuple[int, float]:
        found = self.memory.get(word)
        if found is None:
            found = self.segment(word)
            if len(word) <= REMEMBERED_CHARS:
                if len(self.memory) >= MEMORY:
                    self.memory.clear()
                self.memory[word] = found
        return found

    def count(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = MARK + text.replace(" ", MARK)
        if not self.splits:
            return self.segment(marked)
        tokens, total, word = 0, 0.0, self.word
        for unit in re.findall(f"{MARK}+[^{MARK}]*", marked):
            n, score = word(unit)
            tokens += n
            total += score
        return tokens, total


@lru_cache(maxsize=2)
def _counter(vocabulary: Vocabulary) -> Counter:
    return Counter(vocabulary)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``n_tokens`` (long) and ``token_score`` (double) for every row.

    NULL and empty texts have 0 tokens and score 0. Rows are independent: repeated rows are counted
    each, an empty table stays empty. Input columns called like the new ones are replaced.
    ``keep`` names the input columns to return, all by default.
    """
    names = [f.name for f in FIELDS]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # the size of the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            found = [counter.count(t.as_py()) for t in batch.column(batch.schema.get_field_index(text))]
            made = [pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *made], names=[*kept, *names])

    return docs.select(*dict.fromkeys([*kept, text])).mapInArrow(run, StructType([*(docs.schema[c] for c in kept), *FIELDS]))
