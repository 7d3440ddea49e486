"""Language identification by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; what is neither a letter nor a mark is a space. n-grams of one to four characters lie within a word and may take the space before and
after it. Each falls into one of a fixed number of buckets by a hash. The counts of buckets per language, over all rows learned from, give a matrix
of smoothed log probabilities, which is broadcast; a text is a sparse row of bucket counts, and its product with the matrix, plus the log share of the language's
documents, decides.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from bazar.llm.tables import stored
from bazar.llm.text import flat, mix, pieces

LONGEST = 4
BUCKET_BITS = 16
SMOOTHING = 0.5
UNKNOWN = "und"
# Languages in one broadcast matrix, of 4 * 2 ** BUCKET_BITS bytes each, and in the counts a task holds; more languages are more passes.
LANGUAGES_AT_ONCE = 64
# Characters hashed at once.
BLOCK = 1 << 18
DOCUMENTS = -1
SPACE = 0x20

_STEP = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """2 for letters, 1 for marks, 0 for all other code points."""
    rank = {"L": 2, "M": 1}
    return np.array([rank.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


@dataclass(frozen=True)
class Grams:
    """Code points of the rows of a piece, each between two spaces, the row of each, and which rows hold a letter."""

    points: np.ndarray
    row: np.ndarray
    letters: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray, bounds: np.ndarray) -> Grams:
        raw = data.tobytes()
        texts = [raw[a:b].decode("utf-8", "replace").lower() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        row = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 2 for t in texts])
        points = np.frombuffer(f" {'  '.join(texts)} ".encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        kinds = _kinds()[points]
        letters = np.zeros(len(texts), bool)
        letters[row[kinds == 2]] = True
        points[kinds == 0] = SPACE
        return cls(points, row, letters)

    def buckets(self, longest: int, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, buckets) of all n-grams, block by block."""
        for a in range(0, len(self.points), BLOCK):
            points = self.points[a : a + BLOCK + longest - 1].astype(np.uint64)
            inside = points != SPACE
            size = min(BLOCK, len(self.points) - a)
            row, code, within = self.row[a : a + size], points[:size].copy(), inside[:size]
            for n in range(1, longest + 1):
                size = min(size, len(points) - n + 1)
                if n > 1:
                    code = (code[:size] + np.uint64(1)) * _STEP + points[n - 1 : n - 1 + size]
                # the characters between the first and the last are of one word
                if n == 2:
                    valid = inside[:size] | inside[1 : size + 1]
                else:
                    within = within[:size] if n == 1 else inside[1 : size + 1] if n == 3 else within[:size] & inside[n - 2 : n - 2 + size]
                    valid = within
                at = np.flatnonzero(valid)
                yield row[at], (mix(code[at] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int64)


def bucket_counts(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, bits: int = BUCKET_BITS) -> DataFrame:
    """(lang, bucket, n) over all rows with a language; bucket ``DOCUMENTS`` counts the rows. A task sends one row per language and bucket it met."""
    source = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    schema = StructType([StructField("lang", StringType()), StructField("bucket", IntegerType()), StructField("n", LongType())])

    def sent(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for name, found in counts.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at - 1, pa.int32()), pa.array(found[at], pa.int64())], names=schema.names)
        counts.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, part, bounds in pieces(*flat(batch.column(1))):
                present, which = np.unique(names[lo:hi], return_inverse=True)
                grams = Grams.of(part, bounds)
                for first in range(0, len(present), LANGUAGES_AT_ONCE):
                    some = present[first : first + LANGUAGES_AT_ONCE]
                    if len(counts.keys() | set(some)) > LANGUAGES_AT_ONCE:
                        yield from sent(counts)
                    for name in some:
                        counts.setdefault(name, np.zeros((1 << bits) + 1, np.int64))
                    for i, name in enumerate(some, first):
                        counts[name][DOCUMENTS + 1] += np.count_nonzero(which == i)
                    for rows, buckets in grams.buckets(longest, bits):
                        of = which[rows]
                        for i, name in enumerate(some, first):
                            counts[name][1:] += np.bincount(buckets[of == i], minlength=1 << bits)
        yield from sent(counts)

    return source.mapInArrow(run, schema).groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """Row ``lang`` of ``rows`` (lang, documents, weights): float32 log probabilities of all buckets. ``languages`` in order."""

    rows: DataFrame
    languages: list[str]
    documents: int
    longest: int
    bits: int

    def block(self, languages: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Names, log shares and matrix of some languages."""
        found = sorted(self.rows.filter(F.col("lang").isin(list(languages))).collect(), key=lambda r: r["lang"])
        shares = np.log([r["documents"] / self.documents for r in found])
        return [r["lang"] for r in found], shares, np.stack([np.frombuffer(r["weights"], np.float32) for r in found])


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, bits: int = BUCKET_BITS, smoothing: float = SMOOTHING) -> Model:
    """Learn from every row with a language; NULL and empty texts count as documents of it. No row at all gives a model that knows no language."""
    schema = "lang string, documents bigint, weights binary"

    def weigh(table: pa.Table) -> pa.Table:  # the buckets of one language
        bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
        counts = np.zeros((1 << bits) + 1)
        counts[bucket + 1] = n
        weights = np.log((counts[1:] + smoothing) / (counts[1:].sum() + smoothing * (1 << bits))).astype(np.float32)
        return pa.table([pa.array([table["lang"][0].as_py()]), pa.array([int(counts[0])], pa.int64()), pa.array([weights.tobytes()], pa.binary())], names=["lang", "documents", "weights"])

    rows = stored(bucket_counts(docs, text, lang, longest, bits).groupBy("lang").applyInArrow(weigh, schema))
    known = rows.select("lang", "documents").collect()
    return Model(rows, sorted(r["lang"] for r in known), sum(r["documents"] for r in known), longest, bits)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the posterior probability of that language.

    A text that is NULL or has no letter is ``und`` with score 0, and so is every text if no language was learned. Of equal languages the first by
    name wins. Rows are independent: repeated rows get the same answer, an empty table stays empty. Input columns called like the new ones are replaced; ``keep``
    names the input columns to return, all by default. One pass scores ``LANGUAGES_AT_ONCE`` languages, with their matrix broadcast; more languages are scored in further
    passes over a stored table that carries the best so far.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    state = [StructField("top", DoubleType()), StructField("lang_pred", StringType()), StructField("total", DoubleType())]
    df = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("text"), F.lit(None).cast("double").alias("top"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(None).cast("double").alias("total"))
    schema = StructType([*df.schema.fields[:2], *state])
    for first in range(0, len(model.languages), LANGUAGES_AT_ONCE):
        block = df.sparkSession.sparkContext.broadcast(model.block(model.languages[first : first + LANGUAGES_AT_ONCE]))
        df = (stored(df) if first else df).mapInArrow(_scorer(block, model.longest, model.bits, schema.names), schema)
    score = F.coalesce(F.exp(F.col("top") - F.col("total")), F.lit(0.0))
    return df.select(*(["row.*"] if kept else []), "lang_pred", F.least(score, F.lit(1.0)).alias("score"))


def _scorer(block, longest: int, bits: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, shares, matrix = block.value
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for lo, hi, part, bounds in pieces(data, offsets):
                grams = Grams.of(part, bounds)
                scores = np.tile(shares, (hi - lo, 1))
                for rows, buckets in grams.buckets(longest, bits):
                    for i, weights in enumerate(matrix):
                        scores[:, i] += np.bincount(rows, weights[buckets], minlength=hi - lo)
                best = scores.argmax(axis=1)
                top = scores[np.arange(hi - lo), best]
                total = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
                old_top, old_total = (np.where(np.isnan(v), -np.inf, v) for v in (batch.column(i).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(float) for i in (2, 4)))
                old_names = batch.column(3).slice(lo, hi - lo).to_pylist()
                total = np.logaddexp(total, old_total)
                chosen = [languages[b] if t > o else name for b, t, o, name in zip(best, top, old_top, old_names)]
                none = ~grams.letters
                made = [
                    pa.array(np.maximum(top, old_top), pa.float64(), mask=none),
                    pa.array([UNKNOWN if n else c for n, c in zip(none, chosen)], pa.string()),
                    pa.array(total, pa.float64(), mask=none),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *made], names=names)

    return run
