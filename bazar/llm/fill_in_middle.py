"""Fill-in-the-middle: a document's lines are cut at two random ranks and the middle part is moved to the end.

The lines of a text form an indexable skip list. Every line has a height drawn from a hash of its place; lane k links the lines of height k
and more, and each link carries how many lines, code points and bytes it passes. A cut at a rank is found from the top lane: go along a link while
the lines it passes do not exceed what is left of the rank, else go one lane down. The widths passed add up to the place of the cut in code points and bytes.
All texts of a piece share one list: the first line of every text is in all lanes, so no link passes the end of a text, and all cuts descend together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bazar.llm.text import flat, mix, pieces

SEED = 7
# The marks before the three parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Of 100 documents, so many are transformed, and so many of those begin with the suffix.
RATE = 100
SUFFIX_FIRST = 50
# A line is in the next higher lane with a chance of one in 2 ** LANE_BITS.
LANE_BITS = 2

FIELDS = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()), StructField("output", StringType())]


@dataclass(frozen=True)
class SkipList:
    """Lanes from the lowest up: ``widths[k][i]`` is what link i of lane k passes in each measure, the first of them lines;
    ``down[k][i]`` is the place of its line in the lane below. One entry more than there are links stands for the end."""

    widths: list[np.ndarray]
    down: list[np.ndarray]

    @classmethod
    def of(cls, widths: np.ndarray, heads: np.ndarray) -> SkipList:
        """From the widths of the units, a row each, and the units that begin a list, the first one included."""
        h = mix(np.arange(len(widths), dtype=np.uint64) + np.uint64(1))
        height = np.zeros(len(widths), np.int64)
        for k in range(1, 64 // LANE_BITS):
            height += h & np.uint64((1 << LANE_BITS * k) - 1) == 0
        height[heads] = 64
        lanes, down = [widths], [np.zeros(0, np.int64)]
        while len(lanes[-1]) > len(heads):
            up = np.flatnonzero(height >= len(lanes))
            down.append(np.append(up, len(lanes[-1])))
            lanes.append(np.add.reduceat(lanes[-1], up, axis=0))
            height = height[up]
        return cls(lanes, down)

    def passed(self, lists: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Widths before unit ``ranks[i]`` of list ``lists[i]``; a rank is at most the length of its list."""
        at, left = lists.copy(), ranks.copy()
        out = np.zeros((len(ranks), self.widths[0].shape[1]), np.int64)
        for lane in reversed(range(len(self.widths))):
            widths = self.widths[lane]
            going = np.flatnonzero(left > 0)
            while len(going):
                step = widths[at[going]]
                fits = step[:, 0] <= left[going]
                going, step = going[fits], step[fits]
                out[going] += step
                left[going] -= step[:, 0]
                at[going] += 1
                going = going[left[going] > 0]
            if lane:
                at = self.down[lane][at]
        return out


def line_cuts(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines of every text, and for both cuts of each the (lines, code points, bytes) before it: shape (2, rows, 3)."""
    opens = np.zeros(len(data) + 1, bool)
    opens[1:] = data == 0x0A
    opens[offsets] = True
    starts = np.flatnonzero(opens[:-1])
    first = np.searchsorted(starts, offsets)
    n = np.diff(first)
    cuts = np.zeros((2, len(n), 3), np.int64)
    some = np.flatnonzero(n)
    if len(some):
        points = np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)
        lanes = SkipList.of(np.stack([np.ones_like(starts), points, np.diff(starts, append=len(data))], axis=1), first[:-1][some])
        ranks = np.sort(np.stack([h1[some] % (n[some] + 1), h2[some] % (n[some] + 1)]), axis=0)
        both = lanes.passed(np.tile(np.arange(len(some)), 2), ranks.ravel())
        cuts[:, some] = both.reshape(2, len(some), 3)
    return n, cuts


def _number(digest: Column, place: int) -> Column:
    """The ``place``-th group of eight hex digits as an unsigned number."""
    return F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("bigint")


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, keep: Sequence[str] | None = None
) -> DataFrame:
    """Add ``n`` (lines), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` (NULL if plain) and ``output``.

    A line ends after its line feed; the last one may have none. The cuts come from a hash of seed and key alone: rows that repeat a key are cut by the
    same numbers, a NULL key counts as empty text. Both cuts may fall together or at an end, which leaves parts empty. NULL and empty texts, and those that
    hold one of the marks, stay as they are (plain; NULL becomes the empty text). Rows are independent, an empty table stays empty. Input columns called
    like the new ones are replaced; ``keep`` names the input columns to return, all by default. Nothing is shuffled.
    """
    names = [f.name for f in FIELDS]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    source = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("text"), *(_number(digest, i).alias(f"h{i + 1}") for i in range(4)))
    row = source.schema["row"]
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(1))
            h = [batch.column(2 + i).to_numpy() for i in range(4)]
            for lo, hi, part, bounds in pieces(data, offsets):
                n, cuts = line_cuts(part, bounds, h[0][lo:hi], h[1][lo:hi])
                whole = part.tobytes()
                form, prefix_chars, middle_chars, output = [], [], [], []
                for i in range(hi - lo):
                    body = whole[bounds[i] : bounds[i + 1]]
                    if not body or h[2][lo + i] % 100 >= rate or any(m in body for m in marks):
                        form.append("plain")
                        prefix_chars.append(None)
                        middle_chars.append(None)
                        output.append(body)
                        continue
                    (_, chars_1, bytes_1), (_, chars_2, bytes_2) = cuts[:, i].tolist()
                    prefix, middle, suffix = body[:bytes_1], body[bytes_1:bytes_2], body[bytes_2:]
                    first = h[3][lo + i] % 100 < suffix_first
                    form.append("spm" if first else "psm")
                    prefix_chars.append(chars_1)
                    middle_chars.append(chars_2 - chars_1)
                    parts = (marks[1], suffix, marks[0], prefix) if first else (marks[0], prefix, marks[1], suffix)
                    output.append(b"".join((*parts, marks[2], middle)))
                made = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix_chars, pa.int64()), pa.array(middle_chars, pa.int64()), pa.array(output, pa.binary()).cast(pa.string(), safe=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *made], names=["row", *names])

    return source.mapInArrow(run, StructType([row, *FIELDS])).select(*(["row.*"] if kept else []), *names)


def restored(output: str = "output", form: str = "form") -> Column:
    """The text an output was made of, from the output and its form alone: no part holds a mark, so each is found where it first occurs."""
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    second = F.when(F.col(form) == "psm", SUFFIX).otherwise(PREFIX)
    one, rest = F.split_part(body, second, F.lit(1)), F.split_part(body, second, F.lit(2))
    two, middle = F.split_part(rest, F.lit(MIDDLE), F.lit(1)), F.split_part(rest, F.lit(MIDDLE), F.lit(2))
    text = F.when(F.col(form) == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(text)
