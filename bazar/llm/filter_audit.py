"""How five quality filters interact: what each removes in every order, and its Shapley share of all that goes.

Every document is reduced to the set of filters it fails. Per part of the corpus the removals of all 32 coalitions of filters are tabulated; a step of
an order is the difference of two of them. Shapley values are those of the exact constrained least squares fit: additive shares that come closest to the coalition
removals under the Shapley kernel's weights and add up to what all filters remove. The left side of its normal equations does not depend on the data, so they
are solved once, in rationals, for every right side, and a part's values are whole combinations of its removals.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import reduce
from itertools import permutations
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from bazar.llm.tables import stored
from bazar.llm.text import flat
from bazar.operators.joins import lookup_join

FILTERS = "ABCDE"
EVERY = (1 << len(FILTERS)) - 1
COPY = 1 << FILTERS.index("E")

# Fixed values of the filters
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_CAPITALS_PERCENT = 5
SYMBOLS = b"#$%&*|"

MEASURES = ("rows", "good", "toxic")


def own_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # bytes are split at the six ASCII white space characters only
    data = np.frombuffer(text, np.uint8)
    capitals = np.count_nonzero((data >= 0x41) & (data <= 0x5A))
    points = np.count_nonzero((data & 0xC0) != 0x80)
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words),
        100 * capitals > MOST_CAPITALS_PERCENT * points,
        any(s in text for s in SYMBOLS),
    )
    return sum(bit << i for i, bit in enumerate(failed))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``key``, ``part`` (NULL is the empty string), ``digest`` (SHA-256 of the text) and ``failed`` (bits of A to D) for every row."""
    source = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    schema = StructType([*source.schema.fields[:2], StructField("digest", BinaryType()), StructField("failed", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(2))
            digests, failed = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                body = data[a:b].tobytes()
                digests.append(hashlib.sha256(body).digest())
                failed.append(own_failures(body))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(failed, pa.int32())], names=schema.names)

    return source.mapInArrow(run, schema)


def failures(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Documents per ``part`` and set of failed filters: ``rows`` of them, those labelled ``good`` and those labelled ``toxic``.

    Copies are told by one row per text, its smallest key: rows that do not meet it fail E. Texts are shuffled as digests, and rows are met by
    (digest, key), so neither a text nor a part that a third of all rows have is ever one group.
    """
    slim = stored(ledger(docs, key, text, part).groupBy("key", "part", "digest", "failed").agg(F.count(F.lit(1)).alias("rows")))
    firsts = slim.groupBy("digest").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    flagged = [F.max((F.col(c) == 1).cast("int")).alias(name) for c, name in (("quality", "is_good"), ("toxic", "is_toxic"))]
    flags = labels.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(*flagged)
    met = lookup_join(slim, flags, "key").join(firsts, ["digest", "key"], "left")
    copy = F.when(F.col("key").isNotNull() & F.col("first").isNull(), COPY).otherwise(0)
    counted = lambda flag: F.sum(F.when(F.col(flag) == 1, F.col("rows")).otherwise(0))
    return met.groupBy("part", F.col("failed").bitwiseOR(copy).alias("failed")).agg(
        F.sum("rows").alias("rows"), counted("is_good").alias("good"), counted("is_toxic").alias("toxic")
    )


def removals(counted: DataFrame) -> DataFrame:
    """One row per ``part``: its ``total``, and for each measure the array of what every coalition of filters removes, by its bits."""
    coalition = F.explode(F.sequence(F.lit(0), F.lit(EVERY))).alias("coalition")
    hit = F.col("failed").bitwiseAND(F.col("coalition")) != 0
    sums = [F.sum(F.when(hit, F.col(m)).otherwise(0)).alias(m) for m in MEASURES]
    per_coalition = counted.select("*", coalition).groupBy("part", "coalition").agg(F.sum("rows").alias("total"), *sums)
    in_order = F.array_sort(F.collect_list(F.struct("coalition", *MEASURES)))  # 32 entries
    tabled = per_coalition.groupBy("part").agg(F.max("total").alias("total"), in_order.alias("all"))
    return tabled.select("part", "total", *(F.col("all").getField(m).alias(m) for m in MEASURES))


def solve(left: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """``x`` of ``left x = right`` for all columns of ``right`` at once, by elimination in rationals."""
    n = len(left)
    rows = [list(a) + list(b) for a, b in zip(left, right)]
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [v / rows[i][i] for v in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [v - rows[r][i] * w for v, w in zip(rows[r], rows[i])]
    return [row[n:] for row in rows]


def shapley_weights(players: int = len(FILTERS)) -> list[list[Fraction]]:
    """For each player the factor of every coalition's value in its Shapley value.

    The normal equations of least squares over all proper coalitions, weighted by the Shapley kernel, with one multiplier for the condition
    that the shares add up to the value of the grand coalition.
    """
    grand = (1 << players) - 1
    left = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [[Fraction(0)] * (grand + 1) for _ in range(players + 1)]
    for coalition in range(1, grand):
        inside = [i for i in range(players) if coalition >> i & 1]
        weight = Fraction(players - 1, math.comb(players, len(inside)) * len(inside) * (players - len(inside)))
        for i in inside:
            right[i][coalition] += weight
            for j in inside:
                left[i][j] += weight
    for i in range(players):
        left[i][players] = left[players][i] = Fraction(1)
    right[players][grand] = Fraction(1)
    return solve(left, right)[:players]


def steps() -> list[tuple[str, int, int, int, int]]:
    """(order, step, filter, coalition before, coalition after) of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, 1):
            out.append((name, step, f, before, before | 1 << f))
            before |= 1 << f
    return out


def _dot(factors: list[int], values: Column) -> Column:
    return reduce(add, [F.lit(k) * F.get(values, F.lit(i)) for i, k in enumerate(factors) if k])


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step: ``kept``, ``removed``, ``redundant``, ``unique_fails``, ``good_lost``, ``toxic_lost``, ``shapley``.

    ``shapley`` is the filter's removals summed over all 120 orders. NULL and empty texts are the same, empty text, which fails A alone (and E as a copy). A NULL
    key is no smaller than any other, and no other is smaller than it, so such a row never fails E and has no label; rows that repeat a key and a text
    fail E only if a smaller key has the text. A key with several labels counts as good or toxic if one of them says so. An empty table gives no rows. Only the
    named columns are read, whatever others there are.
    """
    table = removals(failures(docs, labels, key, text, part))
    orders = math.factorial(len(FILTERS))
    whole = [[int(k * orders) for k in player] for player in shapley_weights()]
    shares = table.withColumn("shares", F.array(*(_dot(player, F.col("rows")) for player in whole)))
    names, numbers, filters, befores, afters = (list(c) for c in zip(*steps()))
    at = F.col("at")
    placed = shares.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("at")).select(
        "*", *(F.get(F.lit(c), at).alias(n) for n, c in (("filter_order", names), ("step", numbers), ("f", filters), ("before", befores), ("after", afters)))
    )
    lost = lambda m: F.get(m, F.col("after")) - F.get(m, F.col("before"))
    alone = F.col("after") - F.col("before")
    return placed.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("rows", F.col("after"))).alias("kept"),
        lost("rows").alias("removed"),
        (F.get("rows", alone) - lost("rows")).alias("redundant"),
        (F.get("rows", F.lit(EVERY)) - F.get("rows", F.lit(EVERY) - alone)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        F.get("shares", F.col("f")).alias("shapley"),
    )
