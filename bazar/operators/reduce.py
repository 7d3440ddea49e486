"""Aggregation below the join.

A join that only feeds an aggregate never needs its pairs. Each side is first reduced to
one row per key (and per column the result still groups by), with the row count kept as
``copies``; after the join, sums are weighted with the copies of the other side. Fan-out
is reproduced exactly, no pair is built, and a key holding a third of a table shrinks to
a few rows in the map tasks, before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazar.functions.numeric import SMALL, as_double, exact_total, sum_units, whole
from bazar.functions.text import ColumnOrName, _col

Measures = Mapping[str, Column]


def collapse(
    df: DataFrame,
    keys: Sequence[str],
    sums: Measures | None = None,
    units: Measures | None = None,
    least: Measures | None = None,
    greatest: Measures | None = None,
    copies: str = "copies",
) -> DataFrame:
    """One row per ``keys`` with the number of rows it stands for, and measures.

    ``sums`` are counts, ``units`` money in whole units. This is also a side of a join on the first key, for a
    result that only sums over it: whatever one key holds comes to a task as a few rows.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(copies),
        *[F.sum(c).alias(name) for name, c in (sums or {}).items()],
        *[sum_units(c).alias(name) for name, c in (units or {}).items()],
        *[F.min(c).alias(name) for name, c in (least or {}).items()],
        *[F.max(c).alias(name) for name, c in (greatest or {}).items()],
    )


def stack_by_key(
    key: str,
    parts: Sequence[DataFrame],
    sums: Sequence[str],
    units: Sequence[str] = (),
    least: Sequence[str] = (),
    greatest: Sequence[str] = (),
) -> DataFrame:
    """Merge several tables into one row per key with a single shuffle.

    Each part has ``key`` and some of the measure columns. A union followed by one
    ``groupBy`` replaces a chain of full outer joins over separate aggregates: partial
    sums are formed in the map tasks and nothing is sorted. A sum no part fed is NULL.
    """
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in sums],
        *[sum_units(c).alias(c) for c in units],
        *[F.min(c).alias(c) for c in least],
        *[F.max(c).alias(c) for c in greatest],
    )


def sum_product(*factors: ColumnOrName) -> Column:
    """Aggregate: sum of a product of counts, as decimal since fan-out may outgrow 64 bits. A product that does not is formed as bigint."""
    size = F.abs(reduce(mul, [as_double(f) for f in factors]))
    small = reduce(mul, [_col(f).cast("bigint") for f in factors])
    return exact_total(F.when(size < SMALL, small), F.when(size >= SMALL, reduce(mul, [whole(f) for f in factors])))


def count_product(*factors: ColumnOrName) -> Column:
    """Aggregate: the same as a 64-bit count, like the number of joined rows it stands for."""
    return F.sum(reduce(mul, [_col(f).cast("bigint") for f in factors]))


def money_product(amount: ColumnOrName, *counts: ColumnOrName) -> Column:
    """Aggregate: sum of units times counts, as decimal."""
    return sum_product(amount, *counts)
