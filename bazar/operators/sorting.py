"""Orders applied when a table is read: a stored table keeps none."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazar.operators.ranking import row_positions


def _keys(order: Sequence[str | Column]) -> list[Column]:
    """'-name' is descending; NULLs are last either way."""
    keys = []
    for key in order:
        if isinstance(key, Column):
            keys.append(key.desc_nulls_last())
        elif key.startswith("-"):
            keys.append(F.col(key[1:]).desc_nulls_last())
        else:
            keys.append(F.col(key).asc_nulls_last())
    return keys


def ordered(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Sort by names ('-name' descending) or by expressions (descending), NULLs last."""
    return df.orderBy(*_keys(order))


def positions(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """The same order as a number from 1 for every row, found range by range; no task sees the whole table."""
    return row_positions(df, _keys(order), name)


def top_k(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    """First ``k`` rows of that order; each task keeps its own ``k`` before the merge.

    End ``order`` with a unique column, or equal rows make the result depend on the run.
    """
    return ordered(df, order).limit(k)
