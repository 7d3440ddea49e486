"""Counts that describe a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """NULLs of each column in one pass; a mapping gives the output names."""
    names = columns if isinstance(columns, Mapping) else {c: f"{c}_nulls" for c in columns}
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(out) for c, out in names.items()])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, total_rows`` for every table given."""
    n = F.count(F.lit(1)).alias("total_rows")
    counted = [df.agg(n).select(F.lit(name).alias("table_name"), "total_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def rows_where(df: DataFrame, condition: Column, limit: int | None = None) -> DataFrame:
    """Rows meeting the condition; a limit is for looking at a few of them."""
    found = df.filter(condition)
    return found if limit is None else found.limit(limit)
