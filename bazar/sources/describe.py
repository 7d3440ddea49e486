"""Column names and types as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def describe(df: DataFrame) -> DataFrame:
    """``column_name, column_type``, one row per column. Reads no data."""
    return df.sparkSession.createDataFrame(df.dtypes, "column_name string, column_type string")
