"""Tables of SQLite files, read in parallel by rowid range."""

from __future__ import annotations

import os
import sqlite3
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

ROWS_PER_BATCH = 16384

# Declared SQLite type (by the words it contains, first match) to column type.
DECLARED_TYPES = (
    ("INT", LongType()),
    ("CHAR", StringType()),
    ("CLOB", StringType()),
    ("TEXT", StringType()),
    ("BLOB", BinaryType()),
    ("REAL", DoubleType()),
    ("FLOA", DoubleType()),
    ("DOUB", DoubleType()),
    ("DEC", DoubleType()),
    ("NUM", DoubleType()),
    ("TIME", TimestampNTZType()),
    ("DATE", DateType()),
)

ARROW_TYPES = {
    LongType(): pa.int64(),
    StringType(): pa.string(),
    BinaryType(): pa.binary(),
    DoubleType(): pa.float64(),
    TimestampNTZType(): pa.timestamp("us"),
    DateType(): pa.date32(),
}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _files(path: str) -> list[str]:
    """The file itself, or the SQLite files of a folder that hold parts of one table."""
    path = path.removeprefix("file:")
    if not os.path.isdir(path):
        return [path]
    return sorted(os.path.join(path, f) for f in os.listdir(path) if f.endswith((".sqlite", ".db")))


def _column_type(declared: str):
    return next((t for word, t in DECLARED_TYPES if word in declared.upper()), StringType())


@dataclass
class RowidRange(InputPartition):
    path: str
    first: int
    last: int


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, parts: int, schema: StructType) -> None:
        self.path, self.table, self.parts, self.schema = path, table, max(1, parts), schema

    def partitions(self) -> list[RowidRange]:
        """Equal rowid ranges; finding their ends is two index lookups per file."""
        ranges = []
        for path in _files(self.path):
            with _open(path) as con:
                first, last = con.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
            if first is None:
                continue
            step = -(-(last - first + 1) // self.parts)
            ranges += [RowidRange(path, start, min(start + step - 1, last)) for start in range(first, last + 1, step)]
        return ranges

    def read(self, partition: RowidRange | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty table has no ranges
            return
        types = [ARROW_TYPES[field.dataType] for field in self.schema.fields]
        names = ", ".join(_quoted(field.name) for field in self.schema.fields)
        con = _open(partition.path)
        try:
            rows = con.execute(
                f"SELECT {names} FROM {_quoted(self.table)} WHERE rowid BETWEEN ? AND ?", (partition.first, partition.last)
            )
            while batch := rows.fetchmany(ROWS_PER_BATCH):
                arrays = [_array(values, dtype) for values, dtype in zip(zip(*batch), types)]
                yield pa.RecordBatch.from_arrays(arrays, names=self.schema.names)
        finally:
            con.close()


def _array(values: tuple, dtype: pa.DataType) -> pa.Array:
    """SQLite has no date types: those columns hold ISO text."""
    if pa.types.is_timestamp(dtype) or pa.types.is_date(dtype):
        return pa.array(values, pa.string()).cast(pa.timestamp("us")).cast(dtype)
    return pa.array(values, dtype)


class SqliteDataSource(DataSource):
    """``spark.read.format("sqlite").option("table", t).load(path)``

    ``path`` is a file, or a folder of files that each hold a part of the table, on
    storage every executor mounts. Needs a rowid table.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        with _open(_files(self.options["path"])[0]) as con:
            columns = con.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        if not columns:
            raise ValueError(f"no table {self.options['table']!r} in {self.options['path']}")
        return StructType([StructField(name, _column_type(declared)) for _, name, declared, *_ in columns])

    def reader(self, schema: StructType) -> SqliteReader:
        parts = int(self.options.get("numPartitions", "8"))
        return SqliteReader(self.options["path"], self.options["table"], parts, schema)


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    """All columns of one table, read by ``partitions`` tasks per file."""
    # send the reader along with the job: workers need not have this package installed
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SqliteDataSource)
    return spark.read.format("sqlite").option("table", table).option("numPartitions", partitions).load(path)
