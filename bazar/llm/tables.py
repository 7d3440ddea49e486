"""What the operators share: session settings, stored steps, and per-row functions over Arrow batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from bazar.llm.text import flat, pieces
from bazar.session import scratch_root

SETTINGS = {
    # texts differ in length by factors of thousands, so batches are cut by bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # an operator is a chain of jobs; the shuffle files of one are of no use to the next
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepared(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators are written for and return the same session.

    Python workers find this package where the driver found it; on a cluster without that folder, ship it with --py-files.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    environment, home = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (*paths, home) if p)
    return spark


def stored(df: DataFrame) -> DataFrame:
    """Write a step below the shared folder and read it back, which cuts the lineage."""
    path = f"{scratch_root(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows, the first by a hash of their key; the same rows give the same sample.

    Where there are many more, rows are thinned by the hash to about eight times the limit before they are sorted, so what tasks send to the driver
    does not grow with their number.
    """
    steps = 1 << 30
    share = min(steps, 8 * limit * steps // max(1, df.count()) + 1)
    return df.filter(F.pmod(F.hash(key), F.lit(steps)) < share).orderBy(F.xxhash64(key), key).limit(limit)


def with_text_columns(
    df: DataFrame,
    text: str,
    fields: Sequence[StructField],
    compute: Callable[..., Sequence[Sequence]],
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add columns computed from a text column, one piece of a batch at a time.

    ``compute(data, offsets)`` gets the bytes and row offsets of a piece and returns one sequence
    per field. ``keep`` names the input columns to return, all of them by default; a kept column
    called like a new one is replaced. Nothing is shuffled.
    """
    names = [f.name for f in fields]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    schema = StructType([*(df.schema[c] for c in kept), *fields])
    source = df.select(*dict.fromkeys([*kept, text]))
    types = [arrow_type(f) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch.column(batch.schema.get_field_index(text)))
            for first, end, part, bounds in pieces(data, offsets):
                made = [pa.array(values, t) for values, t in zip(compute(part, bounds), types)]
                old = [batch.column(i).slice(first, end - first) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*old, *made], names=[*kept, *names])

    return source.mapInArrow(run, schema)


def arrow_type(field: StructField) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    kind = field.dataType.simpleString()
    if kind.startswith("array<"):
        return pa.list_(simple[kind[6:-1]])
    return simple[kind]
