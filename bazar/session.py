"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Only runtime SQL settings, so they can be applied to a session somebody else created.
# Shuffle partition counts and memory stay with the cluster; AQE sizes the reducers.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when the split costs one more exchange later on
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # hash instead of sort where every partition of a side turns out small; such a table does
    # not spill, so lower this and the advisory partition size below some 2 GB per core
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # broadcast decisions compare memory, not compressed file bytes
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # the lake stores every table twice or more, and reads cost less than writes
    "spark.sql.parquet.compression.codec": "zstd",
    # the shuffle files of a query are of no use to the next; else they stay until the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the models are written for and return the same session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, also set for checkpoints.

    On a local master without that setting a fresh folder is made; a cluster without it is
    an error, since executors could not read each other's files.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="bazar-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")
