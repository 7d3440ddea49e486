"""The lake: one folder per layer, one table folder per name."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from bazar.operators.sorting import top_k
from bazar.sources.describe import describe

# what Spark leaves in a folder when the job that wrote it is done
DONE = "_SUCCESS"


class Lake:
    """Tables under ``root/layer/name``, in any format Spark can write.

    A transactional format replaces a table in one commit. For plain files every overwrite writes a new folder below that of the table,
    named by time. The table is the latest folder whose job is done, so a failing or killed job leaves the old table, readers of the old
    one go on, a table may be rebuilt from itself, and of two writers the later one wins. Nothing is renamed. ``KEPT`` finished folders stay.
    """

    KEPT = 2

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet") -> None:
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def _fs(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        return hadoop.Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop.Path

    def _folders(self, path: str) -> list[str]:
        fs, at = self._fs()
        if not fs.exists(at(path)):
            return []
        names = [entry.getPath().getName() for entry in fs.listStatus(at(path)) if entry.isDirectory()]
        return sorted(n for n in names if not n.startswith((".", "_")))

    def _versions(self, layer: str, name: str) -> list[str]:
        """Finished folders of a table, the latest last."""
        fs, at = self._fs()
        table = f"{self.root}/{layer}/{name}"
        return [f"{table}/{v}" for v in self._folders(table) if fs.exists(at(f"{table}/{v}/{DONE}"))]

    def path(self, layer: str, name: str) -> str:
        """Where the table is now; the folder to be for one that does not exist."""
        table = f"{self.root}/{layer}/{name}"
        if self.fmt == "delta":
            return table
        return next(iter(self._versions(layer, name)[-1:]), table)

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.format(self.fmt).load(self.path(layer, name))

    def write(self, df: DataFrame, layer: str, name: str, mode: str = "overwrite") -> None:
        """Modes: overwrite, append, ignore, error."""
        table = f"{self.root}/{layer}/{name}"
        if self.fmt == "delta":
            df.write.format(self.fmt).mode(mode).save(table)
            return
        versions = self._versions(layer, name)
        if versions and mode != "overwrite":
            df.write.format(self.fmt).mode(mode).save(versions[-1])
            return
        df.write.format(self.fmt).mode("error").save(f"{table}/{time.time_ns():020d}-{uuid.uuid4().hex}")
        fs, at = self._fs()
        for old in versions[: -self.KEPT + 1]:
            fs.delete(at(old), True)

    def remove(self, path: str) -> None:
        """Delete a folder or file on the storage of the lake."""
        fs, at = self._fs()
        fs.delete(at(path), True)

    def exists(self, layer: str, name: str) -> bool:
        if self.fmt == "delta":
            fs, at = self._fs()
            return fs.exists(at(self.path(layer, name)))
        return bool(self._versions(layer, name))

    def tables(self, layer: str) -> list[str]:
        """Tables of a layer, by name."""
        return [name for name in self._folders(f"{self.root}/{layer}") if self.exists(layer, name)]

    def preview(self, layer: str, name: str, limit: int = 10, order: Sequence[str] = ()) -> DataFrame:
        """A few rows: whichever come first, or the first in ``order`` ('-name' descending)."""
        df = self.read(layer, name)
        return top_k(df, order, limit) if order else df.limit(limit)

    def describe(self, layer: str, name: str) -> DataFrame:
        return describe(self.read(layer, name))
