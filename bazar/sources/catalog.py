"""Publishing lake tables for SQL."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from bazar.sources.lake import Lake


def publish_table(lake: Lake, layer: str, name: str, schema: str = "gold", fmt: str = "parquet", location: str | None = None) -> str:
    """Replace ``schema.name`` in the catalog with a copy of the lake table.

    The copy is written to a new folder below that of the schema; then a view of the name is pointed to it in one step, so there is
    always a whole table to read. ``location`` is where a schema that does not exist yet keeps its tables, instead of the warehouse folder.
    """
    spark = lake.spark
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`" + (f" LOCATION '{location}'" if location else ""))
    store = Lake(spark, spark.catalog.getDatabase(schema).locationUri, fmt)
    store.write(lake.read(layer, name), "published", name)
    spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS SELECT * FROM {fmt}.`{store.path('published', name)}`")
    return f"{schema}.{name}"


def publish_layer(
    lake: Lake, layer: str = "gold", schema: str = "gold", fmt: str = "parquet", location: str | None = None, parallel: int = 1
) -> list[str]:
    """Publish every table of a layer, ``parallel`` of them at a time."""
    spark = lake.spark
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`" + (f" LOCATION '{location}'" if location else ""))
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(lambda name: publish_table(lake, layer, name, schema, fmt, location), lake.tables(layer)))


def register_views(lake: Lake, layers: Iterable[str] = ("bronze", "silver", "gold")) -> list[str]:
    """A temporary view ``name`` for every lake table; a later layer wins a shared name."""
    names = []
    for layer in layers:
        for name in lake.tables(layer):
            lake.read(layer, name).createOrReplaceTempView(name)
            names.append(name)
    return names


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Run one SQL statement over the catalog and the registered views."""
    return spark.sql(sql)
