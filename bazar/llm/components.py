"""Connected components of a graph of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazar.llm.tables import stored


def _mark(edges: DataFrame) -> tuple:
    """Two stars are the same set of edges if these agree."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b) but the roots; the root is the smallest node reachable.

    Each round joins every node to the smallest node near it, first all larger neighbours, then the smaller ones, so paths shrink as
    their logarithm. Every step is a grouping and a join by node; a round is written to the shared folder, which cuts the lineage. Loops
    and repeated edges change nothing, no edges give no rows.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.withColumnRenamed("low", "b")).distinct()
        edges = stored(small)
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
