"""Ranks over a whole table without sorting it in one task.

One range exchange deals the rows out in the order asked for; each range is numbered by itself and shifted by the rows of the ranges before, which are
counted behind the same exchange. Nothing is stored and no job runs while the query is built. Both readers of the exchange must see the same ranges: a range
with more rows than were counted stops the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# monotonically_increasing_id is the number of the partition, then this many bits for the row in it.
ROW_BITS = 33


def _dealt(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """As many ranges as shuffle partitions; the number is given, so that it stays the same for every reader."""
    return df.repartitionByRange(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *order)


def _per_range(ranged: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    """Rows of each range, as ``__n``, counted behind the exchange that the rows go through.

    An aggregate that needs few columns would get an exchange of its own, for which the input is evaluated again and dealt differently. ``seal`` depends on
    every column, so both exchanges are the same one and the second reads what the first wrote.
    """
    sealed = ranged.groupBy("__range", *by).agg(F.count(F.lit(1)).alias("__n"), F.bit_xor(F.xxhash64(*columns)).alias("seal"))
    return sealed.filter(F.col("seal").isNotNull()).drop("seal")


def _before() -> Column:
    """Rows of all earlier ranges; there is one row for each range, so one task is enough."""
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("__n").over(earlier), F.lit(0))


def _counted(nth: Column, value: Column) -> Column:
    return F.when(nth <= F.col("__n"), value).otherwise(F.raise_error(F.lit("rows were dealt out twice: ranks need spark.sql.exchange.reuse and input that does not change")))


def row_positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Number the rows from 1 in an order; rows equal in it are numbered in the order of a hash of the row, so ties may span ranges."""
    order = [*order, F.xxhash64(*df.columns)]
    dealt = _dealt(df, order)
    offsets = _per_range(dealt.withColumn("__range", F.spark_partition_id()), df.columns).select("__range", "__n", _before().alias("__before"))
    numbered = dealt.sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id())
    numbered = numbered.withColumn("__range", F.shiftright("__at", ROW_BITS).cast("int"))
    nth = F.col("__at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    return numbered.join(F.broadcast(offsets), "__range").select(*df.columns, _counted(nth, F.col("__before") + nth).alias(name))


def global_row_number(df: DataFrame, value: str, tie: Sequence[str], name: str) -> DataFrame:
    """Row number by ``value`` descending; ``tie`` must make the order unique."""
    return row_positions(df, [F.col(value).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie]], name)


def global_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """``RANK() OVER (ORDER BY value DESC)``: ties share a rank and leave gaps. NULL comes last.

    Rows of one value are told apart by a hash of the whole row, so a value that most rows share spans as many ranges as its rows need; only rows equal in
    every column stay together. Such a value's rank is that of its first range, which the last value of each range and its count tell: where a range
    begins with the value the one before ended with, its rank is carried over.
    """
    at, n = F.col(value), F.col("__n")
    ranged = _dealt(df, [at.desc_nulls_last(), F.xxhash64(*df.columns)]).withColumn("__range", F.spark_partition_id())
    inside = Window.partitionBy("__range").orderBy(at.desc_nulls_last())
    none = F.coalesce(F.sum(F.when(at.isNull(), n)), F.lit(0))
    per_range = _per_range(ranged, df.columns, value).groupBy("__range").agg(
        F.sum(n).alias("__n"),
        F.max(at).alias("first"),
        F.when(none == 0, F.min(at)).alias("last"),
        F.when(none > 0, none).otherwise(F.min_by(n, at)).alias("last_n"),
    )
    # where the rows of a range's last value begin
    begins = per_range.select("__range", "__n", "first", "last", _before().alias("__before"), (_before() + n - F.col("last_n") + 1).alias("begin"))
    begins = begins.withColumn("begin", F.min("begin").over(Window.partitionBy("last")))
    previous = lambda c: F.lag(c).over(Window.orderBy("__range"))
    goes_on = previous("begin").isNotNull() & previous("last").eqNullSafe(F.col("first"))
    offsets = begins.select("__range", "__n", "__before", F.col("first").alias("__first"), F.when(goes_on, previous("begin")).alias("__carried"))
    rank = F.when(F.col("__carried").isNotNull() & at.eqNullSafe(F.col("__first")), F.col("__carried")).otherwise(F.col("__before") + F.col("__inside"))
    numbered = ranged.withColumn("__inside", F.rank().over(inside)).withColumn("__nth", F.row_number().over(inside))
    return numbered.join(F.broadcast(offsets), "__range").select(*df.columns, _counted(F.col("__nth"), rank).alias(name))
