"""Joins that keep detail rows and must survive a hot key.

A key is hot when it has more than 1/``SHARES`` of a side's rows. Hot keys are found by counting rows per bucket of a hash of the key: a summary of at
most ``BUCKETS`` rows, formed in the map tasks, exact and thus the same for both sides of a join. Every hot bucket is split into pieces of about one
share, so no key above a share stays whole and what is broadcast has at most ``SHARES`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARES = 4096
# Far more buckets than shares, so that only few other keys fall into a hot one.
BUCKETS = 16 * SHARES


def _bucket(df: DataFrame, columns: list[str]) -> Column:
    """A number below the count of shuffle partitions, from the content of the row."""
    buckets = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def _key_bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _above_a_share(counted: DataFrame, name: str, pieces: str) -> DataFrame:
    """Rows of ``counted`` (``name``, ``__n``, ``__total``) with more than a share, and in how many pieces they are split."""
    share = F.col("__n") * SHARES / F.col("__total")
    return counted.filter(share > 1).select(name, F.ceil(share).cast("int").alias(pieces))


def hot_buckets(df: DataFrame, key: str, pieces: str = "__pieces") -> DataFrame:
    """``__bucket`` and the number of pieces for every bucket of keys above a share of the rows with a key; at most ``SHARES`` rows."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(_key_bucket(key).alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per bucket, so one task is enough
    return _above_a_share(counted.withColumn("__total", F.sum("__n").over(Window.partitionBy(F.lit(0)))), "__bucket", pieces)


def hot_keys(df: DataFrame, key: str, pieces: str = "__pieces") -> DataFrame:
    """``key`` and the number of pieces for every key above a share; only the keys of hot buckets are counted one by one."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(_key_bucket(key).alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
    buckets = counted.withColumn("__total", F.sum("__n").over(Window.partitionBy(F.lit(0)))).filter(F.col("__n") * SHARES > F.col("__total"))
    found = df.select(key, _key_bucket(key).alias("__bucket")).join(F.broadcast(buckets.select("__bucket", "__total")), "__bucket")
    return _above_a_share(found.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.max("__total").alias("__total")), key, pieces)


def _piece(df: DataFrame, pieces: str) -> Column:
    """The piece of a row, by its content; 0 where nothing is split."""
    return F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col(pieces)).cast("int"), F.lit(0))


def _every(pieces: str) -> Column:
    """All pieces; 0 alone where nothing is split."""
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(pieces), F.lit(1)) - 1))


def left_join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join to a table with one row per key, spreading NULL keys over all tasks.

    NULL matches nothing, but a plain left join would send every such row to one task.
    """
    spread = F.when(F.col(key).isNull(), _bucket(left, left.columns)).otherwise(0)
    return left.withColumn("__spread", spread).join(right.withColumn("__spread", F.lit(0)), [key, "__spread"], "left").drop("__spread")


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Attach ``lookup`` (one row per key) to every row with one shuffle join on (key, piece).

    Rows of hot keys and of NULL are split by their content; the lookup rows of hot buckets are repeated once per piece. ``rows`` is evaluated for the join, and
    its key for the counts of buckets.
    """
    hot = F.broadcast(hot_buckets(rows, key))
    salt = F.when(F.col(key).isNull(), _bucket(rows, rows.columns)).otherwise(_piece(rows, "__pieces"))
    salted = rows.withColumn("__bucket", _key_bucket(key)).join(hot, "__bucket", "left").withColumn("__salt", salt)
    repeated = lookup.withColumn("__bucket", _key_bucket(key)).join(hot, "__bucket", "left").withColumn("__salt", _every("__pieces"))
    helpers = ("__bucket", "__pieces")
    return salted.drop(*helpers).join(repeated.drop(*helpers), [key, "__salt"], how).drop("__salt")


def left_join_split(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join of two detail tables where either side, or both, may hold a hot key.

    The rows of a key form a grid: pieces of the left rows by pieces of the right rows. Left rows go to all columns of their row of the grid, right rows to all rows
    of their column, and each cell is joined by itself. A left row of a key that is split on the right has a match in some cell, so where it finds
    none it is dropped; all other left rows are in one column and stay, matched or not.
    """
    right = right.filter(F.col(key).isNotNull())
    hot_left, hot_right = F.broadcast(hot_buckets(left, key, "__rows")), F.broadcast(hot_keys(right, key, "__columns"))
    row = F.when(F.col(key).isNull(), _bucket(left, left.columns)).otherwise(_piece(left, "__rows"))
    placed = left.withColumn("__bucket", _key_bucket(key)).join(hot_left, "__bucket", "left").join(hot_right, key, "left")
    placed = placed.withColumn("__row", row).withColumn("__column", _every("__columns")).drop("__bucket", "__rows")
    met = right.withColumn("__bucket", _key_bucket(key)).join(hot_left, "__bucket", "left").join(hot_right, key, "left")
    met = met.withColumn("__column", _piece(right, "__columns")).withColumn("__row", _every("__rows")).withColumn("__met", F.lit(True))
    joined = placed.join(met.drop("__bucket", "__rows", "__columns"), [key, "__row", "__column"], "left")
    return joined.filter(F.col("__met").isNotNull() | F.col("__columns").isNull()).drop("__row", "__column", "__columns", "__met")
