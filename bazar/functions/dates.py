"""Day differences. Timestamps carry no zone, and none of these consult the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazar.functions.text import ColumnOrName, _col

SECONDS_PER_DAY = 86400.0


def to_timestamp(c: ColumnOrName) -> Column:
    return _col(c).cast("timestamp_ntz")


def calendar_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Midnights crossed: 23:00 to 01:00 the next day is 1."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def elapsed(start: ColumnOrName, end: ColumnOrName) -> Column:
    """The interval between two timestamps. Intervals can be summed, exactly."""
    return _col(end) - _col(start)


def seconds_of(interval: ColumnOrName) -> Column:
    """Exact seconds to the microsecond, as decimal."""
    return _col(interval).cast("interval second").cast("decimal(18,6)")


def days_of(seconds: ColumnOrName) -> Column:
    return _col(seconds).cast("double") / SECONDS_PER_DAY


def elapsed_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Fractional days: 23:00 to 01:00 the next day is 0.083."""
    return days_of(seconds_of(elapsed(start, end)))


def whole_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Fractional days rounded to INT, halves to the even day."""
    return F.bround(elapsed_days(start, end), 0).cast("int")
