"""Casts, exact sums and rounding.

Sums of doubles depend on the order rows arrive in, and that order changes with every
shuffle and every retried task. Money is therefore summed in whole units of 1/10000 and
turned into a double once, at the end: the same rows always give the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from bazar.functions.text import ColumnOrName, _col

COORDINATE = DecimalType(24, 15)
WHOLE = DecimalType(38, 0)

UNITS_PER_MONEY = 10000.0


# Up to this size every whole number is exact as a double and leaves room for its sums in two 64-bit limbs.
SMALL = 2.0**53
LIMB_BITS = 24


def units(c: ColumnOrName) -> Column:
    """Money as whole units, a double without a fraction.

    Infinities, NaN and amounts from 1e33 on are no money: they become NULL and are left out of sums.
    """
    whole_units = F.rint(as_double(c) * UNITS_PER_MONEY)
    return F.when(F.abs(whole_units) < 1e37, whole_units)


def exact_total(small: Column, wide: Column) -> Column:
    """Aggregate: sum of whole numbers as decimal, whatever their order and size.

    A row has its number in one of the two: ``small`` is a bigint below ``SMALL``, ``wide`` a decimal. Small ones are summed as bigint, lower bits and upper bits
    apart, and carried once at the end, which costs little more than a sum of doubles; the sum of the wide ones, few if any, is decimal.
    """
    low = F.sum(small.bitwiseAND(F.lit((1 << LIMB_BITS) - 1)))
    high = F.sum(F.shiftright(small, LIMB_BITS))
    fits = F.abs(high) < 1 << (61 - LIMB_BITS)
    base = F.lit(1 << LIMB_BITS)
    carried = F.when(fits, (high * base + low).cast(WHOLE)).otherwise(high.cast(WHOLE) * base.cast(WHOLE) + low.cast(WHOLE))
    rest = F.sum(wide)
    return F.when(rest.isNull(), carried).when(high.isNull(), rest).otherwise((carried + rest).cast(WHOLE))


def sum_units(c: ColumnOrName) -> Column:
    """Aggregate: sum of whole units, given as double, bigint or decimal."""
    size = F.abs(as_double(c))
    return exact_total(F.when(size < SMALL, _col(c).cast("bigint")), F.when(size >= SMALL, whole(c)))


def money_of(c: ColumnOrName) -> Column:
    """A sum of units as a double amount."""
    return as_double(c) / UNITS_PER_MONEY


def whole(c: ColumnOrName) -> Column:
    """A count as decimal, for products that may outgrow 64 bits."""
    return _col(c).cast(WHOLE)


def as_double(c: ColumnOrName) -> Column:
    return _col(c).cast("double")


def exact_sum(c: ColumnOrName) -> Column:
    """Aggregate: order-independent sum of money, as double."""
    return money_of(sum_units(units(c)))


def exact_mean(c: ColumnOrName) -> Column:
    """Aggregate: order-independent mean of the non-NULL amounts."""
    return mean_of(exact_sum(c), F.count(_col(c)))


def exact_decimal_mean(c: ColumnOrName, dtype: DecimalType) -> Column:
    """Aggregate: the same for values that need more decimals than money."""
    return mean_of(F.sum(_col(c).cast(dtype)), F.count(_col(c)))


def mean_of(total: ColumnOrName, n: ColumnOrName) -> Column:
    """``total / n`` as double, NULL when there is nothing to average."""
    return F.try_divide(as_double(total), as_double(n))


def round_half_away(c: ColumnOrName, digits: int) -> Column:
    """Round a double with halves away from zero, deciding on the scaled binary value.

    ``F.round(x, 2)`` rounds the printed decimal instead: 1.005 gives 1.01 there and
    1.0 here.
    """
    scale = float(10**digits)
    return F.round(as_double(c) * scale, 0) / scale


def text_to_int(c: ColumnOrName, strict: bool = True) -> Column:
    """Text to INT with halves away from zero ('2.5' is 3).

    Malformed text stops the job; with ``strict=False`` it becomes NULL.
    """
    number = as_double(c) if strict else _col(c).try_cast("double")
    return F.round(number, 0).cast("int")


def float_ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """32-bit division. Dividing two floats as doubles and rounding once is the same."""
    return (as_double(_col(a).cast("float")) / as_double(_col(b).cast("float"))).cast("float")


def ieee_divide(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Double division where x/0 is an infinity and 0/0 is NaN instead of an error."""
    a, b = as_double(a), as_double(b)
    by_zero = (
        F.when(a > 0, float("inf")).when(a < 0, float("-inf")).when(a.isNotNull(), float("nan"))
    )
    return F.when(b == 0, by_zero).otherwise(F.try_divide(a, b))
