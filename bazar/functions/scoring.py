"""Threshold scores and labels."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazar.functions.text import ColumnOrName, _col


class Band(NamedTuple):
    """``result`` applies from ``at_least`` upwards."""

    at_least: float
    result: int | str


def ladder(metric: ColumnOrName, bands: Sequence[Band], otherwise: int | str) -> Column:
    """First band reached, highest first. A NULL metric reaches none of them."""
    steps = sorted(bands, key=lambda band: band.at_least, reverse=True)
    metric = _col(metric)
    result = F.when(metric >= steps[0].at_least, steps[0].result)
    for band in steps[1:]:
        result = result.when(metric >= band.at_least, band.result)
    return result.otherwise(otherwise)


# Seller lifetime labels, in days.
BEGINNER_BELOW = 30
NEWBIE_UP_TO = 180


def lifetime_label(days: ColumnOrName) -> Column:
    """BEGINNER below 30 days, NEWBIE up to 180, EXPERT above; NULL stays NULL."""
    days = _col(days)
    return (
        F.when(days < BEGINNER_BELOW, "BEGINNER").when(days <= NEWBIE_UP_TO, "NEWBIE").when(days.isNotNull(), "EXPERT")
    )
