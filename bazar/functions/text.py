"""Text cleaning. ``trim`` removes spaces only, so a tab inside the margin stays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_lower(c: ColumnOrName) -> Column:
    """Trimmed lower-case text; NULL stays NULL."""
    return F.lower(F.trim(_col(c)))


def clean_upper(c: ColumnOrName) -> Column:
    """Trimmed upper-case text; NULL stays NULL."""
    return F.upper(F.trim(_col(c)))


def lower_or(c: ColumnOrName, default: str) -> Column:
    """Default first, then clean: the default is lower-cased as well."""
    return clean_lower(F.coalesce(_col(c), F.lit(default)))


def upper_or(c: ColumnOrName, default: str) -> Column:
    """Default first, then clean: the default is upper-cased as well."""
    return clean_upper(F.coalesce(_col(c), F.lit(default)))


def text_or(c: ColumnOrName, default: str) -> Column:
    """Replace NULL and leave any other text as it is."""
    return F.coalesce(_col(c), F.lit(default))


def empty_to(c: ColumnOrName, default: str) -> Column:
    """Replace NULL and the empty string."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))
