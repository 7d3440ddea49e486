"""Column functions: text cleaning, casts and rounding, dates, scoring."""

from bazar.functions.dates import calendar_days, days_of, elapsed, elapsed_days, seconds_of, to_timestamp, whole_days
from bazar.functions.numeric import (
    as_double,
    exact_decimal_mean,
    exact_mean,
    exact_sum,
    exact_total,
    float_ratio,
    ieee_divide,
    mean_of,
    money_of,
    round_half_away,
    sum_units,
    text_to_int,
    units,
    whole,
)
from bazar.functions.scoring import Band, ladder, lifetime_label
from bazar.functions.text import clean_lower, clean_upper, empty_to, lower_or, text_or, upper_or

__all__ = [
    "Band",
    "as_double",
    "calendar_days",
    "clean_lower",
    "clean_upper",
    "days_of",
    "elapsed",
    "elapsed_days",
    "empty_to",
    "exact_decimal_mean",
    "exact_mean",
    "exact_sum",
    "exact_total",
    "float_ratio",
    "ieee_divide",
    "ladder",
    "lifetime_label",
    "lower_or",
    "mean_of",
    "money_of",
    "round_half_away",
    "seconds_of",
    "sum_units",
    "text_or",
    "text_to_int",
    "to_timestamp",
    "units",
    "upper_or",
    "whole",
    "whole_days",
]
