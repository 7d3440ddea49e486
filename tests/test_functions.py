from __future__ import annotations

import datetime as dt
import math
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bazar import functions as fn


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def one(spark, rows, schema, column):
    return [r[0] for r in values(spark, rows, schema, column)]


def test_trim_takes_spaces_only(spark):
    rows = [("  São Paulo ",), ("\tx ",), ("",), (None,), ("02403",)]
    assert one(spark, rows, "s string", fn.clean_lower("s")) == ["são paulo", "\tx", "", None, "02403"]
    assert one(spark, rows, "s string", fn.clean_upper("s")) == ["SÃO PAULO", "\tX", "", None, "02403"]


def test_inner_defaults_are_cleaned_and_outer_defaults_are_not(spark):
    rows = [(None,), (" A ",), ("",)]
    assert one(spark, rows, "s string", fn.lower_or("s", "N/A")) == ["n/a", "a", ""]
    assert one(spark, rows, "s string", fn.upper_or("s", "n/a")) == ["N/A", "A", ""]
    assert one(spark, rows, "s string", fn.text_or("s", "N/A")) == ["N/A", " A ", ""]
    assert one(spark, rows, "s string", fn.empty_to("s", "N/A")) == ["N/A", " A ", "N/A"]


def test_text_to_int_rounds_halves_away(spark):
    rows = [("2.5",), ("3.5",), ("-2.5",), ("12.7",), (" 7 ",), (None,)]
    assert one(spark, rows, "s string", fn.text_to_int("s")) == [3, 4, -3, 13, 7, None]


def test_malformed_number_stops_unless_allowed(spark):
    rows = [("abc",), ("4",)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|abc"):
        one(spark, rows, "s string", fn.text_to_int("s"))
    assert one(spark, rows, "s string", fn.text_to_int("s", strict=False)) == [None, 4]


def test_whole_days_round_halves_to_even(spark):
    start = dt.datetime(2020, 1, 1)
    rows = [(start, start + dt.timedelta(days=d)) for d in (2.5, 3.5, -2.7, 0)] + [(start, None)]
    assert one(spark, rows, "a timestamp_ntz, b timestamp_ntz", fn.whole_days("a", "b")) == [2, 4, -3, 0, None]


def test_rounding_decides_on_the_binary_value(spark):
    rows = [(1.005,), (2.675,), (-0.125,), (0.125,), (float("inf"),), (None,)]
    assert one(spark, rows, "x double", fn.round_half_away("x", 2)) == [1.0, 2.68, -0.13, 0.13, float("inf"), None]


def test_calendar_and_elapsed_days(spark):
    rows = [
        (dt.datetime(2020, 1, 1, 23), dt.datetime(2020, 1, 2, 1)),
        (dt.datetime(2020, 1, 3), dt.datetime(2020, 1, 1, 12)),
        (dt.datetime(2020, 1, 3), None),
    ]
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert one(spark, rows, schema, fn.calendar_days("a", "b")) == [1, -2, None]
    assert one(spark, rows, schema, fn.elapsed_days("a", "b")) == [2 / 24, -1.5, None]


def test_elapsed_days_ignore_the_session_zone(spark):
    # an hour that does not exist in this zone
    rows = [(dt.datetime(2024, 3, 31, 1), dt.datetime(2024, 3, 31, 4))]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert one(spark, rows, "a timestamp_ntz, b timestamp_ntz", fn.elapsed_days("a", "b")) == [3 / 24]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_division_by_zero_is_not_an_error(spark):
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (1.0, None), (1.0, 4.0)]
    got = one(spark, rows, "a double, b double", fn.ieee_divide("a", "b"))
    assert got[0] == float("inf") and got[1] == float("-inf") and math.isnan(got[2])
    assert got[3:] == [None, None, 0.25]


def test_float_ratio_is_32_bit(spark):
    [(ratio,)] = values(spark, [(333, 100)], "a bigint, b bigint", fn.float_ratio("a", "b").cast("double"))
    assert ratio == 3.3299999237060547


def test_ladder_edges_and_null(spark):
    bands = [fn.Band(0.1, 2), fn.Band(0.2, 3)]
    rows = [(0.1,), (0.2,), (0.0999,), (0.15,), (None,)]
    assert one(spark, rows, "x double", fn.ladder("x", bands, otherwise=1)) == [2, 3, 1, 2, 1]


def test_lifetime_label(spark):
    rows = [(29,), (30,), (180,), (181,), (None,)]
    assert one(spark, rows, "d int", fn.lifetime_label("d")) == ["BEGINNER", "NEWBIE", "NEWBIE", "EXPERT", None]


@settings(max_examples=15, deadline=None)
@given(cents=st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=50))
def test_sums_are_exact_in_any_order(spark, cents):
    rows = [(c / 100,) for c in cents]
    exact = float(Fraction(sum(cents), 100))
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "x double").repartition(3)
        assert df.agg(fn.exact_sum("x"), fn.exact_mean("x")).first() == (exact, exact / len(cents))


def test_sum_of_units_outgrows_64_bits(spark):
    big = 2**62
    df = spark.createDataFrame([(big,)] * 5 + [(-3,), (None,)], "u bigint")
    assert int(df.agg(fn.sum_units("u")).first()[0]) == 5 * big - 3
    assert df.filter("u is null").agg(fn.sum_units("u")).first()[0] is None


def test_money_ignores_null(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "x double")
    assert df.agg(fn.exact_sum("x"), fn.exact_mean("x")).first() == (0.3, 0.15)
    assert df.filter("x is null").agg(fn.exact_sum("x"), fn.exact_mean("x")).first() == (None, None)


def test_null_default_for_numbers(spark):
    assert one(spark, [(None,), (2.5,)], "x double", F.coalesce("x", F.lit(0.0))) == [0.0, 2.5]
