"""Column functions against the edge rows of the fixtures (rules R5, R7-R9, F6, F13, K8)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import (boolean_option, clean_text, days_between, null_na_tokens, parse_bool, strict_cast,
                                  strict_timestamp, to_datetime, to_integer, to_number)


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_clean_text_unicode_whitespace(spark):
    vals = ["\ta ", "　b", "   ", "​q", "x\x1c", None, " MiXed "]
    assert one_col(spark, vals, clean_text) == ["a", "b", None, "​q", "x", None, "MiXed"]
    assert one_col(spark, [" MiXed "], lambda c: clean_text(c, "upper")) == ["MIXED"]
    assert one_col(spark, [" MiXed "], lambda c: clean_text(c, "lower")) == ["mixed"]


def test_to_integer_lenient(spark):
    vals = ["40.0", " 4 ", "1e3", "1,000", "x", None]
    assert one_col(spark, vals, to_integer) == [40, 4, 1000, None, None, None]


@pytest.mark.parametrize("text", ["40.5", "40.0000001", "40.000000000000007", "1e-3", "1e-30"])
def test_to_integer_fractional_fails(spark, text):
    with pytest.raises(Exception, match="fractional"):
        one_col(spark, [text], to_integer)


@pytest.mark.parametrize("text", ["3000000000", "5000000000000", "1e13", "-1e25", "123456789012345678901234567890123456789012"])
def test_oversize_integers_fail_whatever_their_size(spark, text):
    with pytest.raises(Exception, match="out of range"):
        one_col(spark, [text], to_integer)


@pytest.mark.parametrize("text", ["1e13", "1234567890123.45", "-1e300", "1000000000000"])
def test_oversize_numbers_fail_instead_of_becoming_null(spark, text):
    with pytest.raises(Exception, match="out of range"):
        one_col(spark, [text], to_number)


def test_to_number(spark):
    vals = ["0.004", "10.5", "n/k", "inf", "NaN", None, " 12.50 ", "1e3", "-.5", "5.", "\t7\n", "1 2", "", "e5", "999999999999.999999"]
    assert one_col(spark, vals, to_number) == [
        Decimal("0.004000"), Decimal("10.500000"), None, None, None, None, Decimal("12.500000"), Decimal(1000), Decimal("-0.5"),
        Decimal(5), Decimal(7), None, None, None, Decimal("999999999999.999999")]


LAYOUTS = {
    "2017-10-02 10:56:33": dt.datetime(2017, 10, 2, 10, 56, 33), " 2017-10-02 10:56:33 ": dt.datetime(2017, 10, 2, 10, 56, 33),
    "2017-10-02": dt.datetime(2017, 10, 2), "2017-10-02T10:56:33": dt.datetime(2017, 10, 2, 10, 56, 33),
    "2017-10-02 10:56:33.5": dt.datetime(2017, 10, 2, 10, 56, 33, 500000),
    "2017-10-02 10:56:33.1234567": dt.datetime(2017, 10, 2, 10, 56, 33, 123456),
}
NO_TIMES = ["bad", "2017-02-30 10:00:00", "2017", "2017-05", "2017-10-02 25:00:00", "", "02/10/2017"]


def test_to_datetime_layouts(spark):
    assert one_col(spark, [*LAYOUTS, *NO_TIMES, None], to_datetime) == [*LAYOUTS.values()] + [None] * (len(NO_TIMES) + 1)


def test_the_strict_scan_accepts_what_the_cleaner_accepts(spark):
    assert one_col(spark, [*LAYOUTS, None], strict_timestamp) == [*LAYOUTS.values(), None]
    for text in NO_TIMES:
        with pytest.raises(Exception, match="invalid timestamp"):
            one_col(spark, [text], strict_timestamp)


def test_days_between_negative(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2, 12), dt.datetime(2020, 1, 1))],
                               "p timestamp_ntz, d timestamp_ntz")
    r = df.select(days_between("d", "p").cast("decimal(10,2)").alias("x")).first()
    assert r.x == Decimal("-1.50")


def test_parse_bool(spark):
    assert one_col(spark, ["\tyes\n", "NO ", "y", "n", "1", "0", "\u3000True", "false"], parse_bool) == \
        [True, False, True, False, True, False, True, False]
    for word in ("maybe", None, ""):
        with pytest.raises(Exception, match="not a boolean"):
            one_col(spark, [word], parse_bool)
    assert boolean_option(" Y ") is True and boolean_option(False) is False and boolean_option("\tno") is False
    with pytest.raises(ValueError):
        boolean_option("maybe")


def test_store_rounding_and_overflow(spark):
    df = spark.createDataFrame([(Decimal("0.005"),), (Decimal("-0.005"),)], "x decimal(18,6)")
    assert [r[0] for r in df.select(strict_cast("x", "decimal(12,2)")).collect()] == [Decimal("0.01"), Decimal("-0.01")]
    ten = spark.createDataFrame([(10.0,)], "x double")
    from pyspark.sql import types as T
    from ledgerline.plans.store import cast_to
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:  # overflow on store fails regardless of the session's ANSI mode
        with pytest.raises(Exception, match="out of range"):
            cast_to(ten, T.StructType([T.StructField("x", T.DecimalType(3, 2))])).collect()
        from ledgerline.functions import strict_timestamp
        with pytest.raises(Exception, match="invalid timestamp"):
            one_col(spark, ["bad"], strict_timestamp)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_na_tokens(spark):
    df = spark.createDataFrame([("NA",), ("null",), ("None",), ("nan",), ("",), ("ok",), ("n/k",)], "x string")
    assert [r[0] for r in null_na_tokens(df).collect()] == [None, None, None, None, None, "ok", "n/k"]


def test_everyday_text_is_not_cast_in_vain(spark):
    """A cast that refuses its text raises and catches an exception for every row: a match goes before each."""
    df = spark.createDataFrame([("1.0",), ("40.0",), ("12",), ("n/k",), ("NaN",), ("",)], "x string")
    for parse, wanted in ((to_integer, [1, 40, 12, None, None, None]), (to_number, [Decimal(1), Decimal(40), Decimal(12), None, None, None])):
        parsed = df.select(parse("x").alias("y"))
        plan = parsed._jdf.queryExecution().analyzed().toString().lower()
        assert plan.startswith("project [coalesce(case when rlike(")
        assert [r.y for r in parsed.collect()] == wanted


def test_casts_take_what_they_took_before(spark):
    """Blanks and control characters around a number, digits of other scripts and bare points, as the cast itself has it."""
    vals = ["1.", "+5", "-0.0", "\x005", "5\x7f", "\x1f5", "5\n", "5.0\r\n", "2147483647", "-2147483648.0", "12e0", "007.000"]
    assert one_col(spark, vals, to_integer) == [1, 5, 0, 5, 5, 5, 5, 5, 2147483647, -2147483648, 12, 7]
    digits = ["١٢", "１.٥", "\x001.5", "1,5", "--1", "1.0.0", "1d"]
    assert one_col(spark, digits, to_number) == [Decimal(12), Decimal("1.5"), Decimal("1.5"), None, None, None, None]
