"""Lenient number parsing.

Text that is no number is NULL; text that is a finite number but does not fit
fails the job, whatever its size. Money is parsed to DECIMAL(18,6) and summed
exactly; rounding to the stored scale happens only on the final cast (HALF_UP).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reuse import made_once

PARSE_TYPE = "decimal(18,6)"


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# The widest decimal: what integers are judged on, before any rounding to money.
WIDE_TYPE = "decimal(38,18)"
# What counts as a finite decimal number, surrounding ASCII blanks allowed.
NUMBER_PATTERN = r"^[\x09-\x0D ]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[\x09-\x0D ]*$"
# All text that a cast to a decimal or to an integer may take, and more. Nothing else is cast: a refused cast
# raises and catches an exception inside Spark for every row, which costs a hundred times the match.
DECIMAL_TEXT = r"^[\x00-\x20]*[+-]?(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)([eE][+-]?\p{Nd}+)?[\x00-\x20]*$"
INTEGER_TEXT = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"
# Integers of up to nine digits, which fit, with or without a fraction of zeros.
PLAIN_INTEGER = r"^[+-]?[0-9]{1,9}(\.0*)?$"


def _number_as(col: Column | str, data_type: str, what: str) -> Column:
    """The cast value; only where the cast fails is the text looked at: a number then fails the job, all else is NULL."""
    text = _col(col).cast("string")
    bare = F.regexp_replace(text, r"[\x09-\x0D ]", "")  # blanks that a decimal cast does not take
    refused = F.raise_error(F.concat(F.lit(f"number out of range for {what}: "), text)).cast(data_type)
    cast = F.when(text.rlike(DECIMAL_TEXT), text.try_cast(data_type))
    return F.coalesce(cast, F.when(text.rlike(NUMBER_PATTERN), F.coalesce(bare.try_cast(data_type), refused)))


@made_once
def to_number(col: Column | str, *, what: str = "number") -> Column:
    """Text to DECIMAL(18,6); anything that is no number (``'1,000'``, ``'x'``, ``'inf'``) is NULL.

    Surrounding blanks and exponents (``' 4 '``, ``'1e3'``) are accepted. A number of 1e12 or more,
    which the stored NUMERIC(12,2) could not take either, fails the job instead of becoming NULL.
    """
    return _number_as(col, PARSE_TYPE, what)


def strict_cast(col: Column | str, data_type, what: str = "value") -> Column:
    """Cast that fails the job on a value the target type cannot hold.

    Independent of the session's ANSI setting: ``try_cast`` yields NULL for an
    unrepresentable value (overflow, unparsable text), which is turned into an
    error -- the behaviour of the source system's typed columns.
    """
    c = _col(col)
    converted = c.try_cast(data_type)
    return F.when(c.isNotNull() & converted.isNull(),
                  F.raise_error(F.concat(F.lit(f"value out of range for {what}: "), c.cast("string")))
                  ).otherwise(converted)


@made_once
def to_integer(col: Column | str, *, what: str = "value") -> Column:
    """Text to INT. ``'40.0'`` is 40; a fraction of any size and an oversize number fail the job.

    A fractional number in an integer column is a data error in the source
    system. It is judged on all its digits: on a wide decimal, and on the text as a double for digits beyond that.
    """
    text = _col(col).cast("string")
    number = _number_as(text, WIDE_TYPE, what)
    rough = F.regexp_replace(text, r"[\x09-\x0D ]", "").try_cast("double")
    whole = (number == F.floor(number)) & (rough == F.floor(rough))
    judged = (
        F.when(number.isNull(), F.lit(None).cast("int"))
        .when(whole, strict_cast(number, "int", what))
        .otherwise(F.raise_error(F.concat(F.lit(f"fractional {what}: "), text)).cast("int"))
    )
    plain = F.when(text.rlike(PLAIN_INTEGER), F.substring_index(text, ".", 1).try_cast("int"))
    digits = F.when(text.rlike(INTEGER_TEXT), text.try_cast("int"))
    return F.coalesce(plain, digits, judged)  # plain digits need no judging


def nan_to_null(col: Column | str) -> Column:
    """Floating NaN to NULL (what leaves the process must be a real NULL)."""
    c = _col(col)
    return F.when(~F.isnan(c), c)

