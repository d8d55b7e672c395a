"""Timestamp parsing and arithmetic; everything is TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reuse import made_once
from .text import strip_unicode

# Accepted layouts: a date, or a date and a time of day to the second with any fraction, joined by a blank or T.
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?)?$"

MICROS_PER_DAY = 86_400_000_000


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


@made_once
def to_datetime(col: Column | str) -> Column:
    """Lenient parse: one of the accepted layouts, else NULL (bad dates such as Feb 30 too).

    Fractions of a second are cut to microseconds.
    """
    text = strip_unicode(_col(col))
    micros = F.when(F.length(text) > 26, F.regexp_replace(text, r"(\.[0-9]{6})[0-9]+$", "$1")).otherwise(text)
    return F.when(text.rlike(TIMESTAMP_PATTERN), micros.try_cast("timestamp_ntz"))


@made_once
def strict_timestamp(col: Column | str) -> Column:
    """The same parse for the batch scan, where a bad value fails the run (whatever the ANSI setting).

    What the scan accepts the cleaner accepts, so no scanned order is lost behind the watermark.
    """
    c = _col(col).cast("string")
    refused = F.raise_error(F.concat(F.lit("invalid timestamp: "), c)).cast("timestamp_ntz")
    return F.coalesce(to_datetime(c), F.when(c.isNotNull(), refused))  # parsed once


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Fractional days ``later - earlier`` as DOUBLE; negative when reversed."""
    micros = F.timestamp_diff("MICROSECOND", _col(earlier), _col(later))
    return micros.cast("double") / F.lit(float(MICROS_PER_DAY))
