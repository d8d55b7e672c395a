"""Column-returning helpers: every one is a built-in Spark expression."""

from .misc import NA_TOKENS, boolean_option, null_na_tokens, parse_bool
from .numbers import nan_to_null, strict_cast, to_integer, to_number
from .text import clean_text, strip_unicode, truncate
from .times import days_between, strict_timestamp, to_datetime

__all__ = [
    "NA_TOKENS", "clean_text", "days_between", "nan_to_null", "null_na_tokens",
    "boolean_option", "parse_bool", "strict_cast", "strict_timestamp", "strip_unicode", "to_datetime",
    "to_integer", "to_number", "truncate",
]
