"""Small helpers: truthy words, missing-value tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip_unicode

# Words accepted as booleans (stripped, in any case).
BOOLEAN_WORDS = {
    "1": True, "true": True, "yes": True, "y": True,
    "0": False, "false": False, "no": False, "n": False,
}

# Cells read as missing on CSV ingest, compared exactly.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def parse_bool(col: Column | str) -> Column:
    """The boolean that a word stands for; any other value, NULL included, fails the job."""
    c = F.col(col) if isinstance(col, str) else col
    words = F.create_map(*[F.lit(x) for pair in BOOLEAN_WORDS.items() for x in pair])
    found = F.try_element_at(words, F.lower(strip_unicode(c)))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("not a boolean word: "), F.coalesce(c, F.lit("NULL")))).cast("boolean"))


def boolean_option(value: str | bool) -> bool:
    """A job parameter as a boolean, by the same words."""
    found = value if isinstance(value, bool) else BOOLEAN_WORDS.get(value.strip().lower())
    if found is None:
        raise ValueError(f"not a boolean word: {value!r}")
    return found


def null_na_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every string cell equal to a missing-value token becomes NULL."""
    cols = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.select(*[
        (F.when(~F.col(c).isin(*NA_TOKENS), F.col(c)).alias(c) if c in cols else F.col(c))
        for c in df.columns
    ])
