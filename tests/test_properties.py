"""Property checks of the text rule (R5) against Python's own str.strip()."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.functions import clean_text

# Characters around the edge cases: Unicode spaces, separators, zero-width and plain letters.
ALPHABET = st.sampled_from(
    [" ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ",
     "​", " ", " ", " ", "　", "﻿", "a", "B", "é", "ß", "日", "0"])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=200, max_size=200))
def test_clean_text_equals_python_strip(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", clean_text("x").alias("y")).collect()}
    for i, v in enumerate(values):
        stripped = v.strip()
        assert got[i] == (stripped if stripped else None), repr(v)
