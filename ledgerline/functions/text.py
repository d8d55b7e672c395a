"""Text cleaning as Column expressions (JVM side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reuse import made_once

# The characters stripped from both ends of a text value. This is
# Python's `str.isspace()` set -- Unicode White_Space plus the four ASCII
# information separators 0x1C-0x1F. A zero-width space (U+200B) is not in it.
WHITESPACE_CODEPOINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)
# The first ASCII character that is visible, and the first after them; text compares by its bytes.
VISIBLE = ("!", "\x7f")

def strip_unicode(col: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace.

    ``btrim`` with an explicit character set compares whole code points and
    needs no regex; plain ``trim`` would only strip spaces. It searches the set for
    each end and indexes every character, so text that begins and ends with a visible
    ASCII character (two comparisons of bytes an end) is handed on as it is.
    """
    c = (F.col(col) if isinstance(col, str) else col).cast("string")
    last = F.substring(c, -1, 1)
    visible = (c >= VISIBLE[0]) & (c < VISIBLE[1]) & (last >= VISIBLE[0]) & (last < VISIBLE[1])
    return F.when(visible, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


FOLDS = {None: lambda c: c, "upper": F.upper, "lower": F.lower}


@made_once
def clean_text(col: Column | str, case: str | None = None) -> Column:
    """Text without surrounding white space, NULL if nothing is left, folded to ``case``."""
    return F.nullif(FOLDS[case](strip_unicode(col)), F.lit(""))


def truncate(col: Column | str, length: int) -> Column:
    """First ``length`` characters (log messages are cut at 1000)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.substring(c, 1, length)
