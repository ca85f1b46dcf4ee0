"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The characters Unicode calls white space, as text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """Remove leading and trailing white space of any Unicode kind; NULL stays NULL.

    A character set is cheaper than a regular expression on clean values.
    """
    return F.btrim(col, F.lit(WHITE_SPACE))


def has_margin_space(col: Column) -> Column:
    """True when ``strip`` would change the value."""
    return col != strip(col)


def zero_pad(col: Column, width: int = 5) -> Column:
    """Left-pad with zeros up to ``width``; longer values are kept whole."""
    return F.when(F.length(col) < width, F.lpad(col, width, "0")).otherwise(col)


def postal_code(col: Column) -> Column:
    """``1040``, ``1040.0`` -> ``01040``."""
    return zero_pad(F.split_part(col.cast("string"), F.lit("."), F.lit(1)), 5)
