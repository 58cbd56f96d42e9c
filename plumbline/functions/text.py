"""Text helpers shared by the scan and the timestamp operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every code point that counts as whitespace at the ends of a source line.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(value: Column) -> Column:
    """Trim all whitespace; Spark's plain ``trim`` removes the blank only."""
    return F.btrim(value, F.lit(WHITESPACE))
