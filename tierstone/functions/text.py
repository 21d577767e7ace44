"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierstone.functions.times import col_of

# Line characters dropped anywhere in a value, the whitespace trimmed at
# its ends, and the word that stands for "no value".
DROPPED = "\r\n\t\u2028\u2029"
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NULL_WORD = "null"


def clean_str(value: Column | str) -> Column:
    """Drop line characters, trim Unicode whitespace; blank or 'null' becomes NULL."""
    flat = F.translate(col_of(value).cast("string"), DROPPED, "")
    trimmed = F.btrim(flat, F.lit(WHITESPACE))
    # One character more than the word is enough to tell it from longer values.
    head = F.lower(F.substring(trimmed, 1, len(NULL_WORD) + 1))
    return F.when(~head.isin("", NULL_WORD), trimmed)


def is_filled(value: Column | str) -> Column:
    """Not NULL and not blank after trimming."""
    return col_of(value).isNotNull() & (F.trim(col_of(value)) != "")


def truncated(value: Column | str, length: int) -> Column:
    return F.substring(col_of(value), 1, length)
