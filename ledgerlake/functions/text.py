"""Trimming, blank-to-NULL and category normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character that counts as surrounding whitespace in the source files.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Without surrounding whitespace. Text that begins and ends with a printable ASCII character
    has none, and is passed on without a look at every character; its end is known by the last byte."""
    last = F.substring(c.cast("binary"), -1, 1)
    bare = (c >= "!") & (c < "\x7f") & last.between(F.lit(b"!"), F.lit(b"~"))
    return F.when(bare, c).otherwise(F.btrim(c, F.lit(WHITESPACE)))


def clean_string(c: Column) -> Column:
    """Trimmed text; blank becomes NULL, inner spaces stay."""
    return F.nullif(strip(c), F.lit(""))


def normalise_category(c: Column) -> Column:
    """Trimmed lower-case text; blank becomes NULL."""
    return F.lower(clean_string(c))


def clean_strings(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: clean_string(F.col(c)) for c in columns})


def quoted(c: Column) -> Column:
    """The value in single quotes, as rejection messages show it."""
    return F.concat(F.lit("'"), c, F.lit("'"))
