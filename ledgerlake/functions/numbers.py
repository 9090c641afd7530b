"""Strict numeric text: NULL stays NULL, anything that is not a plain number is bad.

The text passed in must be trimmed already, with blank turned into NULL.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits may be grouped with single underscores; NaN and infinities are not numbers here.
DECIMAL_TEXT = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"
INTEGER_TEXT = r"^[+-]?\d+(_\d+)*$"


class Parsed(NamedTuple):
    """A typed value and whether the text was there but unusable."""

    value: Column
    bad: Column


def _typed(text: Column, pattern: str, dtype: str) -> Parsed:
    value = F.when(text.rlike(pattern), F.replace(text, F.lit("_"), F.lit("")).try_cast(dtype))
    return Parsed(value, text.isNotNull() & value.isNull())


def parse_decimal(text: Column, dtype: str) -> Parsed:
    return _typed(text, DECIMAL_TEXT, dtype)


def parse_integer(text: Column) -> Parsed:
    return _typed(text, INTEGER_TEXT, "int")


def money_digits(text: Column) -> Column:
    """Money text without `$`, `,` and whitespace; NULL when nothing or only `-` is left."""
    squeezed = F.regexp_replace(text, r"(?U)[$,\s]", "")
    return F.when(~squeezed.isin("", "-"), squeezed)


def parse_money(digits: Column) -> Parsed:
    """Money from the output of `money_digits`."""
    return parse_decimal(digits, "decimal(18,2)")


def rounded(value: Column, places: int) -> Column:
    """Round a DOUBLE as SQL engines commonly do: scale, round half up, scale back.

    Spark's own `round` works on the shortest decimal text of the value instead, and the two
    differ where a product lands just beside a half.
    """
    scale = float(10 ** places)
    return F.round(value * scale) / scale
