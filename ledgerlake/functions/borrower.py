"""Borrower attributes out of the JSON text a loan row carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import parse_decimal, parse_integer
from .stages import computed
from .text import clean_string, strip

# Employment entries that count as "not given".
EMPTY_JSON_VALUES = ("", "0", "false", "[]", "{}")


def _kind(document: Column, path: str) -> Column:
    """STRING, BOOLEAN, BIGINT, DECIMAL(..), DOUBLE, OBJECT<..>, ARRAY<..>, VOID or NULL."""
    return F.schema_of_variant(F.try_variant_get(document, path, "variant"))


def _whole_number(document: Column, path: str) -> Column:
    """A JSON number is cut to its whole part; JSON text must itself be a whole number."""
    text = F.try_variant_get(document, path, "string")
    kind = _kind(document, path)
    return (
        F.when(kind == "STRING", parse_integer(clean_string(text)).value)
        .when(kind == "BOOLEAN", F.try_variant_get(document, path, "boolean").cast("int"))
        .otherwise(F.try_variant_get(document, path, "double")
                   .try_cast("bigint").try_cast("int"))
    )


def _amount(document: Column, path: str) -> Column:
    text = F.try_variant_get(document, path, "string")
    kind = _kind(document, path)
    return (
        F.when(kind == "BOOLEAN", F.try_variant_get(document, path, "boolean")
               .cast("int").cast("decimal(18,2)"))
        .otherwise(parse_decimal(clean_string(text), "decimal(18,2)").value)
    )


def with_borrower(df: DataFrame, raw: str = "borrower_info") -> DataFrame:
    """Add credit_score, employment_type, annual_income, years_employed and
    borrower_warning.

    Each field is NULL where missing or unusable. The warning marks text that is no JSON
    object at all; blank text is simply empty and gives no warning.
    """
    text = clean_string(F.col(raw))
    parsed = df.withColumn("_borrower", F.try_parse_json(text))
    document = F.col("_borrower")
    is_object = F.coalesce(F.schema_of_variant(document).startswith("OBJECT"), F.lit(False))
    employment = F.try_variant_get(document, "$.employment", "string")
    return computed(parsed, {
        "credit_score": _whole_number(document, "$.credit_score"),
        "employment_type": F.when(~employment.isin(*EMPTY_JSON_VALUES),
                                  F.lower(strip(employment))),
        "annual_income": _amount(document, "$.annual_income"),
        "years_employed": _whole_number(document, "$.years_employed"),
        "borrower_warning": text.isNotNull() & ~is_object,
    }, keep=df.columns)
