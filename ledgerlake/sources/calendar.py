"""The date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns
from ..schemas import DIM_DATE, conform

SPAN_YEARS = 40


def date_bounds(today: date, years: int = SPAN_YEARS) -> tuple[date, date]:
    """`years` before and after `today`; 29 February moves to the 28th where needed."""
    def shifted(by: int) -> date:
        try:
            return today.replace(year=today.year + by)
        except ValueError:
            return today.replace(year=today.year + by, day=28)
    return shifted(-years), shifted(years)


def dim_date(spark: SparkSession, lower: date, upper: date) -> DataFrame:
    """One row per day, both bounds included."""
    days = F.explode(F.sequence(F.lit(lower), F.lit(upper), F.expr("interval 1 day")))
    spine = spark.range(1).select(days.alias("day"))
    named = [c.alias(n) for n, c in calendar_columns(F.col("day")).items()]
    return conform(spine.select(*named), DIM_DATE)
