"""Orphan payments: id ranges, samples, neighbouring loans, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.neighbours import nearest_numbers
from ..operators.quality import orphans
from ..session import materialise

ID_PREFIX = "L"


def id_number(loan_id: Column, prefix: str = ID_PREFIX) -> Column:
    """The number behind the letter prefix; NULL when the rest is no number."""
    return F.replace(loan_id, F.lit(prefix), F.lit("")).try_cast("bigint")


def _number_range(ids: DataFrame, label: str) -> DataFrame:
    """Range and gaps of one id set; distinct ids are counted on the already reduced set."""
    n = id_number(F.col("loan_id"))
    distinct = ids.select("loan_id").where(F.col("loan_id").isNotNull()).distinct()
    prefixed = F.col("loan_id").like(f"{ID_PREFIX}%")
    found = distinct.agg(
        F.min(F.when(prefixed, n)).alias("min_num"), F.max(F.when(prefixed, n)).alias("max_num"),
        F.count("*").alias("distinct_ids"))
    return found.select(F.lit(label).alias("id_set"), "*",
                        (F.col("max_num") - F.col("distinct_ids")).alias("gap"))


def id_range(payments: DataFrame, raw_loans: DataFrame) -> DataFrame:
    """Smallest and largest number, distinct ids and missing ids of orphans and raw loans."""
    strays = orphans(payments, raw_loans, "loan_id")
    return _number_range(strays, "orphan").unionByName(_number_range(raw_loans, "raw_loan"))


def orphan_sample(payments: DataFrame, raw_loans: DataFrame, rows: int = 10) -> DataFrame:
    """The first few orphan payments by loan id."""
    strays = orphans(payments, raw_loans, "loan_id")
    pay_date = F.to_date("payment_timestamp").alias("pay_date")
    return (strays.select("loan_id", "amount", "payment_method_type", pay_date, "payment_id")
            .orderBy("loan_id", "payment_id", "amount", "pay_date", "payment_method_type")
            .limit(rows))


def nearest_ids(payments: DataFrame, raw_loans: DataFrame) -> DataFrame:
    """For each orphan loan id, the closest existing loan numbers below and above.

    The orphan ids are written down: both the search and the last join read them.
    """
    strays = materialise(orphans(payments.select("loan_id").distinct(), raw_loans, "loan_id"), "strays")
    strays = strays.withColumn("orphan_num", id_number(F.col("loan_id")))
    known = raw_loans.select(id_number(F.col("loan_id")).alias("orphan_num"))
    found = nearest_numbers(strays, known, "orphan_num")
    return strays.join(found, "orphan_num", "left").select(
        F.col("loan_id").alias("orphan_id"), "orphan_num", "closest_below", "closest_above")
