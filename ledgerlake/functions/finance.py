"""Instalments, anomaly and delinquency rules, balance classes, row fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import rounded


def _annuity(principal: Column, rate_pct: Column, months: Column) -> Column:
    """Level instalment in DOUBLE. With v = (1+r)^n it is P*r*v/(v-1)."""
    monthly = rate_pct.cast("double") / 12.0 / 100.0
    growth = F.pow(1.0 + monthly, months.cast("double"))
    return F.try_divide(principal.cast("double") * monthly * growth, growth - 1.0)


def _flat(principal: Column, months: Column) -> Column:
    return F.try_divide(principal.cast("double"), months.cast("double"))


def expected_emi(principal: Column, rate_pct: Column, months: Column) -> Column:
    """Instalment as the staging table defines it: an empty rate counts as zero."""
    without_interest = rate_pct.isNull() | (rate_pct == 0)
    return (
        F.when(without_interest, rounded(_flat(principal, months), 2))
        .otherwise(rounded(_annuity(principal, rate_pct, months), 2))
        .try_cast("decimal(18,2)")
    )


def strict_emi_error(principal: Column, rate_pct: Column, months: Column) -> Column:
    """Why the strict form refuses these inputs; NULL when it does not."""
    complete = principal.isNotNull() & rate_pct.isNotNull() & months.isNotNull()
    return (
        F.when(~complete, F.lit(None).cast("string"))
        .when(principal < 0,
              F.concat(F.lit("principal is below zero: "), principal.cast("string")))
        .when(rate_pct < 0,
              F.concat(F.lit("rate is below zero: "), rate_pct.cast("string")))
        .when(months <= 0,
              F.concat(F.lit("term is not positive: "), months.cast("string")))
    )


def strict_emi(principal: Column, rate_pct: Column, months: Column) -> Column:
    """Instalment that is NULL on any empty input and on inputs the strict form refuses."""
    usable = (principal >= 0) & (rate_pct >= 0) & (months > 0)
    return F.when(usable, expected_emi(principal, rate_pct, months))


def deviation(actual: Column, expected: Column) -> Column:
    """Relative distance from the expected instalment; NULL where that is NULL or 0."""
    a, e = actual.cast("double"), expected.cast("double")
    return F.try_divide(F.abs(a - e), e)


def anomaly_flag_three_valued(actual: Column, expected: Column, tolerance: float) -> Column:
    """FALSE without an amount, NULL without a usable instalment."""
    return F.when(actual.isNull(), F.lit(False)).otherwise(
        deviation(actual, expected) > F.lit(tolerance))


def anomaly_flag(actual: Column, expected: Column, tolerance: float) -> Column:
    """As above with every undecided case FALSE."""
    return F.coalesce(anomaly_flag_three_valued(actual, expected, tolerance), F.lit(False))


def anomaly_reason(actual: Column, expected: Column, tolerance: float) -> Column:
    a, e = actual.cast("double"), expected.cast("double")
    return (
        F.when(a < e * (1.0 - tolerance), F.lit("UNDERPAYMENT"))
        .when(a > e * (1.0 + tolerance), F.lit("OVERPAYMENT"))
        .otherwise(F.lit("ANOMALOUS"))
    )


def delinquency_flag(status: Column, last_paid: Column, originated: Column, as_of: Column,
                     days: int) -> Column:
    """Active loan with no payment, or none in the last `days` days. `last_paid` and
    `originated` are dates; an empty status is treated like an active one."""
    return (
        F.when(status != "active", F.lit(False))
        .when(last_paid.isNull() & (F.date_diff(as_of, originated) > days), F.lit(True))
        .when(last_paid.isNotNull() & (F.date_diff(as_of, last_paid) > days), F.lit(True))
        .otherwise(F.lit(False))
    )


def overdue_flag(last_paid: Column, due: Column, as_of: Column, grace_days: Column) -> Column:
    """Due-date rule: past the grace period and not paid on or after the due date."""
    past_grace = F.date_diff(as_of, due) > grace_days
    unpaid = last_paid.isNull() | (last_paid < due)
    return F.when(due > as_of, F.lit(False)).otherwise(past_grace & unpaid)


def balance_type(principal: Column) -> Column:
    return (
        F.when(principal < 0, F.lit("credit_balance"))
        .when(principal == 0, F.lit("zero_balance"))
        .otherwise(F.lit("debit_balance"))
    )


def row_hash(columns: list[Column]) -> Column:
    """MD5 over the cleaned values joined by `|`; an empty value is written `None`."""
    parts = [F.coalesce(c.cast("string"), F.lit("None")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))
