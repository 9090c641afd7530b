"""Staging and the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.borrower import with_borrower
from ..functions.finance import (
    anomaly_flag_three_valued, balance_type, delinquency_flag, expected_emi,
)
from ..schemas import DIM_CUSTOMER, FCT_LOAN, FCT_PAYMENT, STG_LOAN_PAYMENT, conform
from ..settings import DEFAULT_RULES, Rules

LOAN_TERMS = ("principal_amount", "interest_rate", "term_months")


def _loan_columns() -> dict[str, Column]:
    """What follows from the loan alone; computed before any join multiplies the rows."""
    return {
        "expected_emi": expected_emi(*[F.col(c) for c in LOAN_TERMS]),
        "final_due_date": F.add_months("origination_date", F.col("term_months")),
        "loan_balance_type": balance_type(F.col("principal_amount")),
    }


def stg_loan_payment(loans: DataFrame, payments: DataFrame, as_of: date, now: Column,
                     rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Current loans with their payments; loans without any stay, orphan payments drop.

    The payments of a hot loan are a side of an inner join, which adaptive execution splits;
    loans without payments are added by an anti join with the distinct loan ids.
    """
    current = (loans.where("is_current_flag").drop("_last_updated_ts")
               .withColumnRenamed("status", "loan_status").withColumns(_loan_columns()))
    booked = payments.select(
        "loan_id", "lnd_payment_sk", "payment_id", F.col("amount").alias("payment_amount"),
        "payment_timestamp", "payment_method_type", "payment_method_last_four",
        "payment_method_bank", "metadata_source", "metadata_user_agent")
    paid = booked.where(F.col("loan_id").isNotNull())
    unpaid = current.join(paid.select("loan_id").distinct(), "loan_id", "left_anti")
    joined = current.join(paid, "loan_id").unionByName(unpaid, allowMissingColumns=True)
    paid_on, today = F.to_date("payment_timestamp"), F.lit(as_of)
    return conform(joined.withColumns({
        "days_since_payment": F.date_diff(today, paid_on),
        "is_delinquent": delinquency_flag(F.col("loan_status"), paid_on,
                                          F.col("origination_date"), today,
                                          rules.delinquency_days),
        "is_payment_anomalous": anomaly_flag_three_valued(
            F.col("payment_amount"), F.col("expected_emi"), rules.anomaly_tolerance),
        "_last_updated_ts": now,
    }), STG_LOAN_PAYMENT)


def latest_customer_loans(loans: DataFrame) -> DataFrame:
    """Each customer's most recently originated current loan; an empty date counts as
    oldest and the smaller loan_id wins a tie."""
    never = 1 << 40
    age = F.coalesce(-F.unix_date("origination_date").cast("bigint"), F.lit(never))
    candidates = loans.where(F.col("is_current_flag") & F.col("customer_id").isNotNull())
    newest = F.struct(age.alias("_age"), F.col("loan_id"), F.col("borrower_info"))
    return (candidates.groupBy("customer_id").agg(F.min(newest).alias("_loan"))
            .select("customer_id", "_loan.loan_id", "_loan.borrower_info"))


def dim_customer(loans: DataFrame, now: Column) -> DataFrame:
    chosen = with_borrower(latest_customer_loans(loans))
    return conform(chosen.withColumns({"_source_loan_id": F.col("loan_id"),
                                       "_last_updated_ts": now}), DIM_CUSTOMER)


def _with_dimensions(facts: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Customers join by key, with Spark choosing the strategy from their size. The calendar
    has one row per day of a fixed span, so it is always broadcast."""
    profile = customers.select("customer_id", "credit_score", "employment_type", "annual_income")
    days = dates.select(F.col("full_date").alias("origination_date"),
                        F.col("date_id").alias("origination_date_id"))
    return (facts.join(profile, "customer_id", "left")
            .join(F.broadcast(days), "origination_date", "left"))


def _payment_measures(amount: str) -> list[Column]:
    return [
        F.max(amount).alias("last_payment_amount"),
        F.max("payment_timestamp").alias("last_payment_timestamp"),
        F.count("payment_id").alias("total_payment_count"),
        F.sum(amount).alias("total_paid_amount"),
    ]


def _with_recency(facts: DataFrame, as_of: date, rules: Rules) -> DataFrame:
    last, today = F.to_date("last_payment_timestamp"), F.lit(as_of)
    return facts.withColumns({
        "days_since_last_payment": F.date_diff(today, last),
        "is_delinquent": delinquency_flag(F.col("loan_status"), last, F.col("origination_date"),
                                          today, rules.delinquency_days),
    })


def fct_loan(loans: DataFrame, payments: DataFrame, customers: DataFrame, dates: DataFrame,
             as_of: date, now: Column, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per current loan, delinquent or not by its latest payment.

    Payments shrink to one row per loan on the map side before they meet the loans, so the
    join is one to one and no loan is hot.
    """
    current = (loans.where("is_current_flag").drop("_last_updated_ts")
               .withColumnRenamed("status", "loan_status").withColumns(_loan_columns()))
    paid = (payments.where(F.col("loan_id").isNotNull()).groupBy("loan_id")
            .agg(*_payment_measures("amount")))
    facts = current.join(paid, "loan_id", "left").withColumn(
        "total_payment_count", F.coalesce("total_payment_count", F.lit(0)))
    facts = _with_recency(facts, as_of, rules)
    return conform(_with_dimensions(facts, customers, dates).withColumn("_last_updated_ts", now),
                   FCT_LOAN)


LOAN_GRAIN = ("loan_id", "customer_id", "product_type", *LOAN_TERMS, "origination_date",
              "origination_channel", "loan_status", "loan_balance_type", "expected_emi",
              "final_due_date")


def fct_loan_from_stg(stg: DataFrame, customers: DataFrame, dates: DataFrame, as_of: date,
                      now: Column, grain: str = "loan",
                      rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The loan fact out of staging rows.

    `grain="loan"` gives what `fct_loan` gives. `grain="reference"` also groups by the
    per-payment delinquency flag, so a loan with one old and one recent payment has two rows.
    Dimensions join after the grouping: they depend on grouping columns only.
    """
    keys = list(LOAN_GRAIN) + (["is_delinquent"] if grain == "reference" else [])
    facts = stg.groupBy(*keys).agg(
        *_payment_measures("payment_amount"),
        F.min("days_since_payment").alias("days_since_last_payment"))
    if grain == "loan":
        facts = _with_recency(facts, as_of, rules)
    return conform(_with_dimensions(facts, customers, dates).withColumn("_last_updated_ts", now),
                   FCT_LOAN)


def fct_payment(stg: DataFrame, dates: DataFrame, now: Column) -> DataFrame:
    """One row per payment of a known loan."""
    days = dates.select(F.col("full_date").alias("_day"), F.col("date_id").alias("payment_date_id"))
    facts = (stg.where(F.col("payment_id").isNotNull())
             .withColumn("_day", F.to_date("payment_timestamp"))
             .join(F.broadcast(days), "_day", "left").withColumn("_last_updated_ts", now))
    return conform(facts, FCT_PAYMENT)
