"""Whole-row cleaning: typed columns plus the first rule the row breaks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import LOAN_FILE_COLUMNS, PAYMENT_FILE_COLUMNS, TRACKED_LOAN_COLUMNS
from .dates import parse_date, parse_timestamp
from .finance import row_hash
from .numbers import money_digits, parse_decimal, parse_integer, parse_money
from .stages import computed
from .text import clean_string, quoted

REASON = "_rejection_reason"


def _first_failure(prefix: Column, rules: list[tuple[Column, Column]]) -> Column:
    """The message of the first broken rule, behind `prefix`; NULL when none is broken.

    Whether it is NULL follows from the rules alone, so accepted rows need neither the message nor
    the raw texts that it shows.
    """
    broken = reduce(lambda a, b: a | b, [bad for bad, _ in rules])
    failed = F.coalesce(*[F.when(bad, message) for bad, message in rules])
    return F.when(broken, F.coalesce(F.concat(prefix, failed), F.lit("")))


def _complaint(what: str, raw: Column) -> Column:
    return F.concat(F.lit(f"{what}: "), quoted(raw))


def _fixed(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """`df` plus parsed `values`, which no later filter evaluates again."""
    return computed(df.withColumns(values), {name: F.col(name) for name in values})


def classify_loans(raw: DataFrame) -> DataFrame:
    """Add `_clean` (struct of typed columns) and the rejection reason to raw loan rows.

    Rules in order: key, rate, term, principal, date. Accepted rows have no reason. Trimming,
    parsing and judging are separate steps, so each text is trimmed and parsed once. Only the parsed
    values are kept apart from filters on the reason; columns that nobody reads are not made.
    """
    text = {c: clean_string(F.col(c)).alias(f"_t_{c}") for c in LOAN_FILE_COLUMNS}
    text["principal_amount"] = money_digits(clean_string(F.col("principal_amount"))).alias(
        "_t_principal_amount")
    trimmed = raw.select("*", *text.values())
    t = {c: F.col(f"_t_{c}") for c in LOAN_FILE_COLUMNS}
    parsed = _fixed(trimmed, {
        "_rate": parse_decimal(t["interest_rate"], "decimal(8,4)").value,
        "_term": parse_integer(t["term_months"]).value,
        "_principal": parse_money(t["principal_amount"]).value,
        "_date": parse_date(t["origination_date"]).value,
    })

    def unusable(column: str, value: str) -> Column:
        return t[column].isNotNull() & F.col(value).isNull()

    shown = F.coalesce(F.col("loan_id"), F.lit("None"))
    reason = _first_failure(
        F.concat(F.lit("loan_id="), shown, F.lit(": ")),
        [
            (t["loan_id"].isNull(), F.lit("loan_id is missing")),
            (unusable("interest_rate", "_rate"),
             _complaint("interest_rate is no decimal", F.col("interest_rate"))),
            (unusable("term_months", "_term"),
             _complaint("term_months is no whole number", F.col("term_months"))),
            (unusable("principal_amount", "_principal"),
             _complaint("principal_amount is no sum of money", F.col("principal_amount"))),
            (unusable("origination_date", "_date"),
             _complaint("origination_date is no date", F.col("origination_date"))),
        ],
    )
    typed = F.struct(
        t["loan_id"].alias("loan_id"),
        t["customer_id"].alias("customer_id"),
        F.lower(t["product_type"]).alias("product_type"),
        F.col("_principal").alias("principal_amount"),
        F.col("_rate").alias("interest_rate"),
        F.col("_term").alias("term_months"),
        F.col("_date").alias("origination_date"),
        F.lower(t["origination_channel"]).alias("origination_channel"),
        F.lower(t["status"]).alias("status"),
        t["borrower_info"].alias("borrower_info"),
    )
    return parsed.select(*raw.columns, reason.alias(REASON), typed.alias("_clean"))


def classify_payments(raw: DataFrame) -> DataFrame:
    """As `classify_loans` for payments. Rules in order: key, amount, sign, timestamp."""
    trimmed = raw.select("*", *[clean_string(F.col(c)).alias(f"_t_{c}")
                                for c in PAYMENT_FILE_COLUMNS])
    t = {c: F.col(f"_t_{c}") for c in PAYMENT_FILE_COLUMNS}
    parsed = _fixed(trimmed, {
        "_amount": parse_decimal(t["amount"], "decimal(18,2)").value,
        "_instant": parse_timestamp(t["payment_timestamp"]).value,
    })
    amount, instant = F.col("_amount"), F.col("_instant")
    reason = _first_failure(
        F.when(t["payment_id"].isNull(), F.lit("")).otherwise(
            F.concat(F.lit("payment_id="), F.col("payment_id"), F.lit(": "))),
        [
            (t["payment_id"].isNull(), F.lit("payment_id is missing")),
            (t["amount"].isNotNull() & amount.isNull(),
             _complaint("amount is no number", F.col("amount"))),
            (amount < 0, _complaint("amount is below zero", F.col("amount"))),
            (t["payment_timestamp"].isNotNull() & instant.isNull(),
             _complaint("payment_timestamp is no instant", F.col("payment_timestamp"))),
        ],
    )
    typed = F.struct(
        t["payment_id"].alias("payment_id"),
        t["loan_id"].alias("loan_id"),
        amount.alias("amount"),
        instant.alias("payment_timestamp"),
        F.lower(t["payment_method_type"]).alias("payment_method_type"),
        *[t[c].alias(c) for c in PAYMENT_FILE_COLUMNS[5:]],
    )
    return parsed.select(*raw.columns, reason.alias(REASON), typed.alias("_clean"))


def accepted(classified: DataFrame, keep: list[str]) -> DataFrame:
    """The typed rows that break no rule, with the named lineage columns."""
    return classified.where(F.col(REASON).isNull()).select("_clean.*", *keep)


def rejected(classified: DataFrame, raw_columns: list[str], rejected_at: Column) -> DataFrame:
    """The raw rows that break a rule, with the reason."""
    return classified.where(F.col(REASON).isNotNull()).select(
        *raw_columns, REASON, rejected_at.alias("_rejected_at"))


def with_loan_hash(clean: DataFrame) -> DataFrame:
    return clean.withColumn("_row_hash", row_hash([F.col(c) for c in TRACKED_LOAN_COLUMNS]))
