"""Raw batch to landed tables: loans with type-2 history, payments into the ledger."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import (
    REASON, accepted, classify_loans, classify_payments, rejected, with_loan_hash,
)
from ..operators.dedup import first_per_key, last_per_key
from ..operators.keys import dense_keys, highest_key
from ..operators.ledger import LEDGER_KEY, allocate, first_not_yet_booked, not_yet_booked, within_reach
from ..schemas import LND_ERR_LOAN, LND_ERR_PAYMENT, LND_PAYMENT, POSITION, conform
from ..settings import LOAN_FILE_COLUMNS, PAYMENT_FILE_COLUMNS

LINEAGE = ["_source_file", "_last_updated_ts"]
Keep = Callable[[DataFrame], DataFrame]
RAW_PAYMENT_KEY = ["payment_id", "amount", "payment_timestamp"]


def _as_counters(one_row: DataFrame) -> DataFrame:
    """One row of counts as rows (counter, n)."""
    return one_row.unpivot([], one_row.columns, "counter", "n")


def as_is(df: DataFrame) -> DataFrame:
    return df


def judged_counts() -> list[Column]:
    """Of rows that were deduplicated and judged."""
    return [F.count("*").alias("rows_deduplicated"), F.count_if(F.col(REASON).isNotNull()).alias("rows_rejected")]


def fate_counts() -> list[Column]:
    """Of the accepted loans with their `_action`."""
    return [F.count_if(F.col("_action") == a).alias(f"rows_{a}") for a in ("new", "changed", "unchanged")]


class LoanLanding(NamedTuple):
    incoming: DataFrame
    errors: DataFrame
    judged: DataFrame


def clean_loan_batch(raw_batch: DataFrame, rejected_at: datetime,
                     order: list[str] | None = None, keep: Keep = as_is) -> LoanLanding:
    """Last occurrence per loan id, then cleaning: a broken last row hides a good earlier
    one. `order` names the columns that say what came later; `keep` may write the judged
    rows down, as accepted and rejected rows are both taken from them."""
    order = order or [POSITION]
    latest = last_per_key(raw_batch, "loan_id", order)
    judged = keep(classify_loans(latest))
    incoming = with_loan_hash(accepted(judged, [*LINEAGE, *order]))
    stamp = F.lit(rejected_at).cast("timestamp")
    errors = rejected(judged, [*LOAN_FILE_COLUMNS, *LINEAGE], stamp)
    return LoanLanding(incoming, conform(errors, LND_ERR_LOAN), judged)


def loan_counters(raw_batch: DataFrame, landing: LoanLanding, changes: DataFrame) -> DataFrame:
    """rows_in, deduplicated, rejected, and what `changes` says of the accepted rows: one scan
    of each."""
    return (_as_counters(raw_batch.agg(F.count("*").alias("rows_in")))
            .unionByName(_as_counters(landing.judged.agg(*judged_counts())))
            .unionByName(_as_counters(changes.agg(*fate_counts()))))


class PaymentLanding(NamedTuple):
    new_rows: DataFrame
    errors: DataFrame
    judged: DataFrame
    clean: DataFrame


def clean_payment_batch(raw_batch: DataFrame, ledger: DataFrame, rejected_at: datetime,
                        order: list[str] | None = None, keep: Keep = as_is,
                        keep_clean: Keep = as_is, keep_new: Keep = as_is) -> PaymentLanding:
    """First occurrence per raw key, cleaning, first occurrence per typed key, then only what
    the ledger does not hold yet. The `keep` functions may write each step down, as more than
    one later step reads it.

    Verdict and typed key follow from the raw key alone, so the first row of a typed key is the
    same with exact copies and without: where the judged rows are not written down, the clean rows
    come from the raw batch with one deduplication. Where the clean rows are not written down either,
    that deduplication also meets the ledger."""
    order = order or [POSITION]
    judged = keep(classify_payments(first_per_key(raw_batch, RAW_PAYMENT_KEY, order)))
    source = classify_payments(raw_batch) if keep is as_is else judged
    typed = accepted(source, [*LINEAGE, *order])
    clean = keep_clean(first_per_key(typed, list(LEDGER_KEY), order))
    stamp = F.lit(rejected_at).cast("timestamp")
    errors = rejected(judged, [*PAYMENT_FILE_COLUMNS, *LINEAGE], stamp)
    if keep_clean is as_is:
        new_rows = first_not_yet_booked(typed, ledger, order)
    else:
        new_rows = not_yet_booked(clean, within_reach(ledger, clean))
    return PaymentLanding(keep_new(new_rows), conform(errors, LND_ERR_PAYMENT), judged, clean)


def book_payments(new_rows: DataFrame, ledger: DataFrame, standing: DataFrame,
                  order: list[str] | None = None) -> DataFrame:
    """New ledger rows with allocation status and surrogate keys continuing the ledger's."""
    placed = allocate(new_rows, standing)
    keyed = dense_keys(placed, order or [POSITION], highest_key(ledger, "lnd_payment_sk"),
                       "lnd_payment_sk")
    return conform(keyed, LND_PAYMENT)


def split_settlement_count(judged: DataFrame) -> DataFrame:
    """One row: the second and later distinct rows of an id, that is rows with an id minus ids."""
    per_id = judged.where(F.col("payment_id").isNotNull()).groupBy("payment_id").agg(F.count("*").alias("n"))
    return per_id.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_split_settlement"))


def payment_counters(raw_batch: DataFrame, landing: PaymentLanding) -> DataFrame:
    """rows_in, rows after each deduplication, rejected, new, and split settlement rows."""
    def rows(df: DataFrame, name: str) -> DataFrame:
        return _as_counters(df.agg(F.count("*").alias(name)))

    return (rows(raw_batch, "rows_in").unionByName(_as_counters(landing.judged.agg(*judged_counts())))
            .unionByName(rows(landing.clean, "rows_clean")).unionByName(rows(landing.new_rows, "rows_inserted"))
            .unionByName(_as_counters(split_settlement_count(landing.judged))))
