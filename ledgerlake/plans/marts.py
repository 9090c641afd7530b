"""Marts: delinquency by product, anomalous payments, pipeline health."""

from __future__ import annotations

from datetime import date
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.finance import anomaly_reason, deviation
from ..functions.numbers import rounded
from ..operators.audit import latest_audit
from ..operators.batches import hours_between
from ..schemas import MART_DELINQUENCY, MART_OBSERVABILITY, MART_PAYMENT_ANOMALY, conform
from ..settings import ALLOCATION_STATUSES, DEFAULT_RULES, Rules


def mart_delinquency(loan_facts: DataFrame, run_date: date, now: Column) -> DataFrame:
    """Active debit loans by product. Credit balances are owed to the customer and cannot be
    delinquent, so they stay out."""
    late = F.col("is_delinquent")
    by_product = (
        loan_facts
        .where((F.col("loan_status") == "active") & (F.col("loan_balance_type") == "debit_balance"))
        .groupBy("product_type")
        .agg(
            F.count("*").alias("total_active_loans"),
            F.count_if(late).alias("delinquent_loans"),
            F.avg(F.when(late, F.col("days_since_last_payment"))).alias("_days"),
            F.avg(F.when(late, F.col("principal_amount").cast("double"))).alias("_principal"),
        )
    )
    rate = F.col("delinquent_loans") * 100.0 / F.col("total_active_loans")
    return conform(by_product.withColumns({
        "product_type": F.coalesce("product_type", F.lit("unknown")),
        "run_date": F.lit(run_date),
        "delinquency_rate_pct": rounded(rate, 2),
        "avg_days_since_payment": rounded(F.col("_days"), 1),
        "avg_principal_delinquent": rounded(F.col("_principal"), 2),
        "_last_updated_ts": now,
    }), MART_DELINQUENCY).orderBy(F.desc("delinquency_rate_pct"))


def top_product(mart: DataFrame) -> DataFrame:
    """The product with the highest delinquency rate; the first by name on a tie."""
    return (mart.orderBy(F.desc("delinquency_rate_pct"), "product_type").limit(1)
            .select("product_type", "delinquency_rate_pct"))


def mart_payment_anomaly(payment_facts: DataFrame, now: Column,
                         rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Payments off their instalment by more than the tolerance, largest deviation first.
    Loans in credit have no instalment to compare with; an empty status is left out too."""
    paid, expected = F.col("payment_amount"), F.col("expected_emi")
    picked = payment_facts.where(
        F.col("is_payment_anomalous") & F.col("loan_status").isNotNull()
        & (F.col("loan_balance_type") != "credit_balance"))
    return conform(picked.withColumns({
        "deviation_pct": rounded(deviation(paid, expected) * 100.0, 2),
        "anomaly_reason": anomaly_reason(paid, expected, rules.anomaly_tolerance),
        "_last_updated_ts": now,
    }), MART_PAYMENT_ANOMALY).orderBy(F.desc("deviation_pct"))


class SourceHealth(NamedTuple):
    """The tables of one source; a table that does not exist yet is None.

    Pass the rows of one batch for a per-batch report, or whole tables for totals.
    """

    name: str
    raw: DataFrame
    errors: DataFrame | None = None
    facts: DataFrame | None = None
    audit: DataFrame | None = None
    checks: DataFrame | None = None
    ledger: DataFrame | None = None


def _source_parts(source: SourceHealth) -> list[DataFrame]:
    """One-row pieces of a source's report line."""
    raw = source.raw.agg(F.count("*").alias("raw_rows_in_batch"),
                         F.max("_last_updated_ts").alias("latest_batch_ts"))
    parts = [raw]
    if source.errors is not None:
        parts.append(source.errors.agg(F.count("*").alias("lnd_rows_rejected")))
    if source.facts is not None:
        parts.append(source.facts.agg(F.count("*").alias("fct_rows")))
    if source.checks is not None:
        parts.append(source.checks.agg(
            F.count("*").alias("dq_checks_run"),
            F.count_if(F.col("check_result") == "FAIL").alias("dq_checks_failed")))
    if source.audit is not None:
        parts.append(latest_audit(source.audit).select(
            F.col("distinct_keys").alias("raw_distinct_keys"),
            F.col("duplicate_key_count").alias("raw_duplicate_key_count"),
            F.col("true_duplicate_count").alias("raw_true_duplicate_count"),
            F.col("diff_amount_same_id_count").alias("raw_diff_amount_same_id")))
    if source.ledger is not None:
        parts.append(source.ledger.agg(*[
            F.count_if(F.col("payment_allocation_status") == s).alias(f"payments_{s}")
            for s in ALLOCATION_STATUSES]))
    return [p.withColumn("source_name", F.lit(source.name)) for p in parts]


def mart_observability(sources: list[SourceHealth], run_date: date, now: Column) -> DataFrame:
    """One line per source. Every piece is an aggregate of its own table; they are stacked
    and folded by source name instead of joined."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                     [part for s in sources for part in _source_parts(s)])
    folded = stacked.groupBy("source_name").agg(*[
        F.max(c).alias(c) for c in stacked.columns if c != "source_name"])
    for absent in set(MART_OBSERVABILITY.names) - set(folded.columns):
        folded = folded.withColumn(absent, F.lit(None).cast(MART_OBSERVABILITY[absent].dataType))
    zero = F.lit(0).cast("bigint")
    counted = folded.withColumns({
        c: F.coalesce(F.col(c), zero)
        for c in ("lnd_rows_rejected", "fct_rows", "dq_checks_run", "dq_checks_failed")})
    raw_rows = F.col("raw_rows_in_batch")
    accepted = raw_rows - F.col("lnd_rows_rejected")
    rate = F.coalesce(rounded(F.try_divide(accepted * 100.0, raw_rows.cast("double")), 2),
                      F.lit(0.0))
    failed = F.col("dq_checks_failed") > 0
    return conform(counted.withColumns({
        "run_date": F.lit(run_date),
        "lnd_rows_accepted": accepted,
        "acceptance_rate_pct": rate,
        "dq_breach_flag": failed,
        "freshness_hours": rounded(hours_between(F.col("latest_batch_ts"), now), 2),
        "pipeline_status": F.when(failed, "FAIL").otherwise("PASS"),
        "_last_updated_ts": now,
    }), MART_OBSERVABILITY)
