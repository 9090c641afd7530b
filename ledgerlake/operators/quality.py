"""Data-quality checks as audit rows, and the gate that stops a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import LND_DQ_AUDIT, conform
from ..settings import (
    ALLOCATION_STATUSES, DEFAULT_RULES, LOAN_CHANNELS, LOAN_CRITICAL_COLUMNS, LOAN_STATUSES,
    PAYMENT_CRITICAL_COLUMNS, PAYMENT_METHODS, PRODUCT_TYPES, Rules,
)

LOAN_DOMAINS = {
    "product_type": PRODUCT_TYPES, "status": LOAN_STATUSES, "origination_channel": LOAN_CHANNELS,
}
# Families of checks, in the order of their audit rows.
LOAN_FAMILIES = ("volume", "uniqueness", "completeness", "validity")
PAYMENT_FAMILIES = ("volume", "uniqueness", "info", "completeness", "validity", "allocation")
AUDIT_COLUMNS = ("check_name", "check_result", "metric_value", "threshold", "breach_flag",
                 "detail")


class DQGateError(RuntimeError):
    """At least one check breached its threshold."""


def outside(c: Column, domain: tuple[str, ...]) -> Column:
    return c.isNotNull() & ~c.isin(*domain)


def acceptance_rate(total: Column, errors: Column) -> Column:
    """Share of rows that were not rejected; 0.0 when there were none."""
    return F.coalesce(F.try_divide((total - errors).cast("double"), total.cast("double")),
                      F.lit(0.0))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key combinations that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def split_settlement_ids(payments: DataFrame) -> DataFrame:
    """Payment ids booked with more than one amount. Two amounts differ exactly when the
    smallest and largest do, which needs no distinct count."""
    return (
        payments.groupBy("payment_id")
        .agg(F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"),
             F.count("*").alias("row_count"))
        .where(F.col("min_amount") != F.col("max_amount"))
    )


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Children whose key is given but unknown to the parents."""
    return children.where(F.col(key).isNotNull()).join(parents.select(key), key, "left_anti")


def _long(one_row: DataFrame) -> DataFrame:
    """One row of counts as rows (metric, n)."""
    names = one_row.columns
    counts = one_row.select(*[F.col(c).cast("bigint") for c in names])
    return counts.unpivot([], names, "metric", "n")


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """Counts from several scans side by side, without joining them."""
    names = [n for p in parts for n in p.columns]
    stacked = reduce(DataFrame.unionByName, [_long(p) for p in parts])
    return stacked.agg(*[F.max(F.when(F.col("metric") == n, F.col("n"))).alias(n)
                         for n in names])


def _count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


def _check(name: str, result: Column, metric: Column, threshold: Column, breach: Column,
           detail: Column) -> Column:
    values = (F.lit(name), result, metric.cast("double"), threshold.cast("double"), breach,
              detail)
    return F.struct(*[v.alias(n) for n, v in zip(AUDIT_COLUMNS, values)])


def _gated(name: str, metric: Column, threshold: float, breach: Column, detail: Column) -> Column:
    result = F.when(breach, "FAIL").otherwise("PASS")
    return _check(name, result, metric, F.lit(threshold), breach, detail)


def _volume(total: Column, errors: Column, rules: Rules) -> Column:
    rate = acceptance_rate(total, errors)
    detail = F.format_string("accepted %d of %d rows", total - errors, total)
    return _gated("volume_acceptance_rate", rate, rules.acceptance_threshold,
                  rate < rules.acceptance_threshold, detail)


def _completeness(column: str, nulls: Column, total: Column, rules: Rules) -> Column:
    rate = F.try_divide(nulls.cast("double"), total.cast("double"))
    check = _gated(f"completeness_{column}", rate, rules.max_null_rate,
                   rate > rules.max_null_rate,
                   F.format_string(f"empty %d of %d in {column}", nulls, total))
    return F.when(total > 0, check)


def _validity(column: str, invalid: Column, what: str) -> Column:
    return _check(f"validity_{column}", F.when(invalid > 0, "WARN").otherwise("PASS"), invalid,
                  F.lit(0.0), F.lit(False), F.format_string(f"outside the closed set, %d {what}", invalid))


def _audit(row: DataFrame, checks: list[Column], run_id: str, table: str,
           checked_at: Column) -> DataFrame:
    present = F.filter(F.array(*checks), lambda c: c.isNotNull())
    rows = row.select(F.inline(present)).select(
        F.lit(run_id).alias("run_id"), F.lit(table).alias("table_name"), *AUDIT_COLUMNS,
        checked_at.cast("timestamp").alias("checked_at"))
    return conform(rows, LND_DQ_AUDIT)


def loan_counts(loans: DataFrame) -> DataFrame:
    """One row from one scan: rows, current rows, and per column the empty and invalid ones
    among the current rows."""
    current = F.col("is_current_flag")
    return loans.agg(
        F.count("*").alias("all_rows"),
        F.count_if(current).alias("current_rows"),
        *[F.count_if(current & F.col(c).isNull()).alias(f"null_{c}")
          for c in LOAN_CRITICAL_COLUMNS],
        *[F.count_if(current & outside(F.col(c), d)).alias(f"invalid_{c}")
          for c, d in LOAN_DOMAINS.items()],
    )


def dq_loan(loans: DataFrame, errors: DataFrame | None, raw: DataFrame | None, run_id: str,
            table: str, checked_at: Column, rules: Rules = DEFAULT_RULES,
            families: tuple[str, ...] = LOAN_FAMILIES) -> DataFrame:
    """Audit rows for the loan table.

    The volume check divides by the raw rows; without `raw` it divides by the landed rows of
    all versions. Only what the wanted `families` of checks need is read.
    """
    parts, checks = [], []
    if set(families) & {"completeness", "validity"} or ("volume" in families and raw is None):
        parts.append(loan_counts(loans))
    if "volume" in families:
        parts.append(_count(errors, "errors"))
        if raw is not None:
            parts.append(_count(raw, "raw_rows"))
        checks.append(_volume(F.col("all_rows" if raw is None else "raw_rows"), F.col("errors"), rules))
    if "uniqueness" in families:
        parts.append(_count(duplicate_keys(loans.where("is_current_flag"), ["loan_id"]), "duplicates"))
        dup = F.col("duplicates")
        checks.append(_gated("uniqueness_loan_id", dup, 0.0, dup > 0,
                             F.format_string("loan_ids held twice: %d", dup)))
    if "completeness" in families:
        checks += [_completeness(c, F.col(f"null_{c}"), F.col("current_rows"), rules)
                   for c in LOAN_CRITICAL_COLUMNS]
    if "validity" in families:
        checks += [_validity(c, F.col(f"invalid_{c}"), f"{c} values") for c in LOAN_DOMAINS]
    return _audit(_one_row(parts), checks, run_id, table, checked_at)


def payment_counts(payments: DataFrame, families: tuple[str, ...] = PAYMENT_FAMILIES) -> DataFrame:
    """One row from one scan: all rows, and what the wanted `families` of checks count."""
    counts = [F.count("*").alias("all_rows")]
    if "completeness" in families:
        counts += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in PAYMENT_CRITICAL_COLUMNS]
    if "validity" in families:
        method = F.lower("payment_method_type")
        counts.append(F.count_if(outside(method, PAYMENT_METHODS)).alias("invalid_method"))
    if "allocation" in families:
        counts += [F.count_if(F.col("payment_allocation_status") == s).alias(s) for s in ALLOCATION_STATUSES]
    return payments.agg(*counts)


def repeated_payments(payments: DataFrame) -> DataFrame:
    """One row: composite keys booked twice, and ids booked with more than one amount.

    Both come from one scan. Rows shrink to one per composite key on the map side; those of an id
    then shrink to one row again before the second, smaller shuffle.
    """
    combos = payments.groupBy("payment_id", "amount", "payment_timestamp").agg(F.count("*").alias("n"))
    per_id = combos.groupBy("payment_id").agg(
        F.count_if(F.col("n") > 1).alias("twice"), (F.min("amount") != F.max("amount")).alias("in_parts"))
    return per_id.agg(F.coalesce(F.sum("twice"), F.lit(0)).alias("duplicates"), F.count_if("in_parts").alias("split"))


def dq_payment(payments: DataFrame, errors: DataFrame | None, raw_rows: DataFrame | None, run_id: str,
               table: str, checked_at: Column, rules: Rules = DEFAULT_RULES,
               families: tuple[str, ...] = PAYMENT_FAMILIES) -> DataFrame:
    """Audit rows for the payment ledger: one scan for all counters, one for repeated keys.

    `raw_rows` is one row and column: how many lines were read. Passing the number of raw
    rows instead leaves unparseable lines out of the total. Only what the wanted `families` of
    checks need is read.
    """
    parts, checks = [], []
    if set(families) & {"completeness", "validity", "allocation"}:
        parts.append(payment_counts(payments, families))
    if set(families) & {"uniqueness", "info"}:
        parts.append(repeated_payments(payments))
    if "volume" in families:
        parts += [_count(errors, "errors"), raw_rows.toDF("raw_rows")]
        checks.append(_volume(F.col("raw_rows"), F.col("errors"), rules))
    dup, split = F.col("duplicates"), F.col("split")
    if "uniqueness" in families:
        checks.append(_gated("uniqueness_payment_id_amount_timestamp", dup, 0.0, dup > 0, F.format_string(
            "booked twice (id, amount, instant): %d", dup)))
    if "info" in families:
        checks.append(_check("info_split_settlement_payment_ids", F.lit("INFO"), split, F.lit(0.0),
                             F.lit(False), F.format_string("ids paid in parts: %d", split)))
    if "completeness" in families:
        checks += [_completeness(c, F.col(f"null_{c}"), F.col("all_rows"), rules)
                   for c in PAYMENT_CRITICAL_COLUMNS]
    if "validity" in families:
        checks.append(_validity("payment_method_type", F.col("invalid_method"), "payment methods"))
    if "allocation" in families:
        summary = F.concat_ws(", ", *[
            F.concat(F.lit(f"{s}="), F.col(s).cast("string")) for s in ALLOCATION_STATUSES])
        checks.append(_check("allocation_status_summary", F.lit("INFO"), F.col("allocated"),
                             F.col("all_rows"), F.lit(False), summary))
    return _audit(_one_row(parts), checks, run_id, table, checked_at)


def enforce(audit: DataFrame, on_breach: str = "raise") -> list[str]:
    """Raise `DQGateError` naming every breach, or just return them with `record`.

    Call it on audit rows that are already written; there is one per check.
    """
    breaches = [f"{r['check_name']}: {r['detail']}" for r in
                audit.where("breach_flag").select("check_name", "detail").collect()]
    if breaches and on_breach == "raise":
        raise DQGateError(f"{len(breaches)} breach(es):\n" + "\n".join(breaches))
    return breaches
