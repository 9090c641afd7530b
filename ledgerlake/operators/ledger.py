"""Payment ledger: drop what is already booked, and say which loan a payment belongs to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import first_per_key

LEDGER_KEY = ("payment_id", "amount", "payment_timestamp")


def not_yet_booked(incoming: DataFrame, ledger: DataFrame,
                   keys: tuple[str, ...] = LEDGER_KEY) -> DataFrame:
    """Incoming rows whose composite key is not in the ledger; NULL matches NULL.

    The ledger is first cut down to the incoming ids. A small batch is broadcast into that
    semi join, so the ledger is scanned for its key columns but never shuffled.
    """
    relevant = ledger.select(*keys).join(incoming.select(keys[0]), keys[0], "left_semi")
    booked = relevant.select(*[F.col(k).alias(f"_booked_{k}") for k in keys])
    same = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_booked_{k}")) for k in keys])
    return incoming.join(booked, same, "left_anti")


def first_not_yet_booked(rows: DataFrame, ledger: DataFrame, order: list[str],
                         keys: tuple[str, ...] = LEDGER_KEY) -> DataFrame:
    """What `not_yet_booked` leaves of the first row of each composite key, in one shuffle.

    The ledger's keys join the grouping of the rows and come first in it, so a booked key yields
    its ledger row, which is dropped. All of the ledger's keys are shuffled, but the rows only once:
    for batches that are not written down and not small beside the ledger.
    """
    booked = ledger.where(F.col(keys[0]).isNotNull()).select(
        *[F.col(k).cast(t).alias(k) if k in keys else F.lit(None).cast(t).alias(k)
          for k, t in ((f.name, f.dataType) for f in rows.schema)], F.lit(0).alias("_fresh"))
    both = rows.withColumn("_fresh", F.lit(1)).unionByName(booked)
    return first_per_key(both, list(keys), ["_fresh", *order]).where("_fresh = 1").drop("_fresh")


def within_reach(ledger: DataFrame, incoming: DataFrame, column: str = "payment_timestamp") -> DataFrame:
    """The ledger rows whose `column`, a part of the key, lies between the incoming rows' smallest
    and largest, or is NULL: no other row can have an incoming row's key.

    Both bounds are scalar subqueries, so they reach the scan as values and row groups of other
    times are skipped. `incoming` should be a stored table.
    """
    low, high = (incoming.select(f(column)).scalar() for f in (F.min, F.max))
    return ledger.where(((F.col(column) >= low) & (F.col(column) <= high)) | F.col(column).isNull())


def loan_standing(current_loans: DataFrame, raw_loans: DataFrame,
                  key: str = "loan_id") -> DataFrame:
    """One row per known loan id: whether it is clean, or was seen in raw only."""
    clean = current_loans.where("is_current_flag").select(key, F.lit(True).alias("_is_clean"))
    seen = raw_loans.select(key, F.lit(False).alias("_is_clean"))
    return (clean.unionByName(seen).where(F.col(key).isNotNull())
            .groupBy(key).agg(F.max("_is_clean").alias("_is_clean")))


def allocate(payments: DataFrame, standing: DataFrame, key: str = "loan_id",
             name: str = "payment_allocation_status") -> DataFrame:
    """allocated / loan_rejected / unallocated / unidentified, with one join.

    The payments are the preserved side and each loan id has one standing, so adaptive
    execution can split the payments of a hot loan, or those without a loan id.
    """
    status = (
        F.when(F.col(key).isNull(), "unidentified")
        .when(F.col("_is_clean"), "allocated")
        .when(F.col("_is_clean").isNull(), "unallocated")
        .otherwise("loan_rejected")
    )
    return payments.join(standing, key, "left").withColumn(name, status).drop("_is_clean")
