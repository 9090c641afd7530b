"""Per-batch source audit: distinct keys, duplicated keys, surplus rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RAW_AUDIT, conform


def loan_duplicates(raw: DataFrame, key: str = "loan_id") -> DataFrame:
    """One row. Rows without a key are one group: no distinct key, but surplus rows."""
    per_key = raw.groupBy(key).agg(F.count("*").alias("n"))
    surplus = F.when(F.col("n") > 1, F.col("n") - 1).otherwise(0)
    return per_key.agg(
        F.count(key).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_key_count"),
        F.sum(surplus).alias("true_duplicate_count"),
        F.lit(0).cast("bigint").alias("diff_amount_same_id_count"),
        F.sum("n").alias("total_rows"),
    )


def payment_duplicates(raw: DataFrame) -> DataFrame:
    """One row. A surplus row repeats an (amount, timestamp) of its id, or lacks either.

    Rows shrink to one per id, amount and timestamp on the map side, then to one per id, so no
    distinct count multiplies them.
    """
    amount, at = F.col("amount"), F.col("payment_timestamp")
    combos = raw.groupBy("payment_id", "amount", "payment_timestamp").agg(F.count("*").alias("rows"))
    per_id = combos.groupBy("payment_id").agg(
        F.sum("rows").alias("n"),
        F.count_if(amount.isNotNull() & at.isNotNull()).alias("combos"),
        (F.min(amount) != F.max(amount)).alias("several"),
    )
    return per_id.agg(
        F.count("payment_id").alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("duplicate_key_count"),
        F.sum(F.col("n") - F.col("combos")).alias("true_duplicate_count"),
        F.count_if("several").alias("diff_amount_same_id_count"),
        F.sum("n").alias("total_rows"),
    )


def audit_row(duplicates: DataFrame, batch_ts: datetime, source_file: str, source_table: str,
              rows_in_file: Column | None = None) -> DataFrame:
    """The raw_audit row for one batch. Without `rows_in_file` every line became a row."""
    total = F.coalesce(F.col("total_rows"), F.lit(0))
    stamped = duplicates.select(
        "*",
        F.lit(batch_ts).cast("timestamp").alias("batch_ts"),
        F.lit(source_file).alias("source_file"),
        F.lit(source_table).alias("source_table"),
        (total if rows_in_file is None else rows_in_file).alias("total_rows_in_file"),
        total.alias("total_rows_inserted"),
        F.lit(batch_ts).cast("timestamp").alias("_last_updated_ts"),
    )
    return conform(stamped, RAW_AUDIT)


def latest_audit(audit: DataFrame) -> DataFrame:
    """The newest audit row of each source table."""
    everything = F.struct(*[c for c in audit.columns if c != "source_table"])
    return (audit.groupBy("source_table").agg(F.max_by(everything, "batch_ts").alias("_row"))
            .select("source_table", "_row.*"))
