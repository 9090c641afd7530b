"""Type-2 history: compare a cleaned batch with the current rows and produce the new table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import DEFAULT_RULES, Rules
from ..schemas import LND_LOAN, conform


def scd2_changes(history: DataFrame, incoming: DataFrame, key: str = "loan_id",
                 hash_column: str = "_row_hash") -> DataFrame:
    """Incoming rows with `_action`: `new`, `changed` or `unchanged`.

    `incoming` has one row per key. Current rows are first cut down to the incoming keys, a
    semi join that Spark runs without shuffling the history when the batch is small.
    """
    current = history.where("is_current_flag").select(key, hash_column)
    relevant = current.join(incoming.select(key), key, "left_semi")
    known = relevant.groupBy(key).agg(F.max(hash_column).alias("_known_hash"),
                                      F.lit(True).alias("_known"))
    action = (
        F.when(F.col("_known").isNull(), "new")
        .when(F.col("_known_hash").eqNullSafe(F.col(hash_column)), "unchanged")
        .otherwise("changed")
    )
    return (incoming.join(known, key, "left").withColumn("_action", action)
            .drop("_known", "_known_hash"))


def scd2_merge(history: DataFrame, incoming: DataFrame, batch_ts: datetime,
               rules: Rules = DEFAULT_RULES, key: str = "loan_id",
               hash_column: str = "_row_hash") -> DataFrame:
    """The whole table after the batch: untouched, closed and newly opened rows.

    New keys open a row; changed keys close theirs at the batch date and open another;
    unchanged keys and keys missing from the batch stay as they are.
    """
    changes = scd2_changes(history, incoming, key, hash_column)
    changed_keys = changes.where(F.col("_action") == "changed").select(
        key, F.lit(True).alias("_close"))
    closing = F.col("_close") & F.col("is_current_flag")
    kept = (
        history.join(changed_keys, key, "left")
        .withColumns({
            "row_effective_to": F.when(closing, F.lit(batch_ts.date()))
            .otherwise(F.col("row_effective_to")),
            "is_current_flag": F.when(closing, F.lit(False)).otherwise(F.col("is_current_flag")),
        })
        .drop("_close")
    )
    opened = open_rows(changes.where(F.col("_action") != "unchanged"), batch_ts, rules)
    return conform(kept, LND_LOAN).unionByName(conform(opened, LND_LOAN))


def not_superseded(history: DataFrame, incoming: DataFrame, batch_ts: datetime,
                   key: str = "loan_id") -> DataFrame:
    """Incoming rows without those whose key has a current row opened after the batch: a batch
    that is run again, or late, doesn't undo what came later."""
    later = history.where(F.col("is_current_flag") & (F.col("row_effective_from") > F.lit(batch_ts)))
    return incoming.join(later.select(key), key, "left_anti")


def open_rows(clean: DataFrame, batch_ts: datetime, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Cleaned rows as current versions starting at the batch time."""
    return clean.withColumns({
        "row_effective_from": F.lit(batch_ts).cast("timestamp"),
        "row_effective_to": F.lit(rules.open_date),
        "is_current_flag": F.lit(True),
    })
