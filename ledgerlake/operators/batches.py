"""Latest batch, freshness and staleness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import rounded
from ..settings import DEFAULT_RULES


def latest_batch(df: DataFrame, ts: str = "_last_updated_ts") -> DataFrame:
    """Rows of the newest batch. The maximum is a scalar subquery, so the comparison reaches
    the scan as a value: partitions are pruned when `ts` is the partition column and row
    groups are skipped when it is not."""
    return df.where(F.col(ts) == df.select(F.max(ts)).scalar())


def hours_between(earlier: Column, later: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3.6e9)


def with_age(newest: DataFrame, now: Column, stale_after_hours: float) -> DataFrame:
    """Rows of source_name and latest_batch_ts with its age in hours (NULL when there is no
    batch) and whether that is over the limit."""
    hours = rounded(hours_between(F.col("latest_batch_ts"), now), 2)
    return newest.select("source_name", "latest_batch_ts", hours.cast("decimal(18,2)").alias("freshness_hours"),
                         (hours > stale_after_hours).alias("is_stale"))


def freshness(df: DataFrame, now: Column, source_name: str, ts: str = "_last_updated_ts",
              stale_after_hours: float = DEFAULT_RULES.stale_after_hours) -> DataFrame:
    """One row: newest batch, its age in hours, and whether stale."""
    newest = df.agg(F.max(ts).alias("latest_batch_ts")).withColumn("source_name", F.lit(source_name))
    return with_age(newest, now, stale_after_hours)
