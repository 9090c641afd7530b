"""Dense surrogate keys in arrival order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

# A partition id and a row number share one 64-bit id: 31 and 33 bits.
ROW_BITS = 33


def dense_keys(df: DataFrame, order: list[str], start: DataFrame, name: str) -> DataFrame:
    """Number the rows start+1, start+2, ... by `order`, which must identify a row.

    Rows are range-partitioned and sorted, so each task numbers its own slice; what is
    shared is one count per partition. The slices are written down before the counts are
    taken, because a recomputed range partitioning need not cut at the same places.

    `start` is a one-column, one-row DataFrame with the highest key already in use.
    """
    sorted_slices = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    fixed = materialise(sorted_slices, "slices").withColumns({
        "_slice": F.shiftright("_id", ROW_BITS),
        "_in_slice": F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)),
    })
    sizes = fixed.groupBy("_slice").agg(F.count("*").alias("_n"))
    # One row per slice, so this ordered window is as small as the number of tasks.
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    first = F.coalesce(start.scalar(), F.lit(0))
    numbered = fixed.join(F.broadcast(offsets), "_slice").withColumn(
        name, first + F.col("_off") + F.col("_in_slice") + F.lit(1))
    return numbered.select(name, *df.columns)


def highest_key(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("start"))
