"""Nearest smaller and larger number for each probe, without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise


def nearest_numbers(probes: DataFrame, known: DataFrame, number: str,
                    slices: int | None = None) -> DataFrame:
    """For each distinct probe number: `closest_below` and `closest_above` among `known`.

    The distinct numbers are range-partitioned into slices of about equal size, however far
    apart they lie, and written down, as a range partitioning that is computed anew need not
    cut at the same places. A window inside a slice finds the neighbours there; a neighbour
    beyond it is the edge of the nearest slice that knows one, carried over a table with one
    row per slice. `slices` is by default the number of shuffle partitions.
    """
    asked = probes.select(F.col(number).alias("_n"), F.lit(True).alias("_probe"))
    have = known.select(F.col(number).alias("_n"), F.lit(False).alias("_probe"))
    distinct = (
        asked.unionByName(have).where(F.col("_n").isNotNull()).groupBy("_n")
        .agg(F.max("_probe").alias("_probe"), F.min("_probe").alias("_only_probe"))
    )
    # Written first: cutting ranges samples its input, which would be evaluated twice.
    distinct = materialise(distinct, "numbers")
    ranged = (distinct.repartitionByRange("_n") if slices is None
              else distinct.repartitionByRange(slices, "_n"))
    points = materialise(ranged.select(
        F.spark_partition_id().alias("_slice"), "_n", "_probe",
        F.when(~F.col("_only_probe"), F.col("_n")).alias("_known")), "points")
    edges = points.groupBy("_slice").agg(F.min("_known").alias("_lo"), F.max("_known").alias("_hi"))
    # One row per slice, so these ordered windows are as small as the number of tasks.
    along = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.orderBy(F.desc("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select("_slice", F.max("_hi").over(along).alias("_prev"),
                         F.min("_lo").over(back).alias("_next"))
    # Numbers are distinct, so rows before a probe are below it. Both frames run from the near
    # end: each row only extends the running maximum or minimum.
    up = Window.partitionBy("_slice").orderBy("_n").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("_slice").orderBy(F.desc("_n")).rowsBetween(Window.unboundedPreceding, -1)
    inside = points.select("_slice", "_n", "_probe", F.max("_known").over(up).alias("_below"),
                           F.min("_known").over(down).alias("_above")).where("_probe")
    return inside.join(F.broadcast(edges), "_slice").select(
        F.col("_n").alias(number),
        F.coalesce("_below", "_prev").alias("closest_below"),
        F.coalesce("_above", "_next").alias("closest_above"),
    )
