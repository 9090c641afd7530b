"""One row per key, chosen by ingest position.

All of these are aggregations with a map-side step: a key that fills a third of the input
leaves each map task as a single candidate row, so no reducer sees the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


Order = Column | list[str]
# Rows without a key go to so many places of a join.
SPREAD = 1000
# Grouping keeps values of these types as they are; a -0.0 would come back as 0.0.
KEPT_BY_GROUPING = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "date", "timestamp",
                    "timestamp_ntz")


def _place(order: Order) -> Column:
    return order if isinstance(order, Column) else F.struct(*order)


def _one_per_key(df: DataFrame, keys: list[Column], named: list[str], order: Order, last: bool) -> DataFrame:
    """One row per combination of `keys`; `named` are the columns among them.

    An order given by column names is the beginning of the one struct that is compared and kept,
    and the key columns come from the grouping, so no value is sorted or shuffled twice.
    """
    types = dict(df.dtypes)
    groups = df.groupBy(*[k.alias(f"_key{i}") for i, k in enumerate(keys)])
    if isinstance(order, Column) or any("map<" in t or "variant" in t for t in types.values()):
        pick = F.max_by if last else F.min_by
        everything = F.struct(*[F.col(c) for c in df.columns])
        return groups.agg(pick(everything, _place(order)).alias("_row")).select("_row.*")
    grouped = {c: f"_key{i}" for i, c in enumerate(named) if c not in order
               and (types[c] in KEPT_BY_GROUPING or types[c].startswith("decimal("))}
    held = [*order, *[c for c in df.columns if c not in order and c not in grouped]]
    pick = F.max if last else F.min
    return groups.agg(pick(F.struct(*held)).alias("_row")).select(
        *[F.col(grouped.get(c, f"_row.{c}")).alias(c) for c in df.columns])


def last_per_key(df: DataFrame, key: str, order: Order) -> DataFrame:
    """The last occurrence of each key; rows without a key all stay.

    A row without a key forms a group of its own, named by its position.
    """
    alone = F.when(F.col(key).isNull(), _place(order))
    return _one_per_key(df, [F.col(key), alone], [key], order, last=True)


def first_per_key(df: DataFrame, keys: list[str], order: Order) -> DataFrame:
    """The first occurrence of each composite key; NULL equals NULL."""
    return _one_per_key(df, [F.col(k) for k in keys], keys, order, last=False)


def mark_repeats(df: DataFrame, key: str, order: Column, flag: str) -> DataFrame:
    """Flag every row of a key after its first one; rows without a key are never flagged.

    The first position of each key is an aggregate, and only that of keys with several rows is joined
    back, so most keys leave nothing to sort. Adaptive execution splits the rows of a hot key in the
    join, which it could not do for a window over the key; rows without a key are spread over tasks.

    The key that is joined on comes out of the aggregation: a filter on it stays above, and what `df`
    shuffles serves both sides.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(order), F.lit(SPREAD))).otherwise(F.lit(0).cast("long"))
    firsts = (
        df.groupBy(key).agg(F.max(key).alias("_key"), F.min(order).alias("_first"), F.count("*").alias("_rows"))
        .where("_rows > 1").select("_key", "_first", F.when(F.col("_rows") < 0, F.col("_rows")).otherwise(0).alias("_spread"))
    )
    rows = df.withColumn("_own_spread", spread)
    marked = rows.join(firsts, (rows[key] == F.col("_key")) & (F.col("_own_spread") == F.col("_spread")), "left")
    later = F.col(key).isNotNull() & (order.isNull() | (F.col("_first").isNotNull() & (order != F.col("_first"))))
    return marked.withColumn(flag, later).select(*df.columns, flag)
