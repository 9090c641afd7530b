"""Evaluate columns in a step of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """`df` (or its `keep` columns) plus `columns`, each evaluated exactly once per row.

    A filter on a plain computed column is pushed below the projection and takes a copy of
    the whole expression with it; for a parsed field that means parsing several times over.
    Going through a one-element `inline` keeps such filters above the computation.
    """
    fields = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in (df.columns if keep is None else keep) if c not in columns]
    return df.select(*kept, F.inline(F.array(fields)))
