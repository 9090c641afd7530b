"""Connected components of a link table by alternating star contractions.

Every round is two groupings with map-side minima and two joins; adaptive execution splits the
rows of a hot node. No node, component or link list is ever gathered in one place. Rounds end
when a round changes nothing; links that already form stars need two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import store
from ledgerlake.session import discard


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = links.union(links.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return (both.join(least, "a").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. Takes a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _digest(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).head()
    return tuple(row)


def components(links: DataFrame, name: str) -> DataFrame:
    """links(a, b) of integers to (node, root), root being the smallest node of the component.

    Nodes without a link to another node don't appear. Repeated links, links of a node to
    itself and empty input are fine.
    """
    now = store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a != b").distinct(), name)
    seen = _digest(now)
    while seen[0]:
        before, now = now, store(_small_star(_large_star(now)), name)
        discard(before)
        after = _digest(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct())
