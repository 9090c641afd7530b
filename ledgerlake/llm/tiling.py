"""Tiles of a similarity join: classes that share a key, settled without pairing a tile out."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import store
from ledgerlake.llm.components import components
from ledgerlake.session import discard

# Shingles of a block's classes outside and inside the main component: bounds of a task's memory.
OUTSIDE, INSIDE = 500_000, 2_000_000
# Tiles up to this many classes are settled by pairs, larger ones in blocks, with the same links.
PAIRED = 32


def tiles(keys: DataFrame, repeated: bool = False) -> DataFrame:
    """The (key, class, n) of keys that two or more classes share, each class once a key; with
    `repeated`, also of keys that one class has several times, told apart by `several`. One
    shuffle by key; the order of classes within a key serves all windows."""
    ordered, whole = Window.partitionBy("key").orderBy("class"), Window.partitionBy("key")
    rows = keys.select("key", "class", "n", F.lag("class").over(ordered).alias("before"),
                       F.lead("class").over(ordered).alias("after"))
    several = F.min("class").over(whole) != F.max("class").over(whole)
    kept = F.col("several") | F.col("after").isNotNull() if repeated else F.col("several")
    return (rows.withColumn("several", several).where(kept)
            .where("before is null or before != class").select("key", "class", "n", "several"))


def pairs_of(a: DataFrame) -> DataFrame:
    """a, b, na, nb with a < b, each pair once; only sizes that can be similar enough."""
    return a.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
        F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb")).distinct()


def _bits(sets: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(sets), width), np.uint8)
    for row, members in zip(out, sets, strict=True):
        row[((members >> np.uint64(20)) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(out, axis=1).view(np.uint64)


def solve_block(outside: pd.DataFrame, inside: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """For each class outside, one similar class inside of every other component: members are
    ordered by size, bounded by the bit counts of bitmaps, then intersected as sorted arrays."""
    out: list[tuple[int, int]] = []
    if not len(outside) or not len(inside):
        return out
    theirs = [np.frombuffer(x, np.uint64) for x in inside["set"]]
    sizes = np.array(list(map(len, theirs)))
    order = np.argsort(sizes, kind="stable")
    theirs, sizes = [theirs[i] for i in order], sizes[order]
    roots, names = inside["root"].to_numpy()[order], inside["class"].to_numpy()[order]
    width = 1 << min(16, max(9, int(16 * sizes.max() - 1).bit_length()))
    bits = _bits(theirs, width)
    for own_class, own_root, raw in zip(outside["class"], outside["root"], outside["set"], strict=True):
        own = np.frombuffer(raw, np.uint64)
        n = len(own)
        lo = int(np.searchsorted(sizes, -(-n * percent // 100)))
        hi = int(np.searchsorted(sizes, n * 100 // percent, side="right"))
        mine, some = _bits([own], width), bits[lo:hi]
        apart = np.bitwise_count(mine & ~some).sum(axis=1), np.bitwise_count(some & ~mine).sum(axis=1)
        most = np.minimum(n - apart[0].astype(np.int64), sizes[lo:hi] - apart[1].astype(np.int64))
        likely = np.flatnonzero(((100 + percent) * most >= percent * (n + sizes[lo:hi])) & (roots[lo:hi] != own_root))
        linked = set()
        for j in lo + likely[np.argsort(-most[likely], kind="stable")]:
            if roots[j] not in linked:
                both = len(np.intersect1d(own, theirs[j], assume_unique=True))
                if 100 * both >= percent * (n + int(sizes[j]) - both):
                    linked.add(roots[j])
                    out.append((int(own_class), int(names[j])))
    return out


def settled_links(shared: DataFrame, verified: Callable[[DataFrame, str], DataFrame],
                  sets_of: Callable[[DataFrame, str], DataFrame], percent: int) -> DataFrame:
    """Stored links (a, b) that give the components of all pairs that meet in a tile and pass.

    `shared` is a stored result of `tiles`; `verified` takes (a, b, na, nb) and a name to the
    stored (a, b) that are similar enough; `sets_of` takes (class) and a name to stored (class, set).

    First every class meets two of its tile: the one that shares most with others, which in a
    group of near copies is the text nearest to all, and the first. Then classes outside a tile's
    largest component meet the classes of tiles with that component, in blocks of bounded size
    that make one link per class and component. A pair whose two classes are in one component by
    then can't change it.
    """
    shared = shared.where("several").drop("several")
    ends = shared.groupBy("key").agg(F.min(F.struct("class", "n")).alias("lo"), F.count("*").alias("members"))
    multi = store(shared.join(ends, "key"), "multi-tiles")
    ties = multi.groupBy("class").agg(F.sum("members").alias("ties"))
    ranked = multi.join(ties, "class")
    hubs = store(ranked.groupBy("key").agg(F.max(F.struct("ties", "class", "n")).alias("hub")), "hubs")
    starred = multi.join(hubs, "key").select(
        F.col("class").alias("b"), F.col("n").alias("nb"),
        F.explode(F.array(F.struct("hub.class", "hub.n"), F.struct("lo.class", "lo.n"))).alias("e")).select(
        F.col("e.class").alias("a"), F.col("e.n").alias("na"), "b", "nb")
    fits = f"100 * least(na, nb) >= {percent} * greatest(na, nb)"
    stars = store(pairs_of(starred.where(f"a != b and {fits}")), "star-pairs")
    links = verified(stars, "stars")
    first = store(components(links, "first-components"), "first-roots")

    # Members of a tile with their component so far; tiles of one component are settled.
    placed = multi.join(first.withColumnRenamed("node", "class"), "class", "left").select(
        "key", "members", "class", "n", F.coalesce("root", "class").alias("root"))
    placed = store(placed, "placed")
    main = placed.join(hubs.select("key", "hub.class"), ["key", "class"]).select("key", F.col("root").alias("main"))
    open_keys = store(placed.join(main, "key").where("root != main").select("key", "main").distinct(), "open-keys")
    discard(multi, hubs, first)
    unsettled = store(placed.join(open_keys, "key"), "open-tiles")
    discard(placed, open_keys)

    # Of a small tile, pairs: at most `PAIRED` for a member.
    small = unsettled.where(F.col("members") <= PAIRED)
    left = small.where("root != main").select("key", F.col("class").alias("a"), F.col("n").alias("na"), F.col("root").alias("root_a"))
    right = small.select("key", F.col("class").alias("b"), F.col("n").alias("nb"), F.col("root").alias("root_b"))
    paired = pairs_of(left.join(right, "key").where(f"root_a != root_b and {fits}"))
    paired = store(paired.join(stars.select("a", "b"), ["a", "b"], "left_anti"), "rest-pairs")
    links = links.union(verified(paired, "rest"))
    discard(stars, paired)

    # Of large tiles, blocks; tiles with the same main component are taken together.
    asked = unsettled.where(F.col("members") > PAIRED).select("main", "class", "n", "root").distinct()
    asked = store(asked, "large-tiles")
    discard(unsettled)
    sets = sets_of(asked.select("class").distinct(), "open")
    outer = F.when(F.col("root") != F.col("main"), F.col("n"))
    cuts = asked.groupBy("main").agg(
        F.ceil(F.coalesce(F.sum(outer), F.lit(0)) / OUTSIDE).alias("outs"),
        F.ceil(F.sum("n") / INSIDE).alias("ins"))
    rows = asked.join(cuts, "main").join(sets, "class")
    spread, zero = F.xxhash64("class"), F.lit(0).cast("long")
    outside = rows.where("root != main").select(
        "main", "class", "root", "set", F.pmod(spread, F.col("outs")).alias("o"),
        F.explode(F.sequence(zero, F.col("ins") - 1)).alias("i"))
    inside = rows.where("outs > 0").select(
        "main", "class", "root", "set", F.explode(F.sequence(zero, F.col("outs") - 1)).alias("o"),
        F.pmod(spread, F.col("ins")).alias("i"))

    inside = inside.toDF(*[f"in_{c}" for c in inside.columns])

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right.columns = [c.removeprefix("in_") for c in right.columns]
        return pd.DataFrame(solve_block(left, right, percent), columns=["a", "b"])

    more = outside.groupBy("main", "o", "i").cogroup(inside.groupBy("in_main", "in_o", "in_i")).applyInPandas(
        solve, "a long, b long")
    settled = store(links.union(more), "all-links")
    discard(asked, sets, links)
    return settled
