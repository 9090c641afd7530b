"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

A document's size is its number of words. Sources share a multiple of all words by weight; a
target stops at a multiple of its source's own words and the excess is shared again by weight.
With e = target / source words, every document first gets floor(e) whole copies for certain.
The rest is an order sample: documents are ranked by random odds u / (1 - u) over inclusion
odds p / (1 - p), and the first are taken whose words come nearest to the words still wanted.
p is the fraction of e, times a document's own weight over its source's mean if a weight column
is given; u comes from the md5 of the id, so reruns agree.

No source is ordered in one place: ranks are summed in 4,096 slices, then in 4,096 slices of the
one slice in which the sample ends; only that slice of a slice is ordered.

Null and empty texts have size 0 and take 0 words. Null sources are a source of their own, last
in order. Rows of a source with the same rank (a repeated or null id) are taken or left
together. A source without words has target 0. Empty input gives an empty mix. Texts
of any length are read whole, for their number of words. Columns may have any names but _mix and
_mix_copy. Sources are few: a row per source is ordered in one task, so a column with a value of its
own for every document is no source column.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import broadcast_if_small, store

SLICES = 4096
NO_SPACE = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, CEILING = (3, 1, 2), Fraction(3, 2), 2


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NO_SPACE)).cast("long"), F.lit(0).cast("long"))


def source_key(source: Column) -> Column:
    """Sorts as the sources do by code point, null last."""
    return F.when(source.isNull(), F.lit("z")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def unit_number(doc_id: Column) -> Column:
    """A number strictly between 0 and 1 from the id: 52 bits of its md5, in the middle of a step."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
            ceiling: int = CEILING) -> DataFrame:
    """sizes(key, size, tilt) to one row per source: key, source_size, tilt, target.

    Sources fill up in order of ceiling / weight; the level at which the others stop is the
    first that the next source's ceiling allows.
    """
    total = sizes.groupBy("key").agg(F.sum("size").alias("s"), F.sum(F.col("size") * F.col("tilt")).alias("ts"))
    order = Window.orderBy("key")  # one row per source
    weight = F.array(*[F.lit(w) for w in weights])
    ranked = total.withColumn("w", F.get(weight, (F.row_number().over(order) - 1) % len(weights)))
    ranked = ranked.withColumn("cap", F.col("s") * ceiling)
    everywhere = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("w"), "key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("cap").over(filling), F.lit(0))
    level = ((F.sum("s").over(everywhere) * share.numerator / share.denominator - before)
             / (F.sum("w").over(everywhere) - F.coalesce(F.sum("w").over(filling), F.lit(0))))
    levels = ranked.select("*", level.alias("level"))
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), F.col("key"), F.col("level")))
    lowest = F.min(fits).over(everywhere)["level"]
    return store(levels.select(
        "key", F.col("s").alias("source_size"), F.try_divide("ts", F.col("s").cast("double")).alias("mean_tilt"),
        F.least(F.col("cap").cast("double"), lowest * F.col("w")).alias("target")), "targets")


def _plan(sizes: DataFrame, goals: DataFrame) -> tuple[DataFrame, Column]:
    """Per source what `take` needs: whole copies, inclusion odds, and where its sample ends."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = goals.withColumn("whole", F.floor(ratio)).withColumn("rest", ratio - F.col("whole"))
    plan = plan.withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))

    # Rank as a number from 0 to 1: odds / (1 + odds) keeps the order.
    p = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), F.col("rest") * F.when(
        F.col("mean_tilt") > 0, F.col("tilt") / F.col("mean_tilt")).otherwise(1.0)))
    rank = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    rank = rank / (1 + rank)

    small = broadcast_if_small(plan)
    rows = sizes.join(small.select("key", "rest", "mean_tilt"), "key").select("key", "size", rank.alias("v"))
    ends = plan.select("key", "wanted", F.lit(0.0).alias("before"), F.lit(0.0).alias("low"))
    for depth in (1, 2):
        width = float(SLICES) ** -depth
        slots = rows.join(broadcast_if_small(ends), "key").where(
            (F.col("v") >= F.col("low")) & (F.col("v") < F.col("low") + width * SLICES))
        slots = slots.groupBy("key", "wanted", "before", F.floor(F.col("v") / width).alias("slot")).agg(F.sum("size").alias("n"))
        upto = F.col("before") + F.sum("n").over(Window.partitionBy("key").orderBy("slot"))
        ends = store(slots.withColumn("upto", upto).where(
            (F.col("upto") - F.col("n") <= F.col("wanted")) & (F.col("wanted") < F.col("upto")))
            .select("key", "wanted", (F.col("upto") - F.col("n")).alias("before"),
                    (F.col("slot") * width).alias("low")), "sample-ends")
    last = rows.join(broadcast_if_small(ends), "key").where(
        (F.col("v") >= F.col("low")) & (F.col("v") < F.col("low") + width))
    peers = last.groupBy("key", "wanted", "before", "low", "v").agg(F.sum("size").alias("n"))
    ahead = F.col("before") + F.sum("n").over(Window.partitionBy("key").orderBy("v")) - F.col("n")
    cut = peers.withColumn("ahead", ahead).groupBy("key", "low").agg(F.max(F.when(
        2 * F.col("ahead") + F.col("n") <= 2 * F.col("wanted"), F.col("v"))).alias("v_last"))
    return store(plan.join(cut, "key", "left"), "mix-plan"), rank


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weight_col: str | None = None, weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE,
         ceiling: int = CEILING) -> DataFrame:
    """Rows of `docs` (all columns) with _mix: size, source_size, target, copies, taken."""
    tilt = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    facts = [source_key(F.col(source_col)).alias("key"), words_in(F.col(text_col)).alias("size"),
             F.coalesce(tilt, F.lit(0.0)).alias("tilt"), unit_number(F.col(id_col)).alias("u")]
    sizes = store(docs.select(*facts), "sizes")
    plan, rank = _plan(sizes, targets(sizes, weights, share, ceiling))
    own = [F.col(f"own.`{c}`").alias(c) for c in docs.columns]
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own"), *facts)
    joined = rows.join(broadcast_if_small(plan), "key").withColumn("v", rank)
    more = F.when(F.col("low").isNotNull() & ((F.col("v") < F.col("low")) | (F.col("v") <= F.col("v_last"))), 1).otherwise(0)
    copies = F.col("whole") + more
    return joined.select(*own, F.struct(
        "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken")).alias("_mix"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of `docs`, each as often as it is taken."""
    taken = take(docs, **options)
    return taken.select(*[c for c in docs.columns], F.explode(F.array_repeat(
        F.lit(0), F.col("_mix.copies").cast("int"))).alias("_mix_copy")).drop("_mix_copy")
