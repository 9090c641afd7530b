"""Records of delimited text whose quoted fields may hold line breaks, read in parallel.

Files are read as lines, so Spark cuts them into byte ranges as it likes. Whether a line begins
inside a quoted field depends on every line before it; but all a line, or a whole range, can do
to that state is keep it, flip it or set it. These effects are combined in two steps: along the
lines of a range, then along the ranges of a file, of which there is one row each. A line that
begins and ends outside quotes is a record as it is. Only the others are grouped, each with the
line that opened its quotes, across ranges where need be.

A field is quoted if its first character is a quote; quotes inside are doubled. What follows a
closing quote up to the delimiter belongs to the field, and a quote in the middle of another field
means nothing. A quote that is never closed makes the rest of its file one record. Lines end at a
line feed, with or without a carriage return before it; records keep theirs as line feeds. Empty
lines are no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUOTE, DELIMITER = '"', ","


def _opens(text: Column) -> Column:
    """Whether a text that begins outside quotes, without doubled ones, ends inside."""
    closed = F.regexp_replace(text, f'(^|{DELIMITER}){QUOTE}[^{QUOTE}]*{QUOTE}[^{DELIMITER}]*', "$1")
    return closed.rlike(f"(^|{DELIMITER}){QUOTE}")


def quote_effect(line: Column) -> tuple[Column, Column]:
    """The state after a line, 1 for inside quotes, by the state before it: (from 0, from 1)."""
    single = F.replace(line, F.lit(QUOTE * 2), F.lit(""))
    plain = ~F.contains(single, F.lit(QUOTE))
    rest = F.regexp_replace(single, f"^[^{QUOTE}]*{QUOTE}[^{DELIMITER}]*", "")
    return (F.when(plain, 0).otherwise(_opens(single).cast("int")),
            F.when(plain, 1).otherwise(_opens(rest).cast("int")))


def _states(df: DataFrame, group: list[str], order: str) -> DataFrame:
    """Add what is known before each row of its group, from effects `_e0` and `_e1`: `_set`, the
    state if some earlier row set it, and `_flips`, 1 if the rows since then, or all of them, flip
    the state that came in."""
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sets, flips = F.col("_e0") == F.col("_e1"), (F.col("_e0") > F.col("_e1")).cast("int")
    counted = df.withColumn("_n", F.coalesce(F.sum(flips).over(before), F.lit(0)))
    last = F.last(F.when(sets, F.struct(F.col("_e0").alias("to"), F.col("_n").alias("n"))), ignorenulls=True).over(before)
    return (counted.withColumn("_last", last)
            .withColumn("_set", (F.col("_last.to") + F.col("_n") - F.col("_last.n")) % 2)
            .withColumn("_flips", F.col("_n") % 2).drop("_n", "_last"))


def _entered(entry: Column) -> Column:
    """The state before a row, from the one that came into its group."""
    return F.coalesce("_set", (entry + F.col("_flips")) % 2)


def _after(before: Column) -> Column:
    return F.when(before == 0, F.col("_e0")).otherwise(F.col("_e1"))


def whole_records(lines: DataFrame, position: str, text: str = "value") -> DataFrame:
    """`lines` with `text` a whole record each, at the position of its first line, and `_header`
    for the first line of a file.

    `position` names a struct of file, block and row that orders the lines of a file; the other
    columns are the same for all lines of a file.
    """
    others = [c for c in lines.columns if c not in (position, text)]
    e0, e1 = quote_effect(F.col(text))
    at = F.col(position)
    marked = lines.withColumn(text, F.regexp_replace(text, "\r$", "")).select(
        *others, position, text, at["file"].alias("_file"), at["block"].alias("_block"), at["row"].alias("_row"),
        e0.alias("_e0"), e1.alias("_e1"))
    known = _states(marked, ["_file", "_block"], "_row")

    # One row per range: what it does to the state, by its last line.
    last = known.groupBy("_file", "_block").agg(
        F.max_by(F.struct(*[_after(_entered(F.lit(s))).alias(f"_e{s}") for s in (0, 1)]), "_row").alias("_do"),
        F.min("_row").alias("_first"))
    ranges = _states(last.select("_file", "_block", "_first", "_do.*"), ["_file"], "_block").select(
        "_file", "_block", "_first", _entered(F.lit(0)).alias("_entry"),
        (F.row_number().over(Window.partitionBy("_file").orderBy("_block")) == 1).alias("_is_first"))
    placed = known.join(ranges, ["_file", "_block"]).withColumn("_before", _entered(F.col("_entry"))).withColumn(
        "_header", F.col("_is_first") & (F.col("_row") == F.col("_first")))
    placed = placed.withColumn("_inside", _after(F.col("_before"))).select(
        *others, position, text, "_header", "_file", "_block", "_row", "_before", "_inside")

    alone = placed.where("_before = 0 AND _inside = 0").where(F.length(text) > 0)
    # The lines of other records are numbered by the openers before them, in the range and in
    # those before it.
    parts = placed.where("_before = 1 OR _inside = 1")
    opener = (F.col("_before") == 0).cast("int")
    openers = parts.groupBy("_file", "_block").agg(F.sum(opener).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = openers.select("_file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    along = Window.partitionBy("_file", "_block").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parts.withColumn("_at", F.sum(opener).over(along)).join(offsets, ["_file", "_block"]).withColumn(
        "_record", F.col("_off") + F.col("_at"))
    row = F.struct(F.col("_block"), F.col("_row"), F.col(text).alias("text"), F.col(position).alias("at"), F.col("_header").alias("header"))
    joined = numbered.groupBy("_file", "_record").agg(
        F.sort_array(F.collect_list(row)).alias("_lines"), *[F.first(c).alias(c) for c in others])
    several = joined.select(
        *others, F.col("_lines")[0]["at"].alias(position),
        F.array_join(F.transform("_lines", lambda x: x["text"]), "\n").alias(text), F.col("_lines")[0]["header"].alias("_header"))
    return alone.select(*others, position, text, "_header").unionByName(several)
