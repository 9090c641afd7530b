"""Shared pieces of the operators: stored intermediates, text identity, small-table joins."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import materialise

# A table is broadcast only if it was counted and has at most this many (narrow) rows.
BROADCAST_ROWS = 200_000
# A larger one is first met as a filter of bits: at most so many rows of a place and 64 bits.
FILTER_WORDS = 1 << 19
# Rows of whole texts that one Arrow batch holds; bounds a Python worker's memory.
TEXT_ROWS_PER_BATCH = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared checkpoint folder and read back."""
    return materialise(df, name)


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the step that wrote them has stored its result."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))


def text_key(text: Column) -> Column:
    """Identity of a text: its md5, or an own value for null."""
    return F.coalesce(F.md5(text.cast("binary")), F.lit("null"))


def is_small(df: DataFrame) -> bool:
    """Whether a stored table may be broadcast."""
    return df.count() <= BROADCAST_ROWS


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """A broadcast hint for a stored table whose row count is within `limit`; else unchanged."""
    return F.broadcast(df) if df.count() <= (BROADCAST_ROWS if limit is None else limit) else df


def split_by_filter(rows: DataFrame, key: Column, wanted: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """`rows` in two parts: those whose `key` may be in `column` of `wanted`, and those whose key is not.

    One bit of a filter of fixed size stands for a key's hash, so rows that meet nothing of a table too
    large to be broadcast need not be shuffled to find that out. Null is a key like others.
    """
    def place(k: Column) -> tuple[Column, Column]:
        h = F.xxhash64(k)
        return F.shiftright(h.bitwiseAND(F.lit(64 * FILTER_WORDS - 1)), 6), h.bitwiseAND(F.lit(63)).cast("int")

    word, bit = place(wanted[column])
    ones = wanted.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(
        F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_bits"))
    word, bit = place(key)
    marked = rows.join(F.broadcast(ones), word == ones["_word"], "left")
    hit = F.coalesce(F.getbit(ones["_bits"], bit), F.lit(0)) == 1
    return marked.where(hit).drop("_word", "_bits"), marked.where(~hit).drop("_word", "_bits")


def crc_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id's decimal text, modulo `buckets`; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def ascii_lower(text: Column) -> Column:
    """`text` with A-Z, and no other letters, in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# What the objects that a Python worker keeps between tasks may take together.
KEPT_BYTES = 256 << 20


def per_process(name: tuple, make: Callable, size: int = 32 << 20):
    """make(), kept by this Python worker for its later tasks. `name` tells contents apart, `size`
    is about the most bytes the object grows to. The oldest objects go first, as soon as all of
    them together may pass `KEPT_BYTES`; the newest always stays."""
    kept = sys.modules.setdefault("_kept_between_tasks", types.ModuleType("_kept_between_tasks"))
    objects = kept.__dict__.setdefault("objects", {})
    if name not in objects:
        dropped = False
        while objects and sum(s for _, s in objects.values()) + size > KEPT_BYTES:
            del objects[next(iter(objects))]
            dropped = True
        if dropped:
            gc.collect()
        objects[name] = make(), size
    return objects[name][0]
