"""Documents packed into token sequences of bounded length by bounded-space online best fit.

A document is its token ids and the end id. Longer ones than a sequence are cut into full pieces,
the first of which may be shorter; every other document is one piece. A task packs the pieces as
they come into a fixed number of open sequences. Those are kept in a bitset keyed by free space:
the lowest bit from a piece's length on is the fullest sequence that still takes it. If there is
none, a new one is opened, for which the fullest open one closes once all places are taken. A
sequence that fills up closes by itself.

What is still open when a task ends is packed again in the same way, the pieces of `MERGED` tasks by
one, longest first, until a single task is left. A pass only touches what was open, so the last one
has at most the open sequences of `MERGED` tasks, whatever the corpus.

The result is one row per sequence with its ids and its pieces. Null texts are empty: their end
alone. Empty tables give no rows. Rows that repeat an id or a text, and rows without an id, are
packed as documents of their own. Very long texts are encoded whole. Only id and text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import per_process, store, text_batches
from ledgerlake.llm.token_files import ENCODER_BYTES, Encoder

OPEN, MERGED = 1024, 64
ROWS_AT_ONCE = 512
# Sequence numbers: pass, task, and number within the task.
TASK_BITS, NUMBER_BITS = 24, 33

PIECE_FACTS = ("doc_id", "piece", "start", "length", "ids_crc32")
PIECE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                   ("ids_crc32", pa.int64()), ("offset", pa.int64())])
SEQUENCE = pa.schema([("sequence_id", pa.int64()), ("closed", pa.bool_()), ("n_tokens", pa.int64()),
                      ("ids", pa.binary()), ("pieces", pa.list_(PIECE))])
SEQUENCE_SQL = ("sequence_id long, closed boolean, n_tokens long, ids binary, pieces array<struct<doc_id: long, "
                "piece: int, start: long, length: long, ids_crc32: long, offset: long>>")


class OpenSequences:
    """At most `most` sequences of `size` tokens that still have room."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.held = size, most, 0
        self.by_space: list[list[list]] = [[] for _ in range(size + 1)]
        self.spaces = 0  # bit s is set while some open sequence has s tokens of free space

    def _take(self, space: int) -> list:
        sequence = self.by_space[space].pop()
        if not self.by_space[space]:
            self.spaces &= ~(1 << space)
        self.held -= 1
        return sequence

    def add(self, length: int, piece) -> list | None:
        """Place a piece; the sequence that closes by it, if any does."""
        fitting = self.spaces >> length
        closed = None
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(space)
        else:
            sequence, space = [], self.size
            if self.held >= self.most and length < self.size:
                closed = self._take((self.spaces & -self.spaces).bit_length() - 1)
        sequence.append(piece)
        left = space - length
        if left == 0:
            return sequence
        self.by_space[left].append(sequence)
        self.spaces |= 1 << left
        self.held += 1
        return closed

    def rest(self) -> Iterator[list]:
        while self.spaces:
            yield self._take((self.spaces & -self.spaces).bit_length() - 1)


def pieces_of(doc_id, data: bytes, width: int, size: int) -> Iterator[tuple]:
    """(length, (doc_id, piece, start, length, crc), ids) of a document's serialized ids."""
    ids = np.frombuffer(data, f"<u{width}").astype("<u4")
    first = len(ids) % size or size
    start, number = 0, 0
    while start < len(ids):
        part = ids[start:start + (size if start else first)].tobytes()
        length = len(part) // 4
        yield length, (doc_id, number, start, length, zlib.crc32(part)), part
        start, number = start + length, number + 1


def _sequences(pieces: Iterator[tuple], size: int, most: int, level: int) -> Iterator[pa.RecordBatch]:
    """Packed batches of a task's pieces; the open ones at its end come marked as such."""
    held = OpenSequences(size, most)
    first = (level << TASK_BITS | TaskContext.get().partitionId()) << NUMBER_BITS
    rows, made = [], 0

    def row(sequence: list, closed: bool) -> dict:
        nonlocal made
        offsets = np.cumsum([0, *[p[0][3] for p in sequence]])
        made += 1
        return {"sequence_id": first + made - 1, "closed": closed, "n_tokens": int(offsets[-1]),
                "ids": b"".join(p[1] for p in sequence),
                "pieces": [dict(zip(PIECE_FACTS, p[0], strict=True), offset=int(o)) for p, o in zip(sequence, offsets, strict=False)]}

    for length, facts, ids in pieces:
        closed = held.add(length, (facts, ids))
        if closed is not None:
            rows.append(row(closed, True))
        if len(rows) >= ROWS_AT_ONCE:
            yield pa.RecordBatch.from_pylist(rows, SEQUENCE)
            rows = []
    rows += [row(s, False) for s in held.rest()]
    for lo in range(0, len(rows), ROWS_AT_ONCE):
        yield pa.RecordBatch.from_pylist(rows[lo:lo + ROWS_AT_ONCE], SEQUENCE)


def packed(docs: DataFrame, tokenizer_path: str, end_id: int, size: int = 1024, id_col: str = "doc_id",
           text_col: str = "text", most_open: int = OPEN) -> DataFrame:
    """Stored sequences of at most `size` tokens: sequence_id, n_tokens, ids (little-endian
    unsigned 32-bit integers), pieces."""
    text_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("encoder", tokenizer_path, end_id), lambda: Encoder(tokenizer_path, end_id), ENCODER_BYTES)

        def pieces() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    yield from pieces_of(doc_id, encoder.encode(text), encoder.width, size)

        yield from _sequences(pieces(), size, most_open, 0)

    def again(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def pieces() -> Iterator[tuple]:
                for batch in batches:
                    for *facts, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                        yield facts[3], tuple(facts), ids
            yield from _sequences(pieces(), size, most_open, level)
        return run

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    made = store(rows.mapInArrow(encode, SEQUENCE_SQL), "sequences")
    out, level = [made.where("closed")], 0
    task = F.shiftright("sequence_id", NUMBER_BITS).bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    while True:
        left = made.where("not closed")
        tasks = left.agg(F.max(task)).head()[0]
        if not tasks:
            break
        level, fewer = level + 1, tasks // MERGED + 1
        ids = F.substring("ids", (4 * F.col("p.offset") + 1).cast("int"), (4 * F.col("p.length")).cast("int")).alias("ids")
        parts = left.select(F.floor(task / MERGED).cast("int").alias("to"), "ids", F.explode("pieces").alias("p")).select(
            "to", *[f"p.{c}" for c in PIECE_FACTS], ids)
        dealt = parts.repartitionById(fewer, "to").sortWithinPartitions(F.desc("length"), "doc_id", "piece", "ids_crc32").drop("to")
        made = store(dealt.mapInArrow(again(level), SEQUENCE_SQL), "sequences")
        out.append(made.where("closed"))
    out.append(left)
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole.drop("closed")


def pieces(sequences: DataFrame) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return sequences.select("sequence_id", F.explode("pieces").alias("p")).select("p.*", "sequence_id")
