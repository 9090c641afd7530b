"""Token-id files: per-document zstandard frames over one shared dictionary, with an index.

A token folder holds three Parquet tables, so that Spark's commit protocol covers lost
executors and any store that Spark writes will do:

* `dictionary`: one row, the trained dictionary and its sha256;
* `blocks`: `payload` is a run of frames, one frame per document in ascending id order, with
  the documents' ids, token counts and frame offsets as arrays, and the dictionary's hash;
* `index`: one narrow row per document (start, token count, block, offset, length), for
  reading single short documents.

A frame holds the ids as little-endian unsigned integers of 2 bytes (vocabularies up to 65,536)
or 4 bytes.

Null texts count as empty: such a document is its end id alone. Documents that share an id
follow each other, in order of their texts. A null id comes first. Empty input gives empty
tables. Only the id and the text column are read, whatever else the input holds. Ids are
integers; other ids, such as text, stop the job. Texts of any length are encoded whole, in one task.
"""

from __future__ import annotations

import hashlib
import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import per_process, text_batches

# The dictionary is trained on so many characters in a row, from a place given by hash, of about
# this many documents, chosen by hash;
# a bounded sample is enough, as it only changes the compression.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS, DICTIONARY_BYTES = 400, 4000, 32768
BLOCK_BYTES, BLOCK_DOCUMENTS = 1 << 20, 2000
MEMO_BYTES = 96 << 20
ENCODER_BYTES = 2 * MEMO_BYTES + (40 << 20)
BLOCK = pa.schema([("part", pa.int32()), ("block", pa.int32()), *[(c, pa.list_(pa.int64())) for c in (
    "doc_ids", "n_tokens", "starts", "offsets")], ("dictionary", pa.string()), ("width", pa.int32()), ("payload", pa.binary())])
BLOCK_SCHEMA = ("part int, block int, doc_ids array<long>, n_tokens array<long>, "
                "starts array<long>, offsets array<long>, dictionary string, width int, "
                "payload binary")


class Encoder(dict):
    """Whole texts to serialized ids by the tokenizers library, remembering recent words.

    The tokenizer's pattern never joins a character with white space after it, and gives a
    single space to what follows it. A run of other characters with the one space or line feed
    before it is therefore encoded the same way in any text; so are letters and the punctuation
    that ends such a run. Texts with longer white space, or with the content of an added token,
    which has an id of its own wherever it stands, are encoded in one piece.

    Keys are such runs without their space, or with their line feed. A key that is no whole run
    has no value, which sends its text to the tokenizer.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = {2: "H", 4: "I"}[self.width]
        self.end = self.packed([end_id])
        # The byte-level alphabet: printable Latin-1 characters stand for themselves, the other
        # bytes for the characters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = sorted(set(range(256)).difference(plain))
        self.alphabet = dict(zip(plain, map(chr, plain))) | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}  # up to three of six marks, or a line feed
        self.held = 0

    def packed(self, ids: list[int]) -> bytes:
        values = array(self.kind, ids)
        if sys.byteorder == "big":
            values.byteswap()
        return values.tobytes()

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str) -> bytes:
        """Of letters, with or without a space before them: the pattern never splits these."""
        spelt = word.encode().decode("latin-1").translate(self.alphabet)
        return self.packed([t.id for t in self.tokenizer.model.tokenize(spelt)])

    def __missing__(self, key: str) -> bytes | None:
        value = self.older.get(key)
        if value is None:
            word = key.rstrip(",.;:!?")
            if key == "" or key == "\n" or key[:2].isspace() or (key[0].isspace() and key[0] != "\n"):
                value = None
            elif word.isalpha():
                value = self.word(" " + key) if word == key else self[word] + self.tail(key[len(word):])
            elif word[:1] == "\n" and word[1:].isalpha():
                value = self.tail("\n") + self.word(word[1:]) + self.tail(key[len(word):])
            else:
                value = self.whole(key if key[0] == "\n" else " " + key)
        self[key] = value
        self.held += 2 * len(key) + len(value or b"") + 150
        return value

    def tail(self, text: str) -> bytes:
        if text not in self.tails:
            value = self.whole(text)
            if len(text) > 3:
                return value
            self.tails[text] = value
        return self.tails[text]

    def encode(self, text: str) -> bytes:
        if self.held > MEMO_BYTES:
            self.older, self.held = dict(self), 0
            self.clear()
        if any(content in text for content in self.added):
            return self.whole(text) + self.end
        runs = ("\n" + text).replace("\n", " \n").split(" ")
        values = list(map(self.__getitem__, runs[1:]))
        try:
            ids = b"".join(values)
        except TypeError:  # a run without a value; looking for one first would compare every run
            return self.whole(text) + self.end
        return ids[self.width:] + self.end  # without the line feed put in front


def trained_dictionary(samples: list[bytes]) -> bytes:
    """A zstandard dictionary; empty if there is too little to learn from."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _codec(dictionary: bytes):
    import zstandard

    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return (zstandard.ZstdCompressor(level=3, dict_data=shared, write_dict_id=False),
            zstandard.ZstdDecompressor(dict_data=shared))


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text of `docs` and write the token folder."""
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64("tie", "id"), F.lit(1 << 40)) < share * (1 << 40)
    places = F.greatest(F.length("text") - SAMPLE_CHARACTERS + 1, F.lit(1))
    begin = (F.pmod(F.xxhash64("id", "tie"), places) + 1).cast("int")
    sample = (rows.where(chosen).select(F.substring(F.col("text"), begin, F.lit(SAMPLE_CHARACTERS)).alias("text"))
              .limit(4 * SAMPLE_DOCUMENTS).collect())  # the limit binds only among repeated rows
    encoder = Encoder(tokenizer_path, end_id)
    dictionary = trained_dictionary([encoder.encode(r.text) for r in sample])
    sha = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(sha, dictionary)], "sha256 string, bytes binary") \
        .coalesce(1).write.parquet(f"{folder}/dictionary")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_process(("encoder", tokenizer_path, end_id), lambda: Encoder(tokenizer_path, end_id), ENCODER_BYTES)
        compressor, _ = _codec(dictionary)
        part, block, tokens, size = TaskContext.get().partitionId(), 0, 0, 0
        documents: list[tuple] = []
        frames: list[bytes] = []

        def row() -> pa.RecordBatch:
            ids, counts, starts, offsets = map(list, zip(*documents, strict=True))
            values = part, block, ids, counts, starts, offsets, sha, encoder.width, b"".join(frames)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, BLOCK, strict=True)], schema=BLOCK)

        for batch in batches:
            ids, texts = (c.to_pylist() for c in batch.columns)
            for doc_id, data in zip(ids, map(encoder.encode, texts), strict=True):
                frame, count = compressor.compress(data), len(data) // encoder.width
                documents.append((doc_id, count, tokens, size))
                frames.append(frame)
                tokens, size = tokens + count, size + len(frame)
                if size >= BLOCK_BYTES or len(frames) >= BLOCK_DOCUMENTS:
                    yield row()
                    block, size, documents, frames = block + 1, 0, [], []
        if frames:
            yield row()

    # The random second key spreads rows that agree in all else over several tasks.
    ordered = (rows.withColumn("spread", F.rand(7)).repartitionByRange("id", "tie", "spread")
               .sortWithinPartitions("id", "tie", "spread")
               .select("id", "text"))
    (ordered.mapInArrow(blocks, BLOCK_SCHEMA)
     .write.option("compression", "uncompressed").parquet(f"{folder}/blocks"))

    written = spark.read.parquet(f"{folder}/blocks")
    # One row per writing task, however many documents there are.
    tasks = written.groupBy("part").agg(F.max(
        F.element_at("starts", -1) + F.element_at("n_tokens", -1)).alias("n"))
    firsts = tasks.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    entries = written.select(
        "part", "block", F.length("payload").cast("long").alias("bytes"), "offsets",
        F.posexplode(F.arrays_zip("doc_ids", "n_tokens", "starts", "offsets")).alias("at", "x"))
    (entries.join(F.broadcast(firsts), "part").select(
        F.col("x.doc_ids").alias("doc_id"), (F.col("first") + F.col("x.starts")).alias("start"),
        F.col("x.n_tokens").alias("n_tokens"), "part", "block", "at",
        F.col("x.offsets").alias("offset"),
        (F.coalesce(F.get("offsets", F.col("at") + 1), F.col("bytes")) - F.col("x.offsets"))
        .alias("length"))
     .write.parquet(f"{folder}/index"))


def _dictionary(spark: SparkSession, folder: str) -> tuple[bytes, str]:
    row = spark.read.parquet(f"{folder}/dictionary").head()
    return bytes(row["bytes"]), row["sha256"]


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Every document of the folder, decoded from its frame: part, block, at (its place in the
    block), n_tokens, ids_crc32, and the ids (little-endian unsigned 32-bit integers) unless only
    the digests are wanted. The index has the rest."""
    dictionary, sha = _dictionary(spark, folder)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decompressor = _codec(dictionary)
        for batch in batches:
            for part, block, offsets, needed, width, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if needed != sha:
                    raise ValueError(f"block {part}/{block} needs dictionary {needed}")
                ids = [np.frombuffer(decompressor.decompress(payload[o:e]), f"<u{width}").astype("<u4").tobytes()
                       for o, e in zip(offsets, [*offsets[1:], len(payload)], strict=True)]
                n = len(ids)
                made = {"part": pa.array([part] * n, pa.int32()), "block": pa.array([block] * n, pa.int32()),
                        "at": pa.array(range(n), pa.int32()), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64())}
                yield pa.RecordBatch.from_pydict(made | ({"ids": pa.array(ids, pa.binary())} if with_ids else {}))

    blocks = spark.read.parquet(f"{folder}/blocks").select(
        "part", "block", "offsets", "dictionary", "width", "payload")
    return blocks.mapInArrow(decode, "part int, block int, at int, n_tokens long, ids_crc32 long"
                              + ", ids binary" * with_ids)


def read_documents(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids (array) of a few documents: only their frames are decoded."""
    dictionary, sha = _dictionary(spark, folder)
    wanted = spark.read.parquet(f"{folder}/index").where(F.col("doc_id").isin(doc_ids))
    blocks = spark.read.parquet(f"{folder}/blocks").select(
        "part", "block", "dictionary", "width", "payload")
    frames = blocks.join(F.broadcast(wanted), ["part", "block"]).select(
        "doc_id", "dictionary", "width",
        F.expr("substring(payload, cast(offset + 1 as int), cast(length as int))").alias("frame"))

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, decompressor = _codec(dictionary)
        for batch in batches:
            if (batch["dictionary"] != sha).any():
                raise ValueError("a frame needs another dictionary")
            yield pd.DataFrame({"doc_id": batch["doc_id"], "ids": [
                np.frombuffer(decompressor.decompress(f), f"<u{w}").astype("int64")
                for f, w in zip(batch["frame"], batch["width"], strict=True)]})

    return frames.mapInPandas(decode, "doc_id long, ids array<long>")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    decoded = read_tokens(spark, folder, with_ids=False)
    index = spark.read.parquet(f"{folder}/index").select("part", "block", "at", "doc_id", "start")
    return decoded.join(index, ["part", "block", "at"]).select(
        "doc_id", "start", "n_tokens", "ids_crc32")
