"""The registered queries of the training-data operators, over whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (decontaminate, hard_negatives, jaccard_join, knn, language, licences, lm_score, mixing,
                            packing, pages, phrases, repeats, token_files)
from ledgerlake.llm.common import crc_bucket, table
from ledgerlake.session import checkpoint_folder, configure

END_ID = 2
PIECES = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(configure(spark), folder)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return run


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query
def op1_token_files(spark, folder):
    """Encode `documents` into a token folder and read every document back from it."""
    target = new_folder(spark, "tokens")
    token_files.write_tokens(table(spark, folder, "documents"), target,
                             public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_files.token_digests(spark, target)


@query
def op2_decontamination(spark, folder):
    """Words of `documents` that lie in windows of `benchmark` items."""
    rows = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query
def op3_repeated_passages(spark, folder):
    """Passages of `documents` that stand elsewhere too: first occurrences and those to remove."""
    rows = repeats.repeated_passages(table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "first_word", "n_words", F.col("kept_ids").alias("kept_doc_ids"), "removed")


@query
def op4_language(spark, folder):
    """Language of every document, learned from those outside the fold that is held out."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", "lang", (crc_bucket(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = language.learn(docs.where("not held_out"), public_tokenizers.path(PIECES))
    rows = language.with_language(docs.select("doc_id", "held_out", "text"), model)
    return rows.select("doc_id", "held_out", "_language.lang_pred", "_language.score")


@query
def op5_main_text(spark, folder):
    """Main text of every page by the consensus of its host."""
    rows = pages.with_main_text(table(spark, folder, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", F.col("_main").alias("text"), F.length("_main").cast("long").alias("n_chars"))


@query
def op6_source_mix(spark, folder):
    """What the mix of all sources takes of every document."""
    rows = mixing.take(table(spark, folder, "documents"))
    return rows.select("doc_id", *[F.col(f"_mix.{c}").alias(c) for c in ("size", "source_size", "target", "taken")])


@query
def op7_jaccard_join(spark, folder):
    """Classes of documents linked by the similarity of their five-word shingles."""
    rows = jaccard_join.with_component(table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op8_lm_score(spark, folder):
    """Lattice and base log10 probabilities of every document, learned outside the held-out fold."""
    docs = table(spark, folder, "documents").select(
        "doc_id", "text", (crc_bucket(F.col("doc_id"), 7) != 2).alias("train"))
    rows = lm_score.scored(docs, public_tokenizers.path(PIECES), train="train")
    return rows.select(F.col("id").alias("doc_id"), (F.col("train") == 0).alias("held_out"), "n_tokens", "n_known",
                       "train_tokens", "base_score", "score")


@query
def op9_licence_scan(spark, folder):
    """Known licences that whole documents, paragraphs or lines consist of."""
    rows = licences.scan(table(spark, folder, "documents"), licences.known_licences(spark))
    return rows.select(F.col("id").alias("doc_id"), "licence_id", "whole", "n_texts")


@query
def op10_exact_top_k(spark, folder):
    """The five highest integer inner products of every fiftieth vector with all others."""
    best = knn.top_k(table(spark, folder, "embeddings"), "id % 50 = 0")
    return best.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


@query
def op11_packing(spark, folder):
    """Pieces of all `documents`, packed into sequences of at most 1024 tokens."""
    made = packing.packed(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return packing.pieces(made)


@query
def op12_hard_negatives(spark, folder):
    """The ten best rows of other labels within 30 to 90 percent of each of an anchor's five positives."""
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), "id % 100 = 0")


@query
def op13_phrases(spark, folder):
    """The 2000 best two- and three-word phrases of `documents` in every language."""
    return phrases.collocations(table(spark, folder, "documents"))
