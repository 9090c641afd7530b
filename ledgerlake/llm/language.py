"""Language identification by segmentation-marginalised unigrams over a fixed public vocabulary.

Each language has a probability for every piece of the vocabulary, learned from labelled rows. A
text's likelihood in a language sums over all its segmentations; with the languages' shares of
the labelled rows as prior, the prediction is the most probable language and the score its
posterior probability. Ties go to the language that sorts first.

Null texts, and texts without a letter, are `und` with score 0; so is every text if no labelled
row is given. Rows without a language, or without a text, teach nothing. Texts of any length count whole;
their words are scored once a batch. Other columns are handed on, whatever their names but
_language.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import per_process, text_batches
from ledgerlake.llm.lattice import Lattice, Vocabulary, WordScores, probabilities

# The piece probabilities are fitted on about this many distinct texts of each language, chosen
# by hash and counted once each, however often a text is repeated.
ROWS_PER_LANGUAGE = 1500
UNKNOWN = "und"


class LanguageModel:
    """Languages, their prior logarithms and piece probabilities (pieces x languages)."""

    def __init__(self, vocabulary_path: str, languages: list[str], prior: np.ndarray, probs: np.ndarray):
        self.path, self.languages, self.prior, self.probs = vocabulary_path, languages, prior, probs
        self.name = hashlib.sha256(probs.tobytes() + repr(languages).encode()).hexdigest()


def learn(labelled: DataFrame, vocabulary_path: str, text_col: str = "text", lang_col: str = "lang",
          rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    text_batches(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang is not null and text is not null")
    shares = (rows.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.count("*").alias("n")).groupBy("lang")
              .agg(F.sum("n").alias("n"), F.count("*").alias("texts")).orderBy("lang").collect())  # a row per language
    languages = [r["lang"] for r in shares]
    if not languages:
        return LanguageModel(vocabulary_path, [], np.zeros(0), np.zeros((0, 0)))
    counts = np.array([r["n"] for r in shares], float)
    limits = rows.sparkSession.createDataFrame(
        [(x, i, min(1.0, rows_per_language / float(r["texts"]))) for i, (x, r) in enumerate(zip(languages, shares, strict=True))],
        "lang string, at int, share double")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = per_process(("pieces", vocabulary_path), lambda: Vocabulary(vocabulary_path))
        found = np.zeros((len(languages), vocabulary.size))
        for batch in batches:
            for at, texts in batch.groupby("at")["text"]:
                words = Counter(w for t in texts for w in t.lower().split())
                if words:
                    found[at] += vocabulary.count(list(words), np.fromiter(words.values(), float, len(words)))
        at, piece = np.nonzero(found)
        yield pd.DataFrame({"at": at, "piece": piece, "n": found[at, piece]})

    chosen = (rows.join(F.broadcast(limits), "lang")
              .where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
              .groupBy("at", F.md5(F.col("text").cast("binary"))).agg(F.first("text").alias("text")).select("at", "text"))
    totals = (chosen.mapInPandas(pieces, "at int, piece int, n double")
              .groupBy("at", "piece").agg(F.sum("n").alias("n")).toPandas())  # pieces x languages at most
    table = np.zeros((Vocabulary(vocabulary_path).size, len(languages)))
    table[totals["piece"].to_numpy(), totals["at"].to_numpy()] = totals["n"].to_numpy()
    return LanguageModel(vocabulary_path, languages, np.log(counts / counts.sum()), probabilities(table))


def predicted(model: LanguageModel, text: Column) -> Column:
    """Struct of lang_pred and score for a text column."""
    facts = (model.path, model.languages, model.prior, model.probs)
    shared = SparkSession.getActiveSession().sparkContext.broadcast(facts)  # pieces x languages
    name = model.name

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        path, languages, prior, probs = shared.value
        scores = per_process(("languages", name), lambda: WordScores(
            Lattice(Vocabulary(path), probs)), 128 << 20) if languages else None
        for texts in parts:
            out = []
            words = [t.lower().split() if t and languages and any(map(str.isalpha, t)) else None for t in texts]
            if scores:
                scores.learn(set().union(*(w for w in words if w)))
            for w in words:
                if w is None:
                    out.append((UNKNOWN, 0.0))
                    continue
                total = prior + scores.total(w)
                best = int(np.argmax(total))
                out.append((languages[best], float(1.0 / np.exp(total - total[best]).sum())))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    return predict(text)


def with_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """`docs` with a struct column _language: lang_pred, score."""
    text_batches(docs.sparkSession)
    return docs.select("*", predicted(model, F.col(text_col)).alias("_language"))
