"""Language-model scores: subword lattice likelihoods, beside a word-count base.

Words are counted over all training texts. The pieces of an existing vocabulary get their
probabilities from those counts (the vocabulary's own segmentation of every training word), and
each distinct word of any text is scored once by the lattice's forward recursion, summing all
its segmentations. A word seen in training is one more arc, over the whole word: with N words
and V different ones in training, P(w) = c(w) / (N + V) + V / (N + V) * lattice(w).
A text of words w1 .. wn has probability
    q * product of (1 - q) * P(wi),   q = (training texts + 1) / (training tokens + 2),
q being the chance that a text ends. The base is an add-one unigram over words and the end.

Words that are frequent enough to be among the `TOP` most frequent travel to the tasks as one
bounded table; every other word occurrence meets its counts in a join. Both give the same values.

Null and empty texts are their end alone. Rows that repeat an id or a text each get their score.
Without training rows N and V are 0. Texts and words of any length are read whole. Only the id,
the text and what the training condition names are read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import per_process, store, text_batches
from ledgerlake.llm.lattice import Lattice, Vocabulary, probabilities

TOP, TOP_BYTES = 120_000, 64
HELD_WORDS, LATTICE_WORDS = 200_000, 20_000


def _words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_counts(docs: DataFrame) -> DataFrame:
    """docs(text, train) to stored (word, c: in training texts, n: in all)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = Counter(), Counter()

        def rows() -> pd.DataFrame:
            words = list(both[0].keys() | both[1].keys())
            c = [both[1][w] for w in words]
            n = [both[0][w] + x for w, x in zip(words, c, strict=True)]
            for counter in both:
                counter.clear()
            return pd.DataFrame({"word": words, "c": c, "n": n})

        for batch in batches:
            for text, train in zip(batch["text"], batch["train"], strict=True):
                both[train].update(_words(text))
            if len(both[0]) + len(both[1]) > HELD_WORDS:
                yield rows()
        yield rows()

    return store(docs.select("text", "train").mapInPandas(run, "word binary, c long, n long")
                 .groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "word-counts")


def piece_probabilities(words: DataFrame, vocabulary_path: str) -> np.ndarray:
    """(pieces x 1), from the training counts of all words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = per_process(("pieces", vocabulary_path), lambda: Vocabulary(vocabulary_path))
        total = np.zeros(vocabulary.size)
        for batch in batches:
            if len(batch):
                total += vocabulary.count([w.decode("utf-8", "replace") for w in batch["word"]],
                                          batch["c"].to_numpy(float))
        at = np.flatnonzero(total)
        yield pd.DataFrame({"piece": at, "n": total[at]})

    found = (words.where("c > 0").select("word", "c").mapInPandas(run, "piece int, n double")
             .groupBy("piece").agg(F.sum("n").alias("n")).toPandas())  # a row per piece at most
    table = np.zeros((Vocabulary(vocabulary_path).size, 1))
    table[found["piece"].to_numpy(), 0] = found["n"].to_numpy()
    return probabilities(table)


def word_scores(words: DataFrame, vocabulary_path: str, probs: np.ndarray, n: int, v: int) -> DataFrame:
    """Stored: words with lp, the log10 of P(w); n and v count the words of the training texts."""
    shared = words.sparkSession.sparkContext.broadcast(probs)

    def scored_words(lattice: Lattice, batch: pd.DataFrame) -> pd.DataFrame:
        spelt = lattice.forward([w.decode("utf-8", "replace") for w in batch["word"]])[:, 0]
        with np.errstate(divide="ignore"):
            whole = np.log(batch["c"].to_numpy(float) / max(1, n + v))
        rest = np.log(v / (n + v)) if v else 0.0
        return batch.assign(lp=np.logaddexp(whole, rest + spelt) / np.log(10))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice, waiting = Lattice(Vocabulary(vocabulary_path), shared.value), []
        for batch in batches:
            waiting.append(batch)
            # The lattice takes words of a length together, so it gets many at a time.
            if sum(map(len, waiting)) >= LATTICE_WORDS:
                yield scored_words(lattice, pd.concat(waiting, ignore_index=True))
                waiting = []
        if waiting:
            yield scored_words(lattice, pd.concat(waiting, ignore_index=True))

    return store(words.mapInPandas(run, "word binary, c long, n long, lp double"), "word-scores")


def frequent(words: DataFrame, limit: int = TOP) -> pd.DataFrame:
    """The most frequent words: all that occur at least as often as the limit allows."""
    short = words.where(F.length("word") <= TOP_BYTES)
    steps = short.groupBy("n").agg(F.count("*").alias("words")).where("n > 1").select(
        F.floor(F.log2("n") * 16).cast("int").alias("step"), "words").groupBy("step").agg(F.sum("words").alias("words"))
    room, least = limit, None
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):  # sixteen steps per doubling
        if r["words"] > room:
            break
        room, least = room - r["words"], r["step"]
    found = short.where(F.floor(F.log2("n") * 16) >= (1 << 30 if least is None else least))
    return found.where("n > 1").select("word", "c", "lp").toPandas()


def scored(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
           train: str = "true") -> DataFrame:
    """Per row of `docs`: id, train, n_tokens, n_known, train_tokens, base_score, score. `train` is
    an SQL condition on `docs`."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.coalesce(F.expr(train), F.lit(False)).cast("int").alias("train"))
    counts = word_counts(rows)
    ends = rows.agg(F.sum("train")).head()[0] or 0
    facts = counts.agg(F.sum("c").alias("c"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).head()
    words_n, words_v = facts["c"] or 0, facts["v"]
    n, v = words_n + ends, words_v + (ends > 0)
    stop = (ends + 1) / (n + 2)
    go, stop = float(np.log10(1 - stop)), float(np.log10(stop))
    words = word_scores(counts, vocabulary_path, piece_probabilities(counts, vocabulary_path), words_n, words_v)
    table = frequent(words)
    shared = docs.sparkSession.sparkContext.broadcast((
        list(table["word"]), table["c"].to_numpy(np.int64), table["lp"].to_numpy(float)))
    key = ("frequent", uuid.uuid4().hex)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top, c, lp = per_process(key, lambda: (
            {w: i for i, w in enumerate(shared.value[0])}, *shared.value[1:]), 48 << 20)
        base = np.log10((c + 1) / (n + v + 1))
        for batch in batches:
            out = []
            for text in batch["text"]:
                words = _words(text)
                at = np.fromiter(map(top.get, words, repeat(-1)), np.int64, len(words))
                tail = Counter(words[i] for i in np.flatnonzero(at < 0))
                at = at[at >= 0]
                out.append((len(words) + 1, int((c[at] > 0).sum()) + (ends > 0), float(base[at].sum()),
                            float(lp[at].sum()), list(tail), list(tail.values())))
            made = pd.DataFrame(out, columns=["n_tokens", "known", "base", "lp", "words", "times"])
            yield pd.concat([batch[["row", "id", "train"]].reset_index(drop=True), made], axis=1)

    kind = dict(rows.dtypes)["id"]
    first = store(rows.select(F.monotonically_increasing_id().alias("row"), "id", "train", "text").mapInPandas(
        run, f"row long, id {kind}, train int, n_tokens long, known long, base double, lp double, "
             "words array<binary>, times array<long>"), "score-parts")
    rare = (first.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
            "row", F.col("x.words").alias("word"), "x.times")
            .join(words.select("word", "c", "lp"), "word").groupBy("row").agg(
                F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_r"),
                F.sum(F.col("times") * F.log10((F.col("c") + 1) / F.lit(float(n + v + 1)))).alias("base_r"),
                F.sum(F.col("times") * F.col("lp")).alias("lp_r")))
    zero = F.lit(0.0)
    end_base = float(np.log10((ends + 1) / (n + v + 1)))
    return first.select("row", "id", "train", "n_tokens", "known", "base", "lp").join(rare, "row", "left").select(
        "id", "train", "n_tokens", (F.col("known") + F.coalesce("known_r", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_r", zero) + end_base).alias("base_score"),
        (F.col("lp") + F.coalesce("lp_r", zero) + (F.col("n_tokens") - 1) * go + stop).alias("score"))
