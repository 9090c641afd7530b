"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text's words are hashed; every run of k words has a hash, and of each run of 13 words the
smallest of its 9 k-word hashes is kept as fingerprint. Any 13 words that a document shares with
an item therefore share their fingerprint. Fingerprints of documents and items are joined; in
texts with a hit, every 13-word window with a hit fingerprint is then extended to the whole
window and compared by digest with the item's windows. An item of fewer than 13 words is one
window of its own length; its run of words is then its fingerprint.

Null and empty texts have no words: nothing is hit, and an item without words has no window.
Windows that several items share count for each of them; rows that repeat an item id are one
item; items without an id count under the empty id. Work is done per distinct text, so rows that
repeat a text or an id are safe and each gets its result. Texts of any length are read whole, as one
row of words. Of the documents only the id and the text are read; `clean_documents` hands on all
columns, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_lower, broadcast_if_small, store, text_key

WINDOW, GRAM = 13, 5
# Fixed values of the word rule: everything that ends a word, A-Z being in lower case already.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def runs(items: Column, length: int) -> Column:
    """Start positions, from 1, of all runs of `length` elements of an array."""
    n = F.size(items) - (length - 1)
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def prepared(texts: DataFrame, *keys: str) -> DataFrame:
    """keys, words, the words' hashes `h`, and the hashes of their k-word runs `g`."""
    hashed = texts.select(*keys, words(F.col("text")).alias("words")).withColumn(
        "h", F.transform("words", lambda w: F.xxhash64(w)))
    return hashed.withColumn("g", F.transform(
        runs(F.col("h"), GRAM),
        lambda i: F.xxhash64(*[F.get("h", i + (j - 1)) for j in range(GRAM)])))


def fingerprint(p: Column, length: int) -> Column:
    """Of the run of `length` words from position p: its smallest k-word hash, or a hash of all."""
    if length == WINDOW:
        return F.array_min(F.slice("g", p, WINDOW - GRAM + 1))
    return F.xxhash64(F.lit(length), F.slice("h", p, length))


def positions(length: int) -> Column:
    """Starts of all runs of `length` words. Those of whole windows are told from `g`: naming it
    here too keeps Spark from computing it anew for every window."""
    if length == WINDOW:
        return runs(F.col("g"), WINDOW - GRAM + 1)
    return runs(F.col("h"), length)


def fingerprints(length: int) -> Column:
    return F.transform(positions(length), lambda p: fingerprint(p, length))


def windows(length: int) -> Column:
    """(p, length, fingerprint, digest) of every run of `length` words."""
    return F.transform(positions(length), lambda p: F.struct(
        p.alias("p"), F.lit(length).alias("length"), fingerprint(p, length).alias("fp"),
        F.md5(F.array_join(F.slice("words", p, length), " ")).alias("digest")))


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored: digest, length, fp and the sorted ids of the items that hold the window."""
    rows = prepared(items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                                 F.col(text_col).alias("text")), "item")
    short = F.lit(None).cast("array<struct<p:int,length:int,fp:bigint,digest:string>>")
    for m in range(1, WINDOW):
        short = F.when(F.size("words") == m, windows(m)).otherwise(short)
    found = rows.select("item", F.explode(
        F.when(F.size("words") >= WINDOW, windows(WINDOW)).otherwise(short)).alias("w"))
    return store(found.groupBy("w.digest", "w.length", "w.fp").agg(
        F.sort_array(F.collect_set("item")).alias("items")), "item-windows")


def text_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
              item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(n_words of every row, with all columns that `docs` has besides the text; hits per text).

    The first has tkey and n_words; the second tkey, n_hit, items (sorted ids) for texts in which
    a window occurs.
    """
    known = item_windows(items, item_id, item_text)
    short = sorted(r["length"] for r in known.select("length").distinct().collect()
                   if r["length"] < WINDOW)  # twelve values at most
    marks = broadcast_if_small(store(known.select("fp").distinct(), "item-fingerprints"))

    keep = [c for c in docs.columns if c != text_col]
    source = docs.select(*[F.col(c).alias(f"_own_{i}") for i, c in enumerate(keep)],
                         text_key(F.col(text_col)).alias("tkey"), F.col(text_col).alias("text"))
    own = [f"_own_{i}" for i in range(len(keep))]
    marked = prepared(source, "tkey", *own).select("tkey", *own, F.size("words").alias("n_words"), F.array_distinct(
        F.concat(fingerprints(WINDOW), *map(fingerprints, short)))
        .alias("fps"))
    table = store(marked, "fingerprints")
    hit = (table.select("tkey", F.explode("fps").alias("fp")).join(marks, "fp", "left_semi")
           .select("tkey").distinct())
    hit = store(hit, "hit-texts")

    # Copies of a text give the same windows and meet again in the grouping below.
    texts = source.select("tkey", "text").join(broadcast_if_small(hit), "tkey", "left_semi")
    found = (prepared(texts, "tkey")
             .select("tkey", F.explode(F.concat(windows(WINDOW), *[windows(m) for m in short])).alias("w"))
             .select("tkey", "w.*").join(marks, "fp", "left_semi")
             .groupBy("tkey", "p", "length", "digest").agg(F.lit(1).alias("one")))
    exact = found.join(broadcast_if_small(known.select("digest", "length", "items")), ["digest", "length"])
    spans = F.sort_array(F.collect_set(F.struct("p", F.col("length").alias("n"))))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["p"] + s["n"]).alias("end"),
            (a["n"] + F.greatest(F.lit(0), s["p"] + s["n"] - F.greatest(a["end"], s["p"]))).alias("n")))
    hits = exact.groupBy("tkey").agg(
        spans.alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    counts = table.select("tkey", "n_words", *[F.col(f"_own_{i}").alias(c) for i, c in enumerate(keep)])
    return counts, store(hits.select("tkey", covered["n"].alias("n_hit"), "items"), "text-hits")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  one_in: int = 20) -> DataFrame:
    """Per row of `docs`: id, n_words, n_hit, items (ids of the items with occurring windows) and
    contaminated: at least one word in `one_in` is hit, and one at all."""
    counts, hits = text_hits(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), items)
    n_hit = F.coalesce("n_hit", F.lit(0))
    return counts.join(broadcast_if_small(hits), "tkey", "left").select(
        "id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (one_in * n_hit >= F.col("n_words"))).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", one_in: int = 20) -> DataFrame:
    """The rows of `docs` that aren't contaminated, whole."""
    counts, hits = text_hits(docs.select(F.col(text_col).alias("text")), items)
    bad = (counts.groupBy("tkey").agg(F.first("n_words").alias("n_words")).join(broadcast_if_small(hits), "tkey")
           .where((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).select(F.col("tkey").alias("_bad")))
    bad = store(bad, "contaminated-texts")
    return docs.join(broadcast_if_small(bad), text_key(docs[text_col]) == bad["_bad"], "left_anti")
