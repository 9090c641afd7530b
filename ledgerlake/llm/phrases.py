"""Phrases of two or three words, mined from a weighted de Bruijn graph of the corpus.

Texts are cut into pieces at punctuation and line breaks, pieces into words. Nodes of the graph
are two words in a row, edges three, and an edge's weight is how often it occurs; every language
has a graph of its own. A piece's last two words, and its last word, are counted beside the edges
as its end. Only these longest runs are counted in the texts: an occurrence of a node either goes
on along an edge or ends its piece, so a node's count is the sum of its outgoing edges and its
ends, and a word's count the sum over the nodes that it begins and its own ends.

A node whose every occurrence comes by one edge and leaves by one edge is unary. Paths over unary
nodes are compacted into one row (`Graph.paths`): a fixed expression of any length, with one
weight. All its edges and inner nodes have that weight; only the two outer nodes need their own.
Phrases are then read off the paths. Edges and nodes below `least` occurrences are left out after
counting, as neither they nor what holds them can be a phrase.

Scores are whole: a phrase of count a, cut into parts of counts l and r, scores
floor(1000000 a a / (l r)) at its worst cut; products are 38-digit decimals. Equal cuts go to the
earlier one, equal scores and counts to the phrase that sorts first by bytes.

Null texts are empty and empty texts hold nothing; a null language is `und`, together with a
language of that name. Rows that repeat a text count each time; ids are not read. A text of any
length is one row of words; its words leave as rows of their own. A path's words are one row,
never longer than the longest piece. An empty table gives no phrases. Other columns may have any
name: only text and language are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import store, text_batches

PIECE_ENDS = ".,;:!?\x0b\x0c\r"
UNKNOWN = "und"
SLICES = 64
# Different runs that a task holds before it sends them, and rows of a batch it sends.
HELD, SENT = 1_000_000, 50_000


class Graph(NamedTuple):
    """Stored tables. `words` and `nodes`: lang, gram, f. `paths`: lang, words, weight, and the
    counts f_first and f_last of the outer nodes. `inner`: lang, gram of the unary nodes."""

    totals: DataFrame
    words: DataFrame
    nodes: DataFrame
    paths: DataFrame
    inner: DataFrame


def pieces_of(text: bytes | None) -> Iterator[list[str]]:
    """The words of every piece of a text that has any, A-Z in lower case."""
    plain = (text or b"").lower().decode("utf-8", "replace").replace("\t", " ")
    for mark in PIECE_ENDS:
        plain = plain.replace(mark, "\n")
    for piece in plain.split("\n"):
        words = piece.split(" ")
        if "" in words:
            words = [w for w in words if w]
        if words:
            yield words


def longest_runs(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """node, tail, n: the edges and piece ends of the texts, and what they make of single words.

    An edge is its first node and its last word; a piece's last two words are a node without a
    tail. Nodes stand behind their language and a tab. A task adds up what it reads in a bounded
    table, and sums the runs that begin with a word, or end a piece with it, to a row of that word;
    the word '' stands for all words of a language. Counts are sums over tasks in any case, so they
    can be taken before or after the runs meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        singles: dict[str, Counter] = {}  # the words' sums, kept over several tables of runs

        def sent(nodes: list[str], tails: list[str], counts: list[int]) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(nodes), SENT):
                yield pa.RecordBatch.from_arrays([
                    pa.array(nodes[lo:lo + SENT], pa.string()), pa.array(tails[lo:lo + SENT], pa.string()),
                    pa.array(counts[lo:lo + SENT], pa.int64())], ["node", "tail", "n"])

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            for lang, counter in held.items():
                words = singles.setdefault(lang, Counter())
                nodes, tails, counts = [], [], []
                for gram, n in counter.items():
                    first, _, rest = gram.partition(" ")
                    words[first] += n
                    if rest:
                        second, _, tail = rest.partition(" ")
                        nodes.append(f"{lang}\t{first} {second}")
                        tails.append(tail)
                        counts.append(n)
                yield from sent(nodes, tails, counts)
            held.clear()
            if last or sum(map(len, singles.values())) > HELD // 2:
                for lang, words in singles.items():
                    words[""] = sum(words.values())
                    yield from sent([f"{lang}\t{w}" for w in words], [""] * len(words), list(words.values()))
                singles.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counter = held.setdefault(lang, Counter())
                for words in pieces_of(text):
                    counter.update(map(" ".join, zip(words, words[1:], words[2:], strict=False)))
                    counter[words[-1]] += 1
                    if len(words) > 1:
                        counter[f"{words[-2]} {words[-1]}"] += 1
                if sum(map(len, held.values())) > HELD:
                    yield from rows(False)
        yield from rows(True)

    text_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "node string, tail string, n long")


def counted(runs: DataFrame, least: int) -> DataFrame:
    """Stored (kind, lang, gram, f): edges and ends (3), nodes and words (2) with at least `least`
    occurrences; the word '' has each language's number of words.

    The runs are dealt by their node, so that one shuffle serves edges, nodes and words. The
    filters stand on the sums alone, which keeps the shuffle the same for both.
    """
    edges = runs.repartition("node").groupBy("node", "tail").agg(F.sum("n").alias("f"))
    nodes = edges.groupBy("node").agg(F.sum("f").alias("f"))
    gram = F.substring_index("node", "\t", -1)
    lang = F.expr("left(node, length(node) - length(substring_index(node, '\t', -1)) - 1)").alias("lang")
    return store(
        edges.where(F.col("f") >= least).select(
            F.lit(3).alias("kind"), lang, F.concat_ws(" ", gram, F.when(F.col("tail") != "", F.col("tail"))).alias("gram"), "f")
        .unionByName(nodes.where((F.col("f") >= least) | F.col("node").endswith("\t")).select(
            F.lit(2).alias("kind"), lang, gram.alias("gram"), "f")), "grams")


def _first(gram: str, n: int) -> Column:
    return F.substring_index(F.col(gram), " ", n)


def graph(docs: DataFrame, least: int = 10, text_col: str = "text", lang_col: str = "lang") -> Graph:
    grams = counted(longest_runs(docs, text_col, lang_col), least)
    known, pair = grams.where("kind = 2").select("lang", "gram", "f"), F.col("gram").contains(" ")
    words, nodes = known.where(~pair & (F.col("gram") != "")), known.where(pair)
    totals = known.where("gram = ''").select("lang", F.col("f").alias("n"))
    begin, end = nodes.withColumnsRenamed({"gram": "begin", "f": "f_begin"}), nodes.withColumnsRenamed(
        {"gram": "end", "f": "f_end"})
    edges = grams.where((F.col("kind") == 3) & F.col("gram").like("% % %")).select(
        "lang", "gram", "f", _first("gram", 2).alias("begin"), F.substring_index("gram", " ", -2).alias("end"))
    edges = store(edges.join(begin, ["lang", "begin"]).join(end, ["lang", "end"])
                  .withColumn("id", F.monotonically_increasing_id()), "edges")

    # A node is unary if one edge brings all its occurrences and one takes all of them on; there
    # is at most one edge of either kind, so this join makes no pairs.
    brings = edges.where("f = f_end").select("lang", F.col("end").alias("gram"), F.col("id").alias("before"))
    takes = edges.where("f = f_begin").select("lang", F.col("begin").alias("gram"), "id")
    links = store(brings.join(takes, ["lang", "gram"]), "links")

    # Every edge finds the first edge of its path by doubling its steps back; a round writes only
    # the edges that are still on their way. A circle of unary nodes cannot be: the pieces that
    # hold it must have entered it somewhere.
    moving = store(links.select("id", F.col("before").alias("head"), F.lit(1).alias("at"), F.lit(False).alias("done")), "places")
    arrived = moving.where("done")
    while not moving.where("not done").isEmpty():
        known = arrived.unionByName(moving.where("not done")).select(
            F.col("id").alias("head"), F.col("head").alias("to"), F.col("at").alias("more"), F.col("done").alias("there"))
        moving = store(moving.where("not done").join(known, "head", "left").select(
            "id", F.coalesce("to", "head").alias("head"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"),
            F.coalesce("there", F.lit(True)).alias("done")), "places")
        arrived = arrived.unionByName(moving.where("done"))
    places = edges.join(arrived.drop("done"), "id", "left").withColumns(
        {"head": F.coalesce("head", "id"), "at": F.coalesce("at", F.lit(0))})

    row = F.struct("at", "gram", "f_begin", "f_end")
    paths = (places.groupBy("lang", "head").agg(
        F.max("f").alias("weight"), F.sort_array(F.collect_list(row)).alias("edges"))
        .select("lang", "weight", F.col("edges")[0]["f_begin"].alias("f_first"),
                F.element_at("edges", -1)["f_end"].alias("f_last"),
                F.concat(F.split(F.col("edges")[0]["gram"], " "),
                         F.transform(F.slice("edges", F.lit(2), F.size("edges")),
                                     lambda e: F.substring_index(e["gram"], " ", -1))).alias("words")))
    return Graph(totals, words, nodes, store(paths, "paths"), links.select("lang", "gram"))


def _score(a: str, left: str, right: str) -> Column:
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a * a), left * right)


def collocations(docs: DataFrame, least: int = 10, covered_percent: int = 50, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `top` phrases.

    A phrase is dropped if its words lie inside a longer one of at least `covered_percent` of its
    occurrences.
    """
    g = graph(docs, least, text_col, lang_col)
    last = F.size("words") - 3
    triples = g.paths.select("lang", "weight", "f_first", "f_last", "words", F.posexplode(
        F.sequence(F.lit(0), last)).alias("i", "_i")).select(
        "lang", F.array_join(F.slice("words", F.col("i") + 1, F.lit(3)), " ").alias("gram"), F.col("weight").alias("a"),
        F.when(F.col("i") == 0, F.col("f_first")).otherwise(F.col("weight")).alias("f12"),
        F.when(F.col("i") == last, F.col("f_last")).otherwise(F.col("weight")).alias("f23"))
    # Inner nodes lie in an edge of their own weight; outer nodes in those of their paths.
    outer = g.paths.select("lang", "weight", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.lit(2)), " "),
        F.array_join(F.slice("words", F.lit(-2), F.lit(2)), " "))).alias("gram"))
    cover = outer.groupBy("lang", "gram").agg(F.max("weight").alias("cover"))
    pairs = (g.nodes.join(g.inner, ["lang", "gram"], "left_anti").join(cover, ["lang", "gram"], "left")
             .where(F.col("cover").isNull() | (100 * F.col("cover") < covered_percent * F.col("f")))
             .select("lang", "gram", F.col("f").alias("a"), F.lit(None).cast("long").alias("f12"),
                     F.lit(None).cast("long").alias("f23")))
    phrases = triples.unionByName(pairs).withColumns({
        "first": _first("gram", 1), "last": F.substring_index("gram", " ", -1)})
    for end, name in (("first", "fa"), ("last", "fz")):
        phrases = phrases.join(g.words.withColumnsRenamed({"gram": end, "f": name}), ["lang", end])
    phrases = phrases.withColumns({"r1": F.coalesce("f23", "fz"), "l2": F.coalesce("f12", "fa")}).withColumns(
        {"s1": _score("a", "fa", "r1"), "s2": _score("a", "l2", "fz")})
    early = F.col("s1") <= F.col("s2")
    scored = phrases.select("lang", F.col("gram").alias("phrase"), "a",
                            F.when(early, F.col("fa")).otherwise(F.col("l2")).alias("l"),
                            F.when(early, F.col("r1")).otherwise(F.col("fz")).alias("r"),
                            F.least("s1", "s2").alias("score"))
    # First the best of every slice of a language, so that what ranks a whole one is bounded.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    slices = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SLICES))).orderBy(*order)
    some = scored.withColumn("rank", F.row_number().over(slices)).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(F.broadcast(g.totals), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
