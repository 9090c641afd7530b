"""Hard negatives of anchors by threshold joins in the manner of L2AP.

Components become floor(scale * x); scores are whole inner products. An anchor's positives are its
best other rows of the same label; for each of them the best rows of other labels are wanted whose
scores lie between two percentages of the positive's.

Both searches are threshold joins between groups of anchors and blocks of rows. A block is indexed
dimension by dimension, those of most weight first. A row is left out of the index from the
dimension on where the norm of what remains of it, times that of the anchors, stays under the
thresholds: what is left out could not reach them alone. Partial scores are accumulated along the
index, and a pair is dropped as soon as they and the product of the remaining norms stay under the
anchor's threshold; pairs left over get their exact score. Thresholds begin where a bounded sample
of rows says that about four times the wanted rows lie above, and are lowered for anchors whose
windows are not full: to the sample's own k-th best, which is enough wherever the sample has k, then to
the window's end. The sample decides where to begin, never what is found.

Anchors are taken in groups and rows in blocks of bounded bytes; a block gives each group its best
few per window. Ties go to the smaller id. Rows without id, label or vector, or with a null or
non-finite component, take no part. Only vectors of equal length are compared. Rows that repeat an
id are ranked as rows, but never for an anchor of that id; of several anchor rows of an id the one
with the least label and vector asks. Fewer rows than wanted give fewer ranks, empty tables none.
Columns of other names don't matter. Scores saturate at 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import store

GROUP_BYTES, BLOCK_BYTES, SAMPLE_BYTES = 32 << 20, 32 << 20, 4 << 20
LEAST_ROWS = 2048  # smaller blocks are not worth a task
TILE_ANCHORS, TILE_ROWS, STEP = 256, 8192, 8
LIMIT = (1 << 63) - 1


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole inner products of the rows of q with those of x, pair by pair."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if bound < 2.0 ** 53:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    made = [sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for u, v in zip(q, x, strict=True)]
    return np.array([min(LIMIT, max(-LIMIT, s)) for s in made], np.int64)


def _rest(m: np.ndarray) -> np.ndarray:
    """rest[i, j]: the norm of row i from dimension j on."""
    squares = np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(m), 1))], axis=1))


def threshold_join(q: np.ndarray, least: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs whose score is at least the anchor's threshold."""
    order = np.argsort(-(x * x).sum(axis=0), kind="stable")
    if not len(order):  # vectors without components score 0
        q, x, order = np.zeros((len(q), 1)), np.zeros((len(x), 1)), np.zeros(1, np.int64)
    q, x = q[:, order], x[:, order]
    rest_q, rest_x = _rest(q), _rest(x)
    whole, least = least, least.astype(float)
    slack = 1e-9 * (1 + np.abs(least) + rest_q[:, 0] * rest_x[:, 0].max(initial=0))
    least[whole <= -LIMIT] = -np.inf  # scores saturate there
    # Dimensions of a row that are indexed: up to where the remaining norms stay under the thresholds.
    need = rest_x * rest_q.max(axis=0) >= least.min() - slack.max()
    indexed = need.sum(axis=1) if least.min() > slack.max() else np.full(len(x), x.shape[1])
    by = np.argsort(-indexed, kind="stable")
    by = by[indexed[by] > 0]
    x, rest_x, indexed = x[by], rest_x[by], indexed[by]
    out = []
    for a in range(0, len(q), TILE_ANCHORS):
        for b in range(0, len(x), TILE_ROWS):
            qa, ta, xb, deep = q[a:a + TILE_ANCHORS], least[a:a + TILE_ANCHORS], x[b:b + TILE_ROWS], indexed[b:b + TILE_ROWS]
            sums = np.zeros((len(qa), len(xb)))
            for d in range(0, x.shape[1], STEP):
                open_rows = int((deep > d).sum())  # the posting list: rows whose index goes on
                if open_rows:
                    sums[:, :open_rows] += qa[:, d:d + STEP] @ xb[:open_rows, d:d + STEP].T
                at = min(d + STEP, x.shape[1])
                # Rows that left the index earlier still have all that follows their last step.
                seen = np.minimum(at, -(-deep // STEP) * STEP)
                seen = np.minimum(seen, x.shape[1])
                ahead = rest_x[b:b + TILE_ROWS][np.arange(len(xb)), seen]
                rest = rest_q[a:a + TILE_ANCHORS][:, seen] if open_rows < len(xb) else rest_q[a:a + TILE_ANCHORS, at][:, None]
                alive = sums + rest * ahead >= (ta - slack[a:a + TILE_ANCHORS])[:, None]
                if at == x.shape[1] or alive.sum() * 16 < alive.size:
                    break
            i, j = np.nonzero(alive)
            for lo in range(0, len(i), 1 << 16):
                part_i, part_j = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
                score = exact_scores(qa[part_i], xb[part_j])
                keep = score >= whole[a + part_i]
                out.append((part_i[keep] + a, by[part_j[keep] + b], score[keep]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(part) for part in zip(*out, strict=True))


def prepared(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """Stored: row, id, label, dims, v (whole numbers, as doubles) of the rows that take part."""
    v = F.col(vector_col)
    usable = (F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull()
              & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return store(df.where(usable).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"), F.size(v).alias("dims"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v")), "vectors")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=float) for x in column])


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: score descending, id ascending."""
    return np.lexsort((ids, -scores))[:k]


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


class Search:
    """Threshold joins of one set of anchors with one table of rows."""

    def __init__(self, vectors: DataFrame, is_anchor: str):
        self.vectors = vectors
        facts = vectors.agg(F.count("*").alias("n"), F.coalesce(F.max("dims"), F.lit(1)).alias("dims")).head()
        self.rows, size = facts["n"], 8 * max(1, facts["dims"])
        least = F.min(F.struct("label", "dims", "v")).alias("x")
        self.anchors = store(vectors.where(is_anchor).groupBy("id").agg(least).select(
            F.col("id").alias("anchor"), "x.label", "x.dims", F.col("x.v").alias("q")), "anchors")
        self.groups = max(1, -(-self.anchors.count() * size // GROUP_BYTES))
        cores = vectors.sparkSession.sparkContext.defaultParallelism
        self.blocks = max(1, -(-self.rows * size // BLOCK_BYTES), min(cores, self.rows // LEAST_ROWS))
        # A bounded sample by hash, in place of which any other would give the same rows.
        limit = max(1, SAMPLE_BYTES // size)
        share = min(1.0, limit / max(1, self.rows))
        some = vectors.where(F.pmod(F.xxhash64("row"), F.lit(1 << 40)) < share * (1 << 40)).limit(2 * limit).toPandas()
        self.sampled = len(some)
        kept = {int(d): (p["id"].to_numpy(np.int64), p["label"].to_numpy(), _matrix(p["v"])) for d, p in some.groupby("dims")}
        self.sample = vectors.sparkSession.sparkContext.broadcast(kept)

    def first_rank(self, k: int) -> int:
        """The sample's rank above which about four times k rows are expected in all."""
        return min(k, max(1, -(-4 * k * self.sampled // max(1, self.rows))))

    def join(self, asked: DataFrame, solve: Callable, same_label: bool, schema: str) -> DataFrame:
        """`solve(key, anchors, rows)` for every group of anchors and block of rows."""
        keys = ["dims", "label"] if same_label else ["dims"]
        group = F.pmod(F.xxhash64("anchor"), F.lit(self.groups)).alias("group")
        block = F.pmod(F.xxhash64("row"), F.lit(self.blocks)).alias("block")
        left = asked.select("*", group, F.explode(_numbers(self.blocks)).alias("block"))
        right = self.vectors.select("id", "label", "dims", "v", block, F.explode(
            _numbers(self.groups)).alias("group"))
        keys = [*keys, "group", "block"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(solve, schema)


def positives(search: Search, k: int) -> DataFrame:
    """Stored: anchor, label, dims, q, and arrays of up to k positive ids and scores, best first."""
    sample, first = search.sample, search.first_rank(k)

    def begin(batches):
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                ids, labels, x = sample.value.get(int(r.dims), (np.zeros(0, np.int64), np.zeros(0, object), np.zeros((0, int(r.dims)))))
                use = (labels == r.label) & (ids != r.anchor)
                s = exact_scores(np.broadcast_to(np.asarray(r.q, float), (int(use.sum()), int(r.dims))), x[use])
                s = np.sort(s)[::-1]
                rows.append((int(s[first - 1]) if len(s) >= first else -LIMIT, int(s[k - 1]) if len(s) >= k else -LIMIT))
            yield batch.assign(t1=[a for a, _ in rows], t2=[b for _, b in rows])

    def solve(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, anchors = right["id"].to_numpy(np.int64), left["anchor"].to_numpy(np.int64)
            i, j, s = threshold_join(_matrix(left["q"]), left["t"].to_numpy(np.int64), _matrix(right["v"]))
            keep = ids[j] != anchors[i]
            i, j, s = i[keep], j[keep], s[keep]
            for at in np.split(np.argsort(i, kind="stable"), np.cumsum(np.bincount(i, minlength=len(anchors)))[:-1]):
                best = at[_best(ids[j[at]], s[at], k)]
                out += [(int(anchors[i[b]]), int(ids[j[b]]), int(s[b])) for b in best]
        return pd.DataFrame(out, columns=["anchor", "id", "score"])

    kind = "anchor long, label string, dims int, q array<double>, t1 long, t2 long"
    left = store(search.anchors.mapInPandas(begin, kind), "asked")
    place = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    full, results = None, []
    for t in (F.col("t1"), F.col("t2"), F.lit(-LIMIT)):
        asked = left if full is None else left.join(full, "anchor", "left_anti")
        asked = store(asked.withColumn("t", t), "asked")
        if asked.isEmpty():
            break
        found = search.join(asked.select("anchor", "label", "dims", "q", "t"), solve, True, "anchor long, id long, score long")
        found = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        found = store(found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
                      .join(asked.select("anchor", "t"), "anchor"), "positives")
        done = found.where((F.size("p") >= k) | (F.col("t") == -LIMIT))
        results.append(done.select("anchor", "p"))
        full = done.select("anchor") if full is None else full.unionByName(done.select("anchor"))
    if not results:
        results = [search.anchors.where("false").select("anchor", F.array(F.struct(
            F.lit(1).alias("rank"), F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("score"))).alias("p"))]
    p = results[0]
    for more in results[1:]:
        p = p.unionByName(more)
    return store(search.anchors.join(p, "anchor").select(
        "anchor", "label", "dims", "q", F.col("p.id").alias("ids"), F.col("p.score").alias("scores")), "positives")


def hard_negatives(df: DataFrame, is_anchor: str, positives_each: int = 5, negatives_each: int = 10,
                   low_percent: int = 30, high_percent: int = 90, id_col: str = "vec_id",
                   label_col: str = "label", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. `is_anchor`: an
    SQL condition on `id`."""
    search = Search(prepared(df, id_col, label_col, vector_col, scale), is_anchor)
    k, first, sample = negatives_each, search.first_rank(negatives_each), search.sample

    def window(score: int) -> tuple[int, int]:
        """Whole scores between the two percentages; empty below 0."""
        return -(-low_percent * int(score) // 100), high_percent * int(score) // 100

    def begin(batches):
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                ids, labels, x = sample.value.get(int(r.dims), (np.zeros(0, np.int64), np.zeros(0, object), np.zeros((0, int(r.dims)))))
                use = (labels != r.label) & (ids != r.anchor)
                s = np.sort(exact_scores(np.broadcast_to(np.asarray(r.q, float), (int(use.sum()), int(r.dims))), x[use]))[::-1]
                t1, t2, floor = [], [], []
                for lo, hi in map(window, r.scores):
                    if lo > hi:
                        continue
                    inside = s[(s >= lo) & (s <= hi)]
                    t1.append(int(inside[first - 1]) if len(inside) >= first else lo)
                    t2.append(int(inside[k - 1]) if len(inside) >= k else lo)
                    floor.append(lo)
                rows.append((*(min(t, default=LIMIT) for t in (t1, t2, floor)), len(floor)))
            yield batch.assign(**{n: [r[c] for r in rows] for c, n in enumerate(("t1", "t2", "t3", "windows"))})

    def solve(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, labels = right["id"].to_numpy(np.int64), right["label"].to_numpy()
            i, j, s = threshold_join(_matrix(left["q"]), left["t"].to_numpy(np.int64), _matrix(right["v"]))
            anchors = left["anchor"].to_numpy(np.int64)
            keep = (labels[j] != left["label"].to_numpy()[i]) & (ids[j] != anchors[i])
            i, j, s = i[keep], j[keep], s[keep]
            order = np.lexsort((ids[j], -s, i))
            i, j, s = i[order], j[order], s[order]
            starts = np.searchsorted(i, np.arange(len(anchors) + 1))
            for a, r in enumerate(left.itertuples(index=False)):
                lo_at, mine = starts[a], s[starts[a]:starts[a + 1]]
                for at, score in enumerate(r.scores):
                    low, high = window(score)
                    begin_at = int(np.searchsorted(-mine, -high))
                    end_at = min(begin_at + k, int(np.searchsorted(-mine, -low, side="right")))
                    out += [(int(r.anchor), at, int(ids[j[lo_at + b]]), int(mine[b])) for b in range(begin_at, end_at)]
        return pd.DataFrame(out, columns=["anchor", "at", "id", "score"])

    known = positives(search, positives_each)
    kind = ("anchor long, label string, dims int, q array<double>, ids array<long>, scores array<long>, "
            "t1 long, t2 long, t3 long, windows int")
    left = store(known.mapInPandas(begin, kind), "asked")
    place = Window.partitionBy("anchor", "at").orderBy(F.desc("score"), "id")
    full, results = None, []
    for t in ("t1", "t2", "t3"):
        asked = left if full is None else left.join(full, "anchor", "left_anti")
        asked = store(asked.withColumn("t", F.col(t)), "asked")
        if asked.isEmpty():
            break
        found = search.join(asked.select("anchor", "label", "dims", "q", "scores", "t"), solve, False,
                            "anchor long, at int, id long, score long")
        found = store(found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k), "negatives")
        # A window is full with k rows, or if the threshold went down to its end.
        short = (asked.select("anchor", "windows", "t", "t3")
                 .join(found.groupBy("anchor", "at").agg(F.count("*").alias("n")).where(F.col("n") >= k)
                       .groupBy("anchor").agg(F.count("*").alias("filled")), "anchor", "left")
                 .where((F.coalesce("filled", F.lit(0)) < F.col("windows")) & (F.col("t") > F.col("t3"))).select("anchor"))
        short = store(short, "short")
        results.append(found.join(short, "anchor", "left_anti"))
        done = asked.select("anchor").join(short, "anchor", "left_anti")
        full = done if full is None else full.unionByName(done)
    made = "anchor long, at int, id long, score long, rank int"
    best = results[0] if results else df.sparkSession.createDataFrame([], made)
    for more in results[1:]:
        best = best.unionByName(more)
    return best.join(known.select("anchor", "ids", "scores"), "anchor").select(
        F.col("anchor").alias("anchor_id"), F.get("ids", F.col("at")).alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.get("scores", F.col("at")).alias("positive_score"),
        F.col("score").alias("negative_score"))
