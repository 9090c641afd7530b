"""Exact top-k inner products as a Voronoi join.

Components become floor(scale * x); scores are exact integer inner products. Data vectors belong
to the cell of their nearest pivot; queries are dealt into groups of neighbouring cells and
bounded size. For a query q of a group, a cell with pivot p and radius r bounds every score by
q.p + |q| r, and its members nearest to p promise scores of at least q.p - |q| d. The k-th best
promise is what a group needs at least; a cell goes only to groups that its bound says it may
serve. Cells are cut into blocks, so a cell of any size is spread over tasks. Blocks are solved
by themselves and their few best per query are merged.

Vectors that are null or hold a null or a non-finite component take no part. Only vectors of
equal length are compared. Equal scores go to the smaller id; rows that repeat an id are ranked as
rows, but a query's own id is never a candidate, and rows that repeat a query id pool their results. Fewer candidates than k give fewer ranks; empty input gives none. Components
whose scaled size passes 2^53 are computed in Python integers; scores saturate at 64 bits. Vectors of any length are one row. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import broadcast_if_small, store

# Pivots are a bounded sample, chosen by hash; they decide what is skipped, never the result.
PIVOTS, GROUP_QUERIES, BLOCK_ROWS = 64, 1024, 8192
LIMIT = (1 << 63) - 1


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=float) for x in column])


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if bound < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    exact = [[min(LIMIT, max(-LIMIT - 1, sum(a * b for a, b in zip(u, v, strict=True))))
              for v in [[int(c) for c in r] for r in x]] for u in [[int(c) for c in r] for r in q]]
    return np.array(exact, np.int64).reshape(len(q), len(x))


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Stored: id, dims, v (whole numbers, as doubles) of the vectors that take part."""
    v = F.col(vector_col)
    usable = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = df.where(usable).select(F.col(id_col).cast("long").alias("id"), F.size(v).alias("dims"),
                                  F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v"))
    return store(out, "whole-vectors")


def top_k(df: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, id, score: each query's k best others. `is_query`: SQL condition on `id`."""
    spark = df.sparkSession
    vectors = whole_vectors(df, id_col, vector_col, scale)
    chosen = vectors.select("dims", "v").distinct().orderBy(F.xxhash64("v"), "v").limit(pivots).collect()
    # Lengths without a pivot of their own get one zero pivot: a single cell.
    by_dims: dict[int, np.ndarray] = {}
    for r in chosen:
        by_dims.setdefault(r["dims"], []).append(r["v"])
    by_dims = {d: np.array(rows, float) for d, rows in by_dims.items()}

    def pivots_of(d: int) -> np.ndarray:
        return by_dims[d] if d in by_dims else np.zeros((1, d))

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for d, part in batch.groupby("dims"):
                p, x = pivots_of(int(d)), _matrix(part["v"])
                apart = np.sqrt(np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ p.T + (p * p).sum(1)))
                cell = apart.argmin(axis=1)
                yield part.assign(cell=cell, apart=np.sqrt(((x - p[cell]) ** 2).sum(1)), norm=np.sqrt((x * x).sum(1)))

    placed = store(vectors.mapInPandas(
        cells, "id long, dims int, v array<double>, cell int, apart double, norm double"), "cells")
    # Several rows of an id, or a query among the nearest, leave k others at least.
    summary = placed.groupBy("dims", "cell").agg(
        F.count("*").alias("n"), F.max("apart").alias("radius"),
        F.count(F.when(F.expr(is_query), 1)).alias("queries"))
    steps = F.floor(F.col("apart") / F.greatest(F.col("radius"), F.lit(1e-9)) * 32)
    rings = placed.join(F.broadcast(summary.select("dims", "cell", "radius")), ["dims", "cell"]).groupBy(
        "dims", "cell", steps.alias("ring")).agg(F.count_distinct("id").alias("ids"), F.max("apart").alias("within"))
    facts = summary.orderBy("dims", "cell").collect()  # a row per cell: at most the pivots and one a length
    ring_rows = rings.collect()  # 33 a cell at most

    # Neighbouring cells, walked from pivot to nearest pivot, fill a group up to its size.
    group_of, n_groups, blocks_of = {}, 0, {}
    for d in sorted({r["dims"] for r in facts}):
        left = {r["cell"]: r for r in facts if r["dims"] == d}
        p, held, at = pivots_of(d), GROUP_QUERIES, next(iter(left))
        while left:
            r = left.pop(at)
            parts = -(-r["queries"] // GROUP_QUERIES)
            if held + r["queries"] > GROUP_QUERIES:
                n_groups, held = n_groups + max(1, parts), 0
            held += r["queries"]
            group_of[d, at] = (n_groups - max(1, parts), max(1, parts))
            blocks_of[d, at] = -(-r["n"] // BLOCK_ROWS)
            at = min(left, key=lambda c, at=at: ((p[c] - p[at]) ** 2).sum()) if left else None
    dealt = spark.createDataFrame(
        [(d, c, *group_of[d, c], blocks_of[d, c]) for d, c in group_of],
        "dims int, cell int, first_group int, groups int, blocks int")
    spread = F.xxhash64("id", "v")
    queries = store(placed.where(is_query).join(F.broadcast(dealt), ["dims", "cell"]).select(
        "id", "dims", "v", "norm", (F.col("first_group") + F.pmod(spread, F.col("groups")).cast("int")).alias("group"))
        .distinct(), "queries")

    # What each group needs at least, and what each cell may give it.
    radius = {(r["dims"], r["cell"]): r["radius"] for r in facts}

    def needs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b.iloc[lo:lo + 512] for b in batches for lo in range(0, len(b), 512)):
            for (d, group), part in batch.groupby(["dims", "group"]):
                d = int(d)
                p, q, norm = pivots_of(d), _matrix(part["v"]), part["norm"].to_numpy()[:, None]
                near = q @ p.T
                mine = [r for r in ring_rows if r["dims"] == d]
                low = near[:, [r["cell"] for r in mine]] - norm * np.array([r["within"] for r in mine])
                order = np.argsort(-low, axis=1)
                have = np.cumsum(np.array([r["ids"] for r in mine])[order], axis=1)
                enough = have >= k + 1  # one of them may be the query itself
                floor = np.where(enough.any(axis=1), np.take_along_axis(
                    low, np.take_along_axis(order, enough.argmax(axis=1)[:, None], 1), 1)[:, 0], -np.inf)
                mine = sorted(c for x, c in radius if x == d)
                high = near[:, mine] + norm * np.array([radius[d, c] for c in mine])
                slack = 1e-6 * (1 + np.abs(high))
                for j in np.flatnonzero((high + slack >= floor[:, None]).any(axis=0)):
                    yield pd.DataFrame({"dims": [d], "cell": [mine[j]], "group": [int(group)]})

    wanted = queries.mapInPandas(needs, "dims int, cell int, group int").distinct()
    wanted = store(wanted.join(F.broadcast(dealt.select("dims", "cell", "blocks")), ["dims", "cell"]), "wanted")
    data = (placed.select("id", "dims", "v", "cell").join(broadcast_if_small(wanted), ["dims", "cell"])
            .withColumn("block", F.pmod(spread, F.col("blocks")).cast("int"))
            .select("group", "dims", "cell", "block", "id", "v"))
    asked = wanted.select("group", "dims", "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    asked = queries.join(broadcast_if_small(asked), ["group", "dims"]).select(
        "group", "dims", "cell", "block", F.col("id").alias("query"), F.col("v").alias("qv"))

    def solve(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            right = right.sort_values("id", kind="stable")
            ids, x = right["id"].to_numpy(), _matrix(right["v"])
            for lo in range(0, len(left), 128):
                part = left.iloc[lo:lo + 128]
                q = _matrix(part["qv"])
                for query, row in zip(part["query"], products(q, x), strict=True):
                    others = np.flatnonzero(ids != query)
                    s = row[others]
                    if len(s) > k:
                        keep = np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                        others, s = others[keep], s[keep]
                    best = np.lexsort((ids[others], -s))[:k]
                    out += [(query, int(ids[others[b]]), int(s[b])) for b in best]
        return pd.DataFrame(out, columns=["query", "id", "score"])

    keys = ["group", "dims", "cell", "block"]
    local = asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInPandas(
        solve, "query long, id long, score long")
    # The window's limit is also applied before the shuffle, so a task sends k rows a query.
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return (local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select(F.col("query").alias("query_id"), "rank", "id", "score"))
