"""Approximate nearest neighbours by stable projections and a kd-tree.

A vector is projected on a few random directions with normal (2-stable) components: the
squared projected distance over the squared distance then follows a chi-square law with as
many degrees of freedom. Points near a query in the projected space, found in order of
projected distance in a kd-tree, are verified with their true distance. The search stops
when a point as near as the k-th best so far would have been met already with probability
``certainty``: the chi-square distribution at (next projected distance / k-th best)^2.

Rows are dealt into blocks of about ``block_rows`` by a hash of their id, each with a tree
of its own, and queries into chunks; each task searches one chunk in one block and returns
at most ``k`` rows a query, of which the k nearest over all blocks remain. A task's memory is
bounded by the two sizes. Equal vectors of a block are one point in the tree and give their
k + 1 smallest ids, so a large group of copies neither slows the search nor loses a tie.

Edge cases: vectors that are null, empty, all zeros or hold a null, NaN or infinite
component take no part; only vectors of the query's length are its candidates; a query's own
id is no candidate; rows that repeat an id and vector count once; fewer candidates than k are
all returned; ties go to the smaller id; null ids take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PROJECTIONS = 8
LEAF = 32
BLOCK_ROWS = 8_192
QUERY_ROWS = 4_096
CERTAINTY = 0.98


def usable(vector: str) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def chi_square(x: float, freedom: int = PROJECTIONS) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total if x < 700 else 1.0


def build_tree(points: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order of points, leaf borders in it, lower and upper corners of the leaves). Splits
    at the median of the widest side."""
    order, borders, stack = np.arange(len(points)), [], [(0, len(points))]
    while stack:
        a, b = stack.pop()
        if b - a <= leaf:
            borders.append((a, b))
            continue
        part = points[order[a:b]]
        side = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        mid = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, side], mid)]
        stack += [(a, a + mid), (a + mid, b)]
    edges = np.array(sorted(borders))
    low = np.array([points[order[a:b]].min(axis=0) for a, b in edges])
    high = np.array([points[order[a:b]].max(axis=0) for a, b in edges])
    return order, edges, low, high


class Block:
    """The candidates of one block, indexed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, seed: int = 29):
        rows = np.ascontiguousarray(vectors + 0.0)          # one form of zero
        keys = rows.view(np.dtype((np.void, rows.shape[1] * rows.itemsize)))[:, 0]
        _, first, group = np.unique(keys, return_index=True, return_inverse=True)
        by_group = np.lexsort((ids, group))
        owned = [np.unique(x)[:k + 1] for x in np.split(ids[by_group], np.cumsum(np.bincount(group))[:-1])]
        self.points, self.k = rows[first], k
        self.directions = np.random.default_rng(seed).normal(size=(rows.shape[1], PROJECTIONS))
        projected = self.points @ self.directions
        self.order, self.edges, self.low, self.high = build_tree(projected)
        self.sizes = np.array([len(owned[g]) for g in self.order])
        self.owned = [owned[g] for g in self.order]
        self.points = self.points[self.order]

    def search(self, own: int, query: np.ndarray, certainty: float = CERTAINTY) -> list[tuple[float, int]]:
        """The k nearest found, as (distance, id), nearest first."""
        place = query @ self.directions
        gap = np.maximum(np.maximum(self.low - place, place - self.high), 0)
        bound = (gap * gap).sum(axis=1)
        queue = np.argsort(bound, kind="stable")
        best: list[tuple[float, int]] = []
        at, step = 0, 4
        while at < len(queue):
            if len(best) == self.k:
                worst = best[-1][0]
                reach = bound[queue[at]]
                if worst == 0 and reach > 0 or worst > 0 and chi_square(reach / worst ** 2) >= certainty:
                    break
            rows = np.concatenate([np.arange(*self.edges[q]) for q in queue[at:at + step]])
            at, step = at + step, min(step * 2, 64)
            gaps = self.points[rows] - query
            distance = np.sqrt((gaps * gaps).sum(axis=1))
            if len(best) == self.k:
                near = distance <= best[-1][0]
                rows, distance = rows[near], distance[near]
            nearest = np.argsort(distance, kind="stable")
            # Rows that may be needed: k ids besides the query's own, and all that tie with the last.
            enough = np.searchsorted(np.cumsum(self.sizes[rows[nearest]]), self.k + 1)
            if enough < len(nearest):
                nearest = nearest[:np.searchsorted(distance[nearest], distance[nearest[enough]], "right")]
            found = [(float(distance[i]), int(x)) for i in nearest for x in self.owned[rows[i]] if x != own]
            best = sorted(set(best + found))[:self.k]
        return best


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            certainty: float = CERTAINTY, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest rows found for each row that ``is_query``: (query_id, rank, vec_id,
    score), score the Euclidean distance in double precision."""
    rows = vectors.where(usable(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("query"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("query"), 1)).alias("q")).first()
    blocks, chunks = max(1, -(-sizes.n // block_rows)), max(1, -(-sizes.q // query_rows))
    cell = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int")
    every = F.sequence(F.lit(0), F.lit(blocks - 1)), F.sequence(F.lit(0), F.lit(chunks - 1))
    # Candidates go to all query chunks, queries (the stated set) to all blocks.
    candidates = rows.select("id", "v", F.lit(False).alias("query"), cell[0].alias("block"), F.explode(every[1]).alias("chunk"))
    queries = rows.where("query").select("id", "v", "query", F.explode(every[0]).alias("block"), cell[1].alias("chunk"))
    dealt = candidates.unionByName(queries).withColumn("size", F.size("v"))

    def search(table: pa.Table) -> pa.Table:
        size = table["size"][0].as_py()
        ids, asks = table["id"].to_numpy(), table["query"].to_numpy(zero_copy_only=False)
        v = table["v"].combine_chunks().flatten().to_numpy().reshape(-1, size)
        out: list[tuple[int, int, float]] = []
        if asks.any() and not asks.all():
            block = Block(ids[~asks], v[~asks], k)
            for own, query in {(i, q.tobytes()): (i, q) for i, q in zip(ids[asks].tolist(), v[asks])}.values():
                out += [(own, x, d) for d, x in block.search(own, query, certainty)]
        q, x, d = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(x, pa.int64()), "score": pa.array(d, pa.float64())})

    found = dealt.groupBy("size", "block", "chunk").applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
