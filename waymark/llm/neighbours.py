"""Approximate nearest neighbours: stable random projections in a kd-tree, verified until a chi-square test stops.

A vector is projected onto ``PROJECTIONS`` Gaussian directions; the square of a projected distance divided by that of
the true distance is then chi-square distributed. A kd-tree over the projected points gives them out nearest first;
their true distances are computed, and the search stops once a vector nearer than the k-th found would have shown up
with probability ``confidence``.

All rows are indexed: equal vectors are one entry that knows its smallest ids (a top-k window that Spark cuts before
the shuffle, so a vector that a third of all rows hold is no hot key), entries are dealt over shards of about
``SHARD_ROWS``, and blocks of queries meet every shard. The best of each shard are merged by one window of k rows a
shard and query.

Defined results: vectors that are null, empty, all zero, or hold a null or non-finite component take no part, as
query or candidate; a null id takes no part; vectors of different lengths are not compared; equal distances go to the
smaller id; repeated rows with one id are one candidate if equal in vector; fewer candidates than k are all returned;
an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS = 8
LEAF = 32
SHARD_ROWS = 8192
QUERY_BLOCK = 1024
CONFIDENCE = 0.98
SEED = 20240229


def chi_square(x: float, m: int = PROJECTIONS) -> float:
    """Distribution function for an even number m of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    if half > 300:
        return 1.0
    for i in range(1, m // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def stop_ratio(confidence: float, m: int = PROJECTIONS) -> float:
    """The squared ratio of projected to true distance that is exceeded with probability 1 - confidence."""
    low, high = 0.0, 400.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < confidence else (low, mid)
    return high


class Tree:
    """A kd-tree of points: nodes split at the median of their widest side, down to LEAF points."""

    def __init__(self, points: np.ndarray):
        self.points, self.order = points, np.arange(len(points))
        self.low, self.high, self.span, self.kids = [], [], [], []
        todo = [(0, len(points), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            inside = points[self.order[a:b]]
            node = len(self.span)
            self.low.append(inside.min(axis=0))
            self.high.append(inside.max(axis=0))
            self.span.append((a, b))
            self.kids.append([-1, -1])
            if parent >= 0:
                self.kids[parent][side] = node
            wide = self.high[node] - self.low[node]
            if b - a > LEAF and wide.max() > 0:
                mid = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(inside[:, int(wide.argmax())], mid)]
                todo += [(a, a + mid, node, 0), (a + mid, b, node, 1)]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def reach(self, node: int, point: np.ndarray) -> float:
        """Squared distance of the point to the node's box."""
        gap = np.maximum(np.maximum(self.low[node] - point, point - self.high[node]), 0)
        return float(gap @ gap)


def search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, near: np.ndarray, k: int, ratio: float
           ) -> list[tuple[float, int, int]]:
    """(distance, id, row) of the k nearest found, ties to smaller ids, from leaves in order of projected distance."""
    best: list[tuple[float, int, int]] = []
    heap = [(tree.reach(0, near), 0)]
    while heap:
        reach, node = heapq.heappop(heap)
        if len(best) >= k and reach > ratio * best[k - 1][0] ** 2:
            break
        left, right = tree.kids[node]
        if left >= 0:
            heapq.heappush(heap, (tree.reach(left, near), left))
            heapq.heappush(heap, (tree.reach(right, near), right))
            continue
        a, b = tree.span[node]
        rows = tree.order[a:b]
        away = vectors[rows] - query
        far = np.sqrt(np.einsum("ij,ij->i", away, away))
        best = heapq.nsmallest(k, best + list(zip(far.tolist(), ids[rows].tolist(), rows.tolist(), strict=True)))
    return best


def _direction(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dim, PROJECTIONS))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _searcher(k: int, confidence: float):
    ratio = stop_ratio(confidence)
    kinds = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(queries: pa.Table, entries: pa.Table) -> pa.Table:
        if not queries.num_rows or not entries.num_rows:
            return kinds.empty_table()
        vectors, asked = _matrix(entries["vector"]), _matrix(queries["vector"])
        turn = _direction(vectors.shape[1])
        tree, near = Tree(vectors @ turn), asked @ turn
        members = entries["ids"].to_pylist()
        smallest = np.array([min(ids) for ids in members])
        out = ([], [], [])
        for n, query_id in enumerate(queries["query_id"].to_pylist()):
            # one more: the entry that holds the query itself may hold nothing else
            rows = search(tree, vectors, smallest, asked[n], near[n], k + 1, ratio)
            found = [(d, vec_id) for d, _, row in rows for vec_id in members[row] if vec_id != query_id]
            for score, vec_id in sorted(found)[:k]:
                out[0].append(query_id)
                out[1].append(vec_id)
                out[2].append(score)
        return pa.table([pa.array(c, t.type) for c, t in zip(out, kinds, strict=True)], schema=kinds)

    return run


def usable(rows: DataFrame, vector: str) -> DataFrame:
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))


def nearest(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding",
            confidence: float = CONFIDENCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance) of the k nearest rows found for each query.

    A query's own row, by id, is no candidate.
    """
    kind = "array<double>"
    clean = usable(rows.where(F.col(f"`{key}`").isNotNull()), vector).select(
        F.col(f"`{key}`").cast("long").alias("id"),
        F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") + 0.0).alias("vector"))
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    entries = clean.distinct().withColumn("n", first).where(F.col("n") <= k + 1).groupBy("vector").agg(
        F.collect_list("id").alias("ids"))
    shards = max(1, -(-rows.count() // shard_rows))
    entries = entries.select("ids", F.col("vector").cast(kind), F.size("vector").alias("dim"),
                             F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"))
    asked = usable(queries.where(F.col(f"`{key}`").isNotNull()), vector).select(
        F.col(f"`{key}`").cast("long").alias("query_id"),
        F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") + 0.0).alias("vector"))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = asked.withColumn("dim", F.size("vector")).withColumn(
        "block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    met = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    held = entries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    found = met.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
        _searcher(k, confidence), "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
