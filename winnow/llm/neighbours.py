"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are projected to a few dimensions with Gaussian (2-stable) weights.  For two
vectors at distance D the squared projected distance is D^2 times a chi-square number
with as many degrees of freedom as dimensions.  A kd-tree over the projections hands out
leaves in rising projected distance; their vectors are verified with the exact measure.
The search ends when a vector nearer than the k-th found would, with probability
``confidence``, have shown itself at a smaller projected distance already.

Largest inner product becomes nearest distance by one more coordinate that brings every
vector to the length of the longest.  Vectors are spread over cells of bounded size by a
hash of their id.  A task builds the tree of a cell and then streams all queries past
it; the best of each cell are merged per query.  Equal vectors of a cell are one point
of the tree with the list of their ids, so copies cost nothing and ties are complete.

Defined cases: vectors that are null, zero, or hold null or non-finite components take
no part, nor do those whose length differs from the most frequent one; a row is known by
its vec_id, so rows that repeat id and vector count once and a query never returns its
own id; ties go to the smaller vec_id; fewer candidates than k give fewer rows; an empty
table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.operators.ranks import top_k
from winnow.runtime import materialize

DIMENSIONS = 8  # even, for the closed form of the distribution
CONFIDENCE = 0.95
CELL, LEAF = 65_536, 128
LEAST_CELL = 2_048
FOUND = "query_id long, vec_id long, score double"


def chi_square_quantile(p: float, degrees: int) -> float:
    """Where the distribution function with an even number of degrees reaches ``p``."""
    def cdf(x: float) -> float:
        return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(degrees // 2))

    low, high = 0.0, 1.0
    while cdf(high) < p:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if cdf(middle) < p else (low, middle)
    return high


class Tree:
    """kd-tree over the projections of one cell, with its vectors and ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, projection: np.ndarray, leaf: int = LEAF) -> None:
        vectors = np.ascontiguousarray(vectors + np.float32(0))  # no negative zeros
        whole = vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, of = np.unique(whole, return_index=True, return_inverse=True)
        order = np.lexsort((ids, of.ravel()))
        bounds = np.searchsorted(of.ravel()[order], np.arange(len(first) + 1))
        self.points = vectors[first].astype(np.float64)
        self.copies = [np.unique(ids[order[a:b]]) for a, b in zip(bounds[:-1], bounds[1:])]
        rest = np.sqrt(np.maximum(0, longest ** 2 - (self.points ** 2).sum(1)))
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int]] = []
        self.spans: list[tuple[int, int]] = []
        placed = np.arange(len(first))
        self.projected = np.concatenate([self.points, rest[:, None]], 1) @ projection
        self._build(placed, 0, len(placed), leaf)
        self.points, self.projected = self.points[placed], self.projected[placed]
        self.copies = [self.copies[i] for i in placed.tolist()]
        self.low_, self.high_ = np.array(self.low), np.array(self.high)

    def _build(self, placed: np.ndarray, a: int, b: int, leaf: int) -> int:
        own = self.projected[placed[a:b]]
        node = len(self.spans)
        self.low.append(own.min(0))
        self.high.append(own.max(0))
        self.spans.append((a, b))
        self.children.append((-1, -1))
        if b - a > leaf:
            axis = int((self.high[node] - self.low[node]).argmax())
            half = (b - a) // 2
            placed[a:b] = placed[a:b][np.argpartition(own[:, axis], half)]
            self.children[node] = (self._build(placed, a, a + half, leaf), self._build(placed, a + half, b, leaf))
        return node

    def nearest(self, own_id: int, query: np.ndarray, projected: np.ndarray, longest: float, k: int,
                quantile: float) -> list[tuple[float, int]]:
        """The best ``(score, id)`` found, ``k`` at most."""
        gap = np.maximum(np.maximum(self.low_ - projected, projected - self.high_), 0)
        bound = (gap * gap).sum(1).tolist()
        reach = float(query @ query) + longest ** 2
        heap = [(bound[0], 0)]
        score, place, worst = np.zeros(0), np.zeros(0, np.int64), -np.inf
        while heap:
            r2, node = heapq.heappop(heap)
            if len(score) > k and r2 >= quantile * max(0.0, reach - 2 * worst):
                break
            left, right = self.children[node]
            if left >= 0:
                heapq.heappush(heap, (bound[left], left))
                heapq.heappush(heap, (bound[right], right))
                continue
            a, b = self.spans[node]
            new = self.points[a:b] @ query
            good = np.flatnonzero(new >= worst) if len(score) > k else np.arange(b - a)
            if len(good):
                score, place = np.concatenate([score, new[good]]), np.concatenate([place, good + a])
                if len(score) > k:
                    # The query's own vector may be among them, so one more is kept; so are ties.
                    worst = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                    kept = score >= worst
                    score, place = score[kept], place[kept]
        exact = (self.points[place] * query).sum(1)
        found = [(-s, i) for s, p in zip(exact.tolist(), place.tolist()) for i in self.copies[p][:k + 1].tolist() if i != own_id]
        return [(-s, i) for s, i in sorted(found)[:k]]


def _search(k: int, longest: float, projection: np.ndarray, quantile: float):
    """Task: per cell its vectors, then all queries, as a stream."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cell, ids, parts, tree = None, [], [], None
        for batch in batches:
            cells, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            own = batch.column(2).to_numpy()
            vectors = batch.column(3).flatten().to_numpy().reshape(batch.num_rows, -1) if batch.num_rows else None
            cuts = np.flatnonzero((cells[1:] != cells[:-1]) | (roles[1:] != roles[:-1])) + 1
            out: list[tuple] = []
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                if a == b:
                    continue
                if roles[a] == 0:
                    if cells[a] != cell:
                        cell, ids, parts, tree = cells[a], [], [], None
                    ids.append(own[a:b])
                    parts.append(vectors[a:b])
                elif cells[a] == cell:
                    if tree is None:
                        tree = Tree(np.concatenate(ids), np.concatenate(parts), longest, projection)
                    queries = vectors[a:b].astype(np.float64)
                    near = queries @ projection[:-1]
                    for i, q, p in zip(own[a:b].tolist(), queries, near):
                        out += [(i, v, s) for s, v in tree.nearest(i, q, p, longest, k, quantile)]
            columns = list(zip(*out)) or [[]] * 3
            types = [pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["query_id", "vec_id", "score"])

    return run


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` of the vectors that take part."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad & some)
    size = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("embedding") == (size["size"] if size else 0))


def search(vectors: DataFrame, is_query: Column, k: int = 20, dimensions: int = DIMENSIONS,
           confidence: float = CONFIDENCE, cell: int = CELL, seed: int = 23) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query."""
    rows = materialize(usable(vectors).withColumn("asks", is_query), "vectors")
    norm = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    row = rows.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.max(norm)).alias("longest"), F.max(F.size("embedding")).alias("size")).first()
    n, longest, size = row["n"], row["longest"] or 0.0, row["size"] or 0
    cells = max(1, -(-n // cell), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // LEAST_CELL)))
    # Two-stable weights: the projection of a difference is as long as it is, on average.
    projection = np.random.default_rng(seed).normal(size=(size + 1, dimensions))
    stored = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(cells)).cast("int").alias("cell"), F.lit(0).alias("role"), "vec_id", "embedding")
    queries = rows.where("asks").dropDuplicates(["vec_id"])
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), F.lit(1).alias("role"), "vec_id", "embedding")
    dealt = stored.unionByName(asked).repartition(cells, "cell").sortWithinPartitions("cell", "role")
    found = dealt.mapInArrow(_search(k, longest, projection, chi_square_quantile(confidence, dimensions)), FOUND)
    best = top_k(found.dropDuplicates(["query_id", "vec_id"]), ["query_id"], [F.desc("score"), F.col("vec_id")], k)
    return best.select("query_id", "rank", "vec_id", "score")
