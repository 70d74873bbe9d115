"""Exact and approximate vector top-k.

The kernel is a matrix product between a block of queries and a block of items
inside one task.  Blocks have a bounded number of rows, each emits at most k
rows per query, and the survivors are merged by a top-k per query.  Pairs are
never written out and neither side is broadcast.
"""

from __future__ import annotations

from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.hashing import seeded_key
from winnow.functions.vectors import norm
from winnow.operators.ranks import top_k
from winnow.runtime import materialize

BLOCK_ROWS = 131_072  # items of a block
QUERY_ROWS = 16_384  # queries of a block, each of which may give k rows back
MAX_BROADCAST_CELLS = 100_000
_CELLS = 1 << 21  # similarities held at once inside a task
_CHUNK = 16_384  # items compared at once
_FIRST, _LEAST = 32, 2_048  # items of the first chunk per hit asked for, and at least
_ORDERED = 1e15  # components below it have finite products in single precision
# Approximate search asks for a little more than 0.9 of the drawn queries' neighbours.
TARGET_RECALL = 0.93
SAMPLE_QUERIES, SAMPLE_PAIRS = 256, 25_600
# Tables, projections and bucket length, by growing work.
LSH_SETTINGS = ((10, 4, 1.0), (20, 4, 1.0), (20, 4, 1.5), (20, 4, 2.0), (20, 3, 2.0), (20, 2, 2.0))


def _nearness(q: np.ndarray, items: np.ndarray, metric: str) -> np.ndarray:
    """The similarity before it is rounded."""
    product = q @ items.T
    if metric == "ip":
        return product
    squares = (q * q).sum(axis=1)[:, None] + (items * items).sum(axis=1)[None, :]
    return -np.maximum(squares - 2 * product, 0.0)


def _similarity(q: np.ndarray, items: np.ndarray, metric: str) -> np.ndarray:
    return np.round(_nearness(q, items, metric), 6)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _strips(queries: pd.DataFrame, n_items: int):
    step = max(1, _CELLS // n_items)
    for at in range(0, len(queries), step):
        yield queries.iloc[at: at + step]


def _first(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n_rows: int, take: int):
    """The first ``take`` hits of every row, best first; equal similarities go to the smaller column."""
    order = np.lexsort((cols, -values, rows))
    rows, cols, values = rows[order], cols[order], values[order]
    start = np.searchsorted(rows, np.arange(n_rows))
    keep = np.arange(len(rows)) - start[rows] < take
    return rows[keep], cols[keep], values[keep]


def _strip_top_k(q: np.ndarray, matrix: np.ndarray, single: np.ndarray, take: int, metric: str):
    """Rows, columns and similarities of a strip's best items, one chunk of items after the other.

    Columns ascend with the item id, so once a row has ``take`` hits a later item counts
    only if it is better than the last of them.  That is settled for most items in single
    precision (``single`` is ``matrix``), with room for its error and for the rounding;
    what is left is computed in double precision.  The first chunk, all of which is computed
    in double precision and ordered, is short; the next ones grow with the items seen.
    """
    step = max(_CHUNK, 2 * take)
    first = min(max(_LEAST, _FIRST * take), step)
    s = _nearness(q, matrix[:first], metric)
    # Rounding keeps the order, so only what may be rounded up to the last hit is rounded.
    kth = np.round(np.partition(s, s.shape[1] - take, axis=1)[:, s.shape[1] - take], 6)
    rows, cols = np.divmod(np.flatnonzero(s >= (kth - 1e-6 - 1e-14 * np.abs(kth))[:, None]), s.shape[1])
    values = np.round(s[rows, cols], 6)
    good = values >= kth[rows]
    rows, cols, values = _first(rows[good], cols[good], values[good], len(q), take)
    more, held, at = [], 0, first
    if len(matrix) > first:
        q32 = q.astype(np.float32)
        longest = np.sqrt((matrix * matrix).sum(axis=1).max())
        error = 1e-6 * matrix.shape[1] * (np.sqrt((q * q).sum(axis=1)) + longest) ** 2
    while at < len(matrix):
        end = min(at + min(3 * at, step), len(matrix))
        s = _nearness(q32, single[at: end], metric)
        bound = (kth - 2e-6 - error - 1e-6 * np.abs(kth)).astype(np.float32)
        r, c = np.divmod(np.flatnonzero(s >= bound[:, None]), s.shape[1])
        c += at
        product = np.einsum("ij,ij->i", q[r], matrix[c])
        if metric != "ip":
            product = -np.maximum((q[r] ** 2).sum(axis=1) + (matrix[c] ** 2).sum(axis=1) - 2 * product, 0.0)
        v = np.round(product, 6)
        better = v > kth[r]
        more.append((r[better], c[better], v[better]))
        held += len(more[-1][0])
        at = end
        if held >= len(q) * take or at >= len(matrix):
            rows, cols, values = (np.concatenate(x) for x in zip((rows, cols, values), *more))
            rows, cols, values = _first(rows, cols, values, len(q), take)
            kth, more, held = values[take - 1:: take], [], 0
    return rows, cols, values


def _plain_strip_top_k(q: np.ndarray, matrix: np.ndarray, take: int, metric: str):
    """The same from the whole strip at once, for vectors without an order (NaN, overflow)."""
    s = _similarity(q, matrix, metric)
    kth = np.partition(s, len(matrix) - take, axis=1)[:, len(matrix) - take]
    rows, cols = np.nonzero(s >= kth[:, None])
    return _first(rows, cols, s[rows, cols], len(q), take)


def _block_top_k(queries: pd.DataFrame, items: pd.DataFrame, k: int, metric: str) -> pd.DataFrame:
    """Top-k of one block; equal similarities go to the smaller item id."""
    items = items.sort_values("item_id")
    ids, matrix = items["item_id"].to_numpy(), _matrix(items["vec"])
    del items
    take = min(k, len(ids))
    small = np.abs(matrix).max() < _ORDERED
    single = matrix.astype(np.float32) if small else None
    # Filled strip by strip; a strip has at most ``take`` hits per query.
    size = len(queries) * take
    query_id, item_id = np.empty(size, queries["query_id"].to_numpy().dtype), np.empty(size, ids.dtype)
    similarity, at = np.empty(size), 0
    for strip in _strips(queries, min(len(ids), max(_CHUNK, 2 * take))):
        q = _matrix(strip["vec"])
        if small and np.abs(q).max() < _ORDERED:
            parts = [(0, _strip_top_k(q, matrix, single, take, metric))]
        else:
            step = max(1, _CELLS // len(ids))
            parts = ((lo, _plain_strip_top_k(q[lo: lo + step], matrix, take, metric)) for lo in range(0, len(q), step))
        for lo, (rows, cols, values) in parts:
            end = at + len(rows)
            query_id[at: end] = strip["query_id"].to_numpy()[lo + rows]
            item_id[at: end], similarity[at: end] = ids[cols], values
            at = end
    return pd.DataFrame({"query_id": query_id[:at], "item_id": item_id[:at], "similarity": similarity[:at]}, copy=False)


def _blocks_per_cell(rows: DataFrame, name: str, block_rows: int, least: int) -> DataFrame:
    n = F.count(F.lit(1))
    wanted = F.greatest(F.ceil(n / block_rows), F.least(F.lit(least), F.ceil(n / 64)))
    return rows.groupBy("cell").agg(wanted.cast("int").alias(name))


def _block_grid(queries: DataFrame, items: DataFrame, block_rows: int, few_cells: bool, one_cell: bool = False):
    """Both sides keyed by (cell, query block, item block).

    Each query row is sent once per item block and the other way round, so the
    shuffle grows with ``rows x rows / block_rows`` and large blocks pay off.  A block
    of queries is smaller, since its hits are held as well as its vectors.

    A crowded cell is cut into more blocks on both sides, so the size of a
    group does not depend on how the vectors are distributed over cells.
    """
    # A single cell is cut into at least as many block pairs as the session works at once.
    least = ceil(sqrt(queries.sparkSession.sparkContext.defaultParallelism)) if one_cell else 1
    grid = _blocks_per_cell(queries, "nq", min(block_rows, QUERY_ROWS), least).join(
        _blocks_per_cell(items, "ni", block_rows, least), "cell"
    )
    if not few_cells:
        grid = materialize(grid)
        few_cells = grid.count() <= MAX_BROADCAST_CELLS
    if few_cells:
        grid = F.broadcast(grid)

    def own(key: str, n: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = queries.join(grid, "cell").select(
        "cell", own("query_id", "nq").alias("qb"), every("ni").alias("ib"), "query_id", "vec"
    )
    right = items.join(grid, "cell").select(
        "cell", own("item_id", "ni").alias("ib"), every("nq").alias("qb"), "item_id", "vec"
    )
    keys = ["cell", "qb", "ib"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))


def _search(queries: DataFrame, items: DataFrame, k: int, metric: str, block_rows: int,
            overlapping: bool = False, one_cell: bool = False) -> DataFrame:
    """Top-k over cells; cells that do not overlap are one or one per inverted list."""

    def kernel(q: pd.DataFrame, i: pd.DataFrame) -> pd.DataFrame:
        if q.empty or i.empty:
            return pd.DataFrame({"query_id": [], "item_id": [], "similarity": []})
        return _block_top_k(q, i, k, metric)

    schema = (
        f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
        f"item_id {items.schema['item_id'].dataType.simpleString()}, similarity double"
    )
    found = _block_grid(queries, items, block_rows, not overlapping, one_cell).applyInPandas(kernel, schema)
    if overlapping:  # an item can share several buckets with a query
        found = found.distinct()
    best = top_k(found, ["query_id"], [F.desc("similarity"), F.asc("item_id")], k)
    if metric == "l2":
        best = best.withColumn("similarity", F.abs("similarity"))
    return best


def _empty(queries: DataFrame, items: DataFrame) -> DataFrame:
    return queries.sparkSession.createDataFrame(
        [], f"query_id {queries.schema['query_id'].dataType.simpleString()}, "
        f"item_id {items.schema['item_id'].dataType.simpleString()}, similarity double, rank int"
    )


def exact_top_k(queries: DataFrame, items: DataFrame, k: int, metric: str = "ip",
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(query_id, item_id, similarity, rank)`` from all items.

    ``queries`` is ``(query_id, vec)``, ``items`` is ``(item_id, vec)``.  With
    ``metric="l2"`` the similarity column is the squared distance, smallest
    first.  ``k`` beyond the catalogue returns the whole catalogue, ``k <= 0``
    nothing.
    """
    if metric not in ("ip", "l2"):
        raise ValueError(f"unknown metric {metric!r}")
    if k <= 0:
        return _empty(queries, items)
    cell = F.lit(0).alias("cell")
    return _search(
        queries.select(cell, "query_id", "vec"), items.select(cell, "item_id", "vec"), k, metric, block_rows,
        one_cell=True,
    )


def _neighbour_pairs(queries: DataFrame, items: DataFrame, k: int, block_rows: int, seed: int = 7) -> pd.DataFrame:
    """Drawn queries ``q``, one row per exact neighbour, with the columns of ``items``.

    A neighbour that an index lets a query see is among the best k of what it sees, so
    the share of seen neighbours is the recall.
    """
    n = min(SAMPLE_QUERIES, max(16, SAMPLE_PAIRS // k))
    drawn = materialize(queries.orderBy(seeded_key(seed, "query_id"), "query_id").limit(n).select("query_id", "vec"), "drawn")
    best = exact_top_k(drawn, items.select("item_id", "vec"), k, block_rows=block_rows).select("query_id", "item_id")
    return best.join(drawn.withColumnRenamed("vec", "q"), "query_id").join(items, "item_id").toPandas()


def _filled(found: DataFrame, queries: DataFrame, items: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Queries that were given fewer than k items, though there are more, are searched exactly."""
    found = materialize(found, "found")
    n = min(k, items.count())
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= n).select("query_id")
    rest = exact_top_k(queries.join(full, "query_id", "left_anti"), items.select("item_id", "vec"), k, block_rows=block_rows)
    return found.join(full, "query_id", "left_semi").unionByName(rest)


class InvertedLists:
    """Items grouped by nearest k-means centre; a query visits its nearest lists.

    Unless ``n_probe`` is given, as many are visited as find ``TARGET_RECALL`` of the
    exact neighbours of a bounded draw of the queries.
    """

    def __init__(self, items: DataFrame, n_lists: int = 100, seed: int = 7, max_iter: int = 10):
        features = items.withColumn("features", array_to_vector("vec"))
        self.model = KMeans(k=n_lists, seed=seed, maxIter=max_iter, predictionCol="cell").fit(features)
        self.centers = np.array(self.model.clusterCenters())  # n_lists x dim
        # Stored once, like any index: every search reads it again.
        self.items = materialize(self.model.transform(features).select("cell", "item_id", "vec"))

    def probes(self, queries: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> int:
        """The least number of lists that gives the recall asked for."""
        pairs = _neighbour_pairs(queries, self.items, k, block_rows)
        if pairs.empty:
            return 1
        order = np.argsort(-_similarity(_matrix(pairs["q"]), self.centers, "l2"), axis=1, kind="stable")
        place = np.sort((order == pairs["cell"].to_numpy()[:, None]).argmax(axis=1))
        return int(place[ceil(TARGET_RECALL * len(place)) - 1]) + 1

    def search(self, queries: DataFrame, k: int, n_probe: int | None = None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
        if k <= 0:
            return _empty(queries, self.items)
        centers = self.centers
        n_probe = min(self.probes(queries, k, block_rows) if n_probe is None else n_probe, len(centers))

        @F.pandas_udf("array<int>")
        def nearest_lists(vec: pd.Series) -> pd.Series:
            distance = -_similarity(_matrix(vec), centers, "l2")
            return pd.Series(list(np.argsort(distance, axis=1, kind="stable")[:, :n_probe]))

        routed = queries.select(F.explode(nearest_lists("vec")).alias("cell"), "query_id", "vec")
        return _filled(_search(routed, self.items, k, "ip", block_rows), queries, self.items, k, block_rows)


def _cell_keys(matrix: np.ndarray, tables: int, projections: int, bucket_length: float, seed: int) -> np.ndarray:
    """``rows x tables`` keys of cells."""
    rng = np.random.default_rng(seed)
    weights = rng.normal(size=(matrix.shape[1], tables * projections))
    shift = rng.uniform(0, bucket_length, tables * projections)
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = matrix / np.where(length > 0, length, 1)
    buckets = np.floor((unit @ weights + shift) / bucket_length).astype(np.int64).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, tables + 1, dtype=np.uint64), (len(matrix), tables)) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(projections):
        key = (key ^ buckets[:, i::projections]) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def projection_cells(df: DataFrame, tables: int, projections: int, bucket_length: float, seed: int) -> DataFrame:
    """Adds ``cell``: one row per vector and table.

    A table's cell joins the buckets of several random projections of the vector
    scaled to length one, so vectors have to agree in all of them to meet.
    """

    @F.pandas_udf("array<long>")
    def cells(vec: pd.Series) -> pd.Series:
        return pd.Series(list(_cell_keys(_matrix(vec), tables, projections, bucket_length, seed)))

    return df.withColumn("cell", F.explode(cells("vec")))


def lsh_settings(queries: DataFrame, items: DataFrame, k: int, seed: int = 7,
                 block_rows: int = BLOCK_ROWS) -> tuple[int, int, float] | None:
    """The first of ``LSH_SETTINGS`` that gives the recall asked for on drawn queries; None if none does."""
    pairs = _neighbour_pairs(queries, items, k, block_rows)
    if pairs.empty:
        return LSH_SETTINGS[0]
    q, i = _matrix(pairs["q"]), _matrix(pairs["vec"])
    for settings in LSH_SETTINGS:
        if (_cell_keys(q, *settings, seed) == _cell_keys(i, *settings, seed)).any(axis=1).mean() >= TARGET_RECALL:
            return settings
    return None


def lsh_top_k(queries: DataFrame, items: DataFrame, k: int, *, bucket_length: float | None = None, projections: int | None = None,
              tables: int | None = None, seed: int = 7, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Top-k among items that share the cell of a table with the query.

    Projections of unit vectors have standard deviation one, whatever the dimension.
    With 10 tables of 4 projections and buckets of length 1, two vectors at distance 0.5
    meet with probability 0.77, at 0.8 with 0.32, and about one pair in fourteen of
    unrelated ones does.  Unless one of the three is given, they are chosen by measured
    recall (``lsh_settings``); where no choice reaches it, the search is exact, as it is
    for queries that meet fewer than k items.  For unit vectors the order by distance is
    the order by inner product.
    """
    if k <= 0:
        return _empty(queries, items)
    if tables is projections is bucket_length is None:
        chosen = lsh_settings(queries, items, k, seed, block_rows)
        if chosen is None:
            return exact_top_k(queries, items, k, block_rows=block_rows)
    else:
        chosen = tuple(d if x is None else x for x, d in zip((tables, projections, bucket_length), LSH_SETTINGS[0]))
    left = projection_cells(queries, *chosen, seed).select("cell", "query_id", "vec")
    right = projection_cells(items, *chosen, seed).select("cell", "item_id", "vec")
    return _filled(_search(left, right, k, "ip", block_rows, overlapping=True), queries, items, k, block_rows)


def overlap(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact top-k that the other result also found, over all queries."""
    hit = approximate.select("query_id", "item_id", F.lit(1).alias("__hit"))
    return exact.join(hit, ["query_id", "item_id"], "left").agg(
        F.count(F.lit(1)).alias("n_exact"), F.count("__hit").alias("n_found"),
        F.try_divide(F.count("__hit").cast("double"), F.count(F.lit(1))).alias("overlap"),
    )


def similarity_moments(queries: DataFrame, items: DataFrame, sample: int = 1000, seed: int = 7,
                       block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean, population deviation, min and max over the pairs of two samples.

    ``sample`` rows per side are drawn by seeded hash.
    """

    def drawn(df: DataFrame, key: str) -> DataFrame:
        return df.orderBy(seeded_key(seed, key), key).limit(sample).select(F.lit(0).alias("cell"), key, "vec")

    def kernel(q: pd.DataFrame, i: pd.DataFrame) -> pd.DataFrame:
        if q.empty or i.empty:
            return pd.DataFrame({"n": [], "mean": [], "m2": [], "lo": [], "hi": []})
        matrix, parts = _matrix(i["vec"]), []
        for strip in _strips(q, len(matrix)):
            s = _matrix(strip["vec"]) @ matrix.T
            parts.append((s.size, s.mean(), s.var() * s.size, s.min(), s.max()))
        return pd.DataFrame(parts, columns=["n", "mean", "m2", "lo", "hi"])

    grid = _block_grid(drawn(queries, "query_id"), drawn(items, "item_id"), block_rows, few_cells=True)
    parts = grid.applyInPandas(
        kernel, "n long, mean double, m2 double, lo double, hi double"
    )
    n, weighted = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    raw = F.sum(F.col("m2") + F.col("n") * F.col("mean") * F.col("mean"))
    return parts.agg(
        n.alias("n_pairs"), (weighted / n).alias("mean"),
        F.sqrt(F.greatest(raw / n - (weighted / n) * (weighted / n), F.lit(0.0))).alias("std"),
        F.min("lo").alias("min"), F.max("hi").alias("max"),
    )


def dimension_variance(vectors: DataFrame, vec: str = "vec") -> DataFrame:
    """Population variance of every dimension."""
    return vectors.select(F.posexplode(vec).alias("dim", "x")).groupBy("dim").agg(
        F.var_pop(F.col("x").cast("double")).alias("variance")
    )


def embedding_stats(vectors: DataFrame, vec: str = "vec") -> DataFrame:
    """Norms, values and spread of the dimensions of one set of vectors."""
    norms = vectors.agg(
        F.count(F.lit(1)).alias("n_vectors"), F.avg(norm(F.col(vec))).alias("norm_mean"),
        F.stddev_pop(norm(F.col(vec))).alias("norm_std"),
    )
    values = vectors.select(F.explode(vec).alias("x")).agg(
        F.avg(F.col("x").cast("double")).alias("value_mean"),
        F.stddev_pop(F.col("x").cast("double")).alias("value_std"),
    )
    spread = dimension_variance(vectors, vec).agg(
        F.avg("variance").alias("dim_var_mean"), F.min("variance").alias("dim_var_min"),
        F.max("variance").alias("dim_var_max"),
    )
    # Three one-row tables.
    return norms.join(F.broadcast(values)).join(F.broadcast(spread))
