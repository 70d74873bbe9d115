"""Connected components of a graph given as edges.

Tasks first reduce their own edges to a spanning forest by union-find, and fewer tasks reduce
the forests of several, so that few rounds are left.  What remains is
joined by rounds of star contraction: every node points its larger neighbours at
its smallest one, then its smaller ones, until each component is one star around its
smallest node.  Edges stay distributed throughout; each half round is one aggregate and
one join, both written to shared storage, and the round before is deleted.

Defined cases: loops are ignored, repeated edges count once, no edges give no rows;
a node with any number of neighbours is fine, since only its minimum is aggregated and
the join side it meets is stored, so that adaptive execution can split the hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.runtime import materialize, release

EDGES = "u long, v long"
TASK_EDGES = 2_000_000
# Edges per task of the second reduction.
FOREST_EDGES = 200_000


def find_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the smallest node of each one's component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = np.arange(len(nodes))
    a, b = at[:len(u)], at[len(u):]
    while len(a):
        # Hook each larger root to the smallest root it meets, then flatten.
        ra, rb = root[a], root[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        open_ = low != high
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:
            flat = root[root]
            if np.array_equal(flat, root):
                break
            root = flat
    return nodes, nodes[root]


def _forest(batches: Iterator) -> Iterator:
    import pyarrow as pa

    def reduced(us: list, vs: list) -> pa.RecordBatch:
        nodes, roots = find_roots(np.concatenate(us), np.concatenate(vs))
        own = nodes != roots
        return pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(roots[own])], names=["u", "v"])

    us, vs, held = [], [], 0
    for batch in batches:
        us.append(batch.column(0).to_numpy())
        vs.append(batch.column(1).to_numpy())
        held += batch.num_rows
        if held > TASK_EDGES:
            yield reduced(us, vs)
            us, vs, held = [], [], 0
    if held:
        yield reduced(us, vs)


def local_forest(edges: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` with u > v that connect the same nodes, at most one per node and task."""
    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(_forest, EDGES)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges; the root is its component's smallest node."""
    forest = materialize(local_forest(edges.where("u is not null and v is not null and u <> v")), "forest")
    tasks = max(2, -(-forest.count() // FOREST_EDGES))
    current = materialize(local_forest(forest.coalesce(tasks)).distinct(), "stars")
    release(forest)
    while not _is_stars(current):
        current = _half(_half(current, large=True), large=False)
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _is_stars(current: DataFrame) -> bool:
    """Whether every larger node has one edge and no smaller node is a larger one as well."""
    row = current.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("nodes")).first()
    return row["n"] == row["nodes"] and current.select("v").join(current.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def _half(current: DataFrame, large: bool) -> DataFrame:
    """Points the larger (or the smaller) neighbours of each node at its smallest one."""
    both = current.select("u", "v")
    if large:
        both = both.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    joined = both.join(least, "u")
    if large:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    out = materialize(new.where("u <> v").distinct(), "stars")
    release(least, current)
    return out
