"""Positions in a global order and top-k per key without single-task sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from winnow.runtime import materialize

_LOW_BITS = 33


def global_rank(df: DataFrame, keys: Sequence[str], name: str = "idx") -> DataFrame:
    """Adds the 0-based position in the order of ``keys`` (a unique key list).

    Rows are range-partitioned and sorted once, written to reliable storage
    with a partition-local counter, and shifted by the sizes of the partitions
    before.  A hot leading key is split because the ranges use all keys.
    """
    tagged = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__m", F.monotonically_increasing_id())
    )
    part = F.shiftright("__m", _LOW_BITS)
    # One row per partition, so the ordered window below is tiny.
    sizes = tagged.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    local = F.col("__m").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    return (
        tagged.withColumn("__p", part)
        .join(F.broadcast(offsets), "__p")
        .withColumn(name, (F.col("__o") + local).cast("long"))
        .drop("__p", "__m", "__o")
    )


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
          rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key with their 1-based rank.

    The rank filter sits directly on the window, so Spark cuts every map task
    to ``k`` rows per key before the shuffle, hot keys included.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)
