"""Mixing sources to target weights by repeating documents.

Words per source are summed, a repetition rate ``target / size`` follows for each
source, and every document is emitted ``floor(rate)`` times plus one more time with
the fraction as probability.  The draw is a hash of the document id, so a rerun or a
repeated task decides alike.  Only DataFrame functions are used.

Defined cases: a null or empty text has size 0 and stays as a row with nothing taken;
a null source is a source of its own, last in order; repeated rows are drawn alike;
an empty table gives an empty result.  Columns of the input never clash with the
internal ones, which are kept in structs apart from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.operators.ranks import global_rank
from winnow.runtime import materialize

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    The weights repeat along the sources in code-point order.  Targets share
    ``share`` of all sizes by weight and stop at ``cap`` times a source's size; what
    that leaves over goes to the others by weight until none is above its cap.
    """
    summed = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    summed = summed.withColumn("last", F.col("source").isNull())
    ranked = global_rank(summed, ["last", "source"], "place")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = materialize(ranked.select(
        "source", "source_size",
        F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")).alias("weight"),
    ), "sources")
    level = _level(weighed, share, cap)
    return weighed.select("source", "source_size",
                          F.least(F.col("weight") * level, F.col("source_size") * cap).alias("target"))


def _level(weighed: DataFrame, share: float, cap: float) -> float:
    """Target per unit of weight among the sources that stay below their caps.

    It only grows from step to step, and each step puts one more source at its cap
    or ends.  A step is one aggregate row over the small table of sources.
    """
    level = -1.0
    while True:
        capped = F.col("source_size") * cap <= F.col("weight") * level
        row = weighed.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(capped, F.col("source_size") * cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["open"] == 0:
            return level
        new = (row["total"] * share - row["held"]) / row["open"]
        if new <= level:
            return level
        level = new


def unit_hash(seed: int, *columns: Column | str) -> Column:
    """A number in [0, 1) from a hash of the columns."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return bits.cast("double") / float(1 << 53)


def copies(rate: Column, seed: int, *key: Column | str) -> Column:
    whole = F.floor(rate)
    return (whole + (unit_hash(seed, *key) < rate - whole).cast("int")).cast("int")


def mixed(sized: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """``(doc_id, source, size)`` with source_size, target and the number of copies."""
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (
        sized.join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("copies", copies(rate, seed, "doc_id"))
        .drop("t_source")
    )


def repeat_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                     cap: float = 2.0, seed: int = 17) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    targets = source_targets(docs.select("source", word_count("text").alias("size")), weights, share, cap)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("source"), F.col("doc_id"),
                         F.lit(0).cast("long").alias("size"))
    taken = mixed(packed, targets, seed).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")
