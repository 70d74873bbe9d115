"""Hash-seeded draws of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm.mixing import unit_hash

MOST_CLASSES = 1_000


def remainder(column: str, modulus: int) -> Column:
    """CRC-32 of the column as text, modulo ``modulus``; null counts as the empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def bounded_sample(rows: DataFrame, by: str, each: int, seed: int = 5) -> DataFrame:
    """About ``each`` rows of every value of ``by`` (all of them where there are fewer).

    Rows are drawn by a hash of ``doc_id`` against a rate that follows from the counts,
    so the size is bounded whatever the input holds and no row needs to be ranked.
    """
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).limit(MOST_CLASSES + 1).collect()
    if len(counts) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} values of {by}")
    if not counts:
        return rows
    rates = F.create_map(*[F.lit(x) for r in counts for x in (r[by], min(1.0, each / r["n"]))])
    return rows.where(unit_hash(seed, "doc_id") < rates[F.col(by)])
