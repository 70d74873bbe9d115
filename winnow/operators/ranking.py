"""Ordering candidates by a score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.operators.ranks import top_k


def score_candidates(candidates: DataFrame, score: Column) -> DataFrame:
    """Adds the score and leaves the rows as they are."""
    return candidates.withColumn("score", score)


def rank_candidates(scored: DataFrame, k: int, *, user: str = "user_id", item: str = "item_id",
                    retrieval_rank: str | None = None) -> DataFrame:
    """First ``k`` candidates per user by score; equal scores keep retrieval order."""
    tie = retrieval_rank or item
    return top_k(scored, [user], [F.desc("score"), F.asc(tie)], k)


def with_similarity(ranked: DataFrame, retrieved: DataFrame, *, user: str = "user_id",
                    item: str = "item_id") -> DataFrame:
    """Adds the retrieval similarity; items that were not retrieved get 0."""
    sims = retrieved.select(user, item, F.col("similarity").alias("__s"))
    return ranked.join(sims, [user, item], "left").withColumn(
        "similarity", F.coalesce("__s", F.lit(0.0))
    ).drop("__s")


def without_seen(candidates: DataFrame, seen: DataFrame, *, user: str = "user_id",
                 item: str = "item_id") -> DataFrame:
    return candidates.join(seen.select(user, item).distinct(), [user, item], "left_anti")


def validate_requests(requests: DataFrame, max_k: int = 100) -> DataFrame:
    """Marks requests as valid or gives the reason for rejecting them."""
    reason = (
        F.when(F.col("user_id").isNull() | (F.col("user_id") <= 0), "user_id must be positive")
        .when(F.col("k").isNull() | (F.col("k") <= 0), "k must be positive")
        .when(F.col("k") > max_k, f"k must be at most {max_k}")
    )
    return requests.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())
