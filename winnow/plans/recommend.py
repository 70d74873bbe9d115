"""End-to-end recommendation for all users at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.operators import models
from winnow.operators.nearest import exact_top_k
from winnow.operators.ranking import rank_candidates, score_candidates, validate_requests, with_similarity, without_seen
from winnow.plans.feature_table import FeatureParts
from winnow.runtime import materialize


def retrieve(user_vectors: DataFrame, item_vectors: DataFrame, pool: int) -> DataFrame:
    """``(user_id, item_id, similarity, retrieval_rank)``; users without a vector get nothing."""
    found = exact_top_k(
        user_vectors.select(F.col("user_id").alias("query_id"), F.col("user_vec").alias("vec")),
        item_vectors.select("item_id", F.col("item_vec").alias("vec")), pool,
    )
    return found.select(
        F.col("query_id").alias("user_id"), "item_id", "similarity", F.col("rank").alias("retrieval_rank")
    )


def recommend(retrieved: DataFrame, parts: FeatureParts, k: int, *, score: Column | None = None,
              model=None, seen: DataFrame | None = None) -> DataFrame:
    """Re-ranks retrieved candidates by a score column or a fitted model.

    The similarity travels with the candidate through feature building, so the
    final merge is a projection instead of another join.
    """
    if seen is not None:
        retrieved = without_seen(retrieved, seen)
    keep = ["user_id", "item_id", "similarity", "retrieval_rank"]
    features = parts.matrix(retrieved, keep, serving=True)
    if model is not None:
        scored = models.predict(model, features, parts.columns).withColumnRenamed("prediction", "score")
    else:
        scored = score_candidates(features, score)
    return rank_candidates(scored, k, retrieval_rank="retrieval_rank").select(
        "user_id", "item_id", "score", "rank", "similarity"
    )


def merge_rankings(ranked: DataFrame, retrieved: DataFrame) -> DataFrame:
    """For rankings made elsewhere: attaches the retrieval similarity."""
    return with_similarity(ranked, retrieved)


def recommend_requests(requests: DataFrame, retrieved: DataFrame, parts: FeatureParts, *, max_k: int = 100,
                       score: Column | None = None, model=None) -> DataFrame:
    """Answers requests ``(user_id, k)``, each with its own ``k``.

    Status is ``rejected`` with a reason, ``unknown user`` for a user nothing was
    retrieved for, or ``answered`` with one row per item; a ``k`` above what was
    retrieved gives all of it.  Only users that ask are scored.
    """
    checked = materialize(validate_requests(requests, max_k).drop("valid"), "requests")
    asking = materialize(checked.where("reason is null").select("user_id").distinct(), "asking")
    best = recommend(retrieved.join(asking, "user_id", "left_semi"), parts, max_k, score=score, model=model)
    answers = materialize(best, "answers").withColumnRenamed("user_id", "a_user")
    fits = (F.col("user_id") == F.col("a_user")) & (F.col("rank") <= F.col("k")) & F.col("reason").isNull()
    status = F.when(F.col("reason").isNotNull(), "rejected").when(F.col("a_user").isNull(), "unknown user").otherwise("answered")
    return checked.join(answers, fits, "left").select(
        "user_id", "k", "reason", status.alias("status"), "item_id", "score", "rank", "similarity")
