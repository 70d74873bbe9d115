"""Ranking, retrieval and regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions.binning import left_closed_index, right_closed
from winnow.operators.order_stats import counted_percentiles
from winnow.operators.ranks import top_k

# Fixed values
ERROR_EDGES = (-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0)
ACTIVITY_EDGES = (5, 10, 20, 50)
ACTIVITY_LABELS = ("1-5", "6-10", "11-20", "21-50", "50+")


def ndcg_per_user(scored: DataFrame, ks: Sequence[int] = (10,), *, group: Sequence[str] = (),
                  user: str = "user_id", rating: str = "rating", prediction: str = "prediction",
                  ties: Sequence[str] = ("item_id",)) -> DataFrame:
    """NDCG@k per user with linear gains; users with one row or no gain drop out.

    Only the list by prediction needs rows: the one by rating is known from the number of rows
    per rating, and these are merged before the shuffle.  Both lists are cut to the largest k
    before they are shuffled by user.  A user with a third of all rows therefore costs no more
    than any other.
    """
    keep, keys = max(2, *ks), [*group, user]
    rows = scored.select(*keys, *ties, F.col(rating).cast("double").alias("gain"), F.col(prediction).cast("double").alias("by"))
    top = top_k(rows, keys, [F.desc("by"), *[F.asc(t) for t in ties]], keep)
    dcg = top.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(F.when(F.col("rank") <= k, F.col("gain") / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias(f"__dcg_{k}") for k in ks],
    )
    # At most `keep` ratings per user and `keep` rows of each; summed in order of rank like the other list.
    per_rating = rows.groupBy(*keys, "gain").agg(F.least(F.count(F.lit(1)), F.lit(keep)).cast("int").alias("n"))
    runs = top_k(per_rating, keys, [F.desc("gain")], keep).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("rank", "gain", "n"))).alias("runs"))
    listed = F.flatten(F.transform("runs", lambda r: F.array_repeat(r["gain"], r["n"])))

    def ideal(k: int) -> Column:
        terms = F.transform(F.slice("gains", 1, k), lambda g, i: F.coalesce(g / F.log2(i + 2), F.lit(0.0)))
        return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)

    idcg = runs.select(*keys, listed.alias("gains")).select(*keys, *[ideal(k).alias(f"__idcg_{k}") for k in ks])
    # Stacked and not joined, since keys may be null.
    sums = dcg.unionByName(idcg, allowMissingColumns=True).groupBy(*keys).agg(
        F.max("__rows").alias("__rows"), *[F.max(f"__{name}_{k}").alias(f"__{name}_{k}") for name in ("dcg", "idcg") for k in ks])
    usable = F.col("__rows") >= 2
    for k in ks:
        usable = usable & (F.col(f"__idcg_{k}") > 0)
    return sums.where(usable).select(
        *keys, *[(F.col(f"__dcg_{k}") / F.col(f"__idcg_{k}")).alias(f"ndcg_{k}") for k in ks]
    )


def evaluate_scores(scored: DataFrame, *, group: Sequence[str] = (), rating: str = "rating",
                    prediction: str = "prediction", ties: Sequence[str] = ("item_id",)) -> DataFrame:
    """RMSE, MAE, NDCG@10 and NDCG@20 per group (or one row)."""
    error = F.col(prediction) - F.col(rating)
    errors = scored.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )
    ndcg = (
        ndcg_per_user(scored, (10, 20), group=group, rating=rating, prediction=prediction, ties=ties)
        .groupBy(*group)
        .agg(F.avg("ndcg_10").alias("ndcg_10"), F.avg("ndcg_20").alias("ndcg_20"))
    )
    joined = errors.join(ndcg, list(group), "left") if group else errors.join(F.broadcast(ndcg), how="left")
    return joined.fillna(0.0, subset=["ndcg_10", "ndcg_20"])


def regression_metrics(scored: DataFrame, rating: str = "rating",
                       prediction: str = "prediction") -> DataFrame:
    error = F.col(prediction) - F.col(rating)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def error_summary(scored: DataFrame, rating: str = "rating",
                  prediction: str = "prediction") -> DataFrame:
    error = F.col(prediction) - F.col(rating)
    return scored.agg(
        F.avg(error).alias("mean_error"),
        F.stddev_pop(error).alias("std_error"),
        F.avg(F.abs(error)).alias("mae"),
        F.min(error).alias("min_error"),
        F.max(error).alias("max_error"),
    )


def error_buckets(scored: DataFrame, rating: str = "rating",
                  prediction: str = "prediction") -> DataFrame:
    """Rows per left-closed error range; empty ranges stay with 0."""
    names = ["< -2", *[f"[{a:g}, {b:g})" for a, b in zip(ERROR_EDGES, ERROR_EDGES[1:])], ">= 2"]
    bucket = left_closed_index(F.col(prediction) - F.col(rating), ERROR_EDGES)
    # One conditional count per range: empty ranges need no join.
    counts = scored.select(bucket.alias("b")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("b") == i).alias(f"c{i}") for i in range(len(names))],
    )
    pairs = ", ".join(f"{i}, '{n}', c{i}" for i, n in enumerate(names))
    return counts.selectExpr(
        "total", f"stack({len(names)}, {pairs}) as (bucket, error_range, n_rows)"
    ).select(
        "bucket", "error_range", "n_rows",
        (F.col("n_rows") * 100.0 / F.nullif("total", F.lit(0))).alias("pct"),
    )


def error_by_rating(scored: DataFrame, rating: str = "rating",
                    prediction: str = "prediction") -> DataFrame:
    error = F.col(prediction) - F.col(rating)
    return scored.groupBy(rating).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(error).alias("mean_error"),
        F.avg(F.abs(error)).alias("mean_abs_error"),
        F.stddev_samp(F.abs(error)).alias("std_abs_error"),
    )


def value_distribution(per_user: DataFrame, value: str, probs: Sequence[float]) -> DataFrame:
    """Mean, median, deviation, range and percentiles of a metric in [0, 1]."""
    rounded = per_user.select(F.round(value, 6).alias("v"))
    moments = rounded.agg(
        F.count("v").alias("n_users"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    spread = counted_percentiles(rounded, "v", [0.5, *probs])
    names = [f"p{round(p * 100):02d}" for p in probs]
    return moments.join(F.broadcast(spread)).select(
        "n_users", "mean", F.get("quantiles", F.lit(0)).alias("median"), "std", "min", "max",
        *[F.get("quantiles", F.lit(i + 1)).alias(n) for i, n in enumerate(names)],
    )


def recall_per_user(retrieved: DataFrame, positives: DataFrame, ks: Sequence[int], *,
                    user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Share of a user's distinct positives among the first k retrieved items.

    ``retrieved`` has ``(user, item, rank)``.  The join is on user and item
    together, so an active user or popular item is spread over all tasks.
    """
    wanted = positives.select(user, item).distinct()
    hits = wanted.join(retrieved.select(user, item, "rank"), [user, item], "left")
    return recall_from_ranks(hits, ks, user=user)


def recall_from_ranks(hits: DataFrame, ks: Sequence[int], *, user: str = "user_id") -> DataFrame:
    """Recall per user when each distinct positive already carries its rank or null."""
    found = [(F.count_if(F.col("rank") <= k) / F.count(F.lit(1))).alias(f"recall_{k}") for k in ks]
    return hits.groupBy(user).agg(F.count(F.lit(1)).alias("n_positives"), *found)


def mean_recall(per_user: DataFrame, ks: Sequence[int]) -> DataFrame:
    return per_user.agg(
        F.count(F.lit(1)).alias("n_users"), *[F.avg(f"recall_{k}").alias(f"recall_{k}") for k in ks]
    )


def popularity(positives: DataFrame, n: int, item: str = "item_id") -> DataFrame:
    """The ``n`` items with most positives and their rank."""
    head = (
        positives.groupBy(item).agg(F.count(F.lit(1)).alias("n_positives"))
        .orderBy(F.desc("n_positives"), F.asc(item)).limit(n)
    )
    return top_k(head.withColumn("__all", F.lit(1)), ["__all"],
                 [F.desc("n_positives"), F.asc(item)], n).drop("__all")


def popularity_recall(train_positives: DataFrame, positives: DataFrame, ks: Sequence[int], *,
                      user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Recall when everyone gets the same most popular items (at most max(ks) rows)."""
    best = popularity(train_positives, max(ks), item).select(item, "rank")
    hits = positives.select(user, item).distinct().join(F.broadcast(best), item, "left")
    return recall_from_ranks(hits, ks, user=user)


def recall_by_activity(per_user: DataFrame, k: int) -> DataFrame:
    label = right_closed(F.col("n_positives"), ACTIVITY_EDGES, ACTIVITY_LABELS)
    return per_user.groupBy(label.alias("activity")).agg(
        F.count(F.lit(1)).alias("n_users"), F.avg(f"recall_{k}").alias(f"recall_{k}")
    )


def lift(recalls: dict[str, DataFrame], ks: Sequence[int], against: str) -> DataFrame:
    """One row per k: mean recall of each recommender and lift of the first one in %."""
    first = next(iter(recalls))
    out = None
    for name, one_row in recalls.items():
        long = one_row.unpivot([], [f"recall_{k}" for k in ks], "metric", name)
        out = long if out is None else out.join(F.broadcast(long), "metric")  # len(ks) rows
    ratio = F.try_divide(F.col(first), F.nullif(F.col(against), F.lit(0.0)))
    return out.withColumn("lift_pct", (ratio - 1) * 100)
