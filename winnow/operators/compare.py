"""Comparing models, runs and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.operators.metrics import evaluate_scores

# Metric name -> whether a larger value is better.
DIRECTIONS = {"ndcg_10": True, "ndcg_20": True, "rmse": False, "mae": False}
# Limits of the gap diagnosis.
GAP_LIMIT = 0.05
SMALL_GAP = 0.02
LOW_NDCG = 0.70


def compare_models(scored: DataFrame, models: Sequence[str], *, model: str = "model",
                   ties: Sequence[str] = ("item_id",)) -> DataFrame:
    """One row per metric: a column per model, the best one, its wins, last minus first.

    ``models`` fixes the order; earlier models win ties.
    """
    # Sums depend on row order in their last bits; equal models must compare equal.
    metrics = evaluate_scores(scored, group=[model], ties=ties).withColumns(
        {m: F.round(m, 12) for m in DIRECTIONS}
    )
    long = metrics.select(model, *DIRECTIONS).unpivot([model], list(DIRECTIONS), "metric", "value")
    wide = long.groupBy("metric").pivot(model, list(models)).agg(F.first("value"))
    better = F.col("metric").isin([m for m, up in DIRECTIONS.items() if up])
    values = [F.col(m) for m in models]
    target = F.when(better, F.greatest(*values)).otherwise(F.least(*values)) if len(models) > 1 else values[0]
    winner = F.coalesce(*[F.when(F.col(m) == target, F.lit(m)) for m in models])
    diff = values[-1] - values[0]
    gain = F.when(better, diff).otherwise(-diff)
    verdict = F.when(gain > 0, "better").when(gain < 0, "worse").otherwise("same")
    table = wide.select(
        "metric", *models, winner.alias("best_model"), diff.alias("diff"), verdict.alias("verdict")
    )
    wins = table.groupBy("best_model").agg(F.count(F.lit(1)).alias("wins"))
    return table.join(F.broadcast(wins), "best_model")  # at most four rows


def sweep_summary(runs: DataFrame, parameter: str, metrics: Sequence[str]) -> DataFrame:
    """Mean and deviation of the metrics of successful runs per parameter value."""
    good = runs.where(F.col("status") == "success")
    return good.groupBy(parameter).agg(
        F.count(F.lit(1)).alias("n_runs"),
        *[a for m in metrics for a in (F.avg(m).alias(f"mean_{m}"), F.stddev_samp(m).alias(f"std_{m}"))],
    )


def best_run(runs: DataFrame, metric: str, run: str = "run_id") -> DataFrame:
    """The successful run with the largest metric; the smaller id wins ties."""
    good = runs.where((F.col("status") == "success") & F.col(metric).isNotNull())
    return good.orderBy(F.desc(metric), F.asc(run)).limit(1)


def diagnose_fit(scored: DataFrame, *, split: str = "split", group: Sequence[str] = (),
                 ties: Sequence[str] = ("item_id",)) -> DataFrame:
    """Gap between train and validation quality and what to do about it."""
    m = evaluate_scores(scored, group=[*group, split], ties=ties)

    def of(name: str, metric: str):
        return F.max(F.when(F.col(split) == name, F.col(metric)))

    one = m.groupBy(*group).agg(
        of("train", "ndcg_10").alias("train_ndcg_10"), of("val", "ndcg_10").alias("val_ndcg_10"),
        of("train", "rmse").alias("train_rmse"), of("val", "rmse").alias("val_rmse"),
    )
    gap = F.col("ndcg_gap")
    action = F.when(gap > GAP_LIMIT, "REDUCE_COMPLEXITY").when(
        (gap < SMALL_GAP) & (F.col("val_ndcg_10") < LOW_NDCG), "INCREASE_COMPLEXITY"
    )
    return (
        one.withColumn("ndcg_gap", F.col("train_ndcg_10") - F.col("val_ndcg_10"))
        .withColumn("rmse_gap", F.col("val_rmse") - F.col("train_rmse"))
        .withColumn("action", F.coalesce(action, F.lit("NONE")))
    )


def split_gap(scored: DataFrame, first: str = "val", second: str = "test", *, split: str = "split",
              ties: Sequence[str] = ("item_id",)) -> DataFrame:
    """Difference of each metric between two splits."""
    long = evaluate_scores(scored, group=[split], ties=ties).select(split, *DIRECTIONS).unpivot(
        [split], list(DIRECTIONS), "metric", "value"
    )
    value = {s: F.max(F.when(F.col(split) == s, F.col("value"))) for s in (first, second)}
    return long.groupBy("metric").agg(value[first].alias(first), value[second].alias(second)).withColumn(
        "diff", F.col(second) - F.col(first)
    )
