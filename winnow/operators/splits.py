"""Time-ordered splits and what they share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.operators.order_stats import after, at_or_before, rows_at
from winnow.runtime import materialize

# Fixed values
SPLITS = ("train", "val", "test")


def time_split(df: DataFrame, order_keys: Sequence[str], train_ratio: float = 0.8,
               val_ratio: float = 0.1) -> DataFrame:
    """Adds ``split``: the first share of rows in time is train, then val, then test.

    ``order_keys`` are unique together and never null.  Only the two boundary
    rows are looked up; no row is sorted or shuffled.  The result stacks three
    range filters with a constant label, so a later filter on ``split`` drops
    the other branches and its range reaches the scan.
    """
    train_end, val_end = rows_at(df, order_keys, (train_ratio, train_ratio + val_ratio))
    train = df.where(at_or_before(train_end)) if train_end else df.where(F.lit(False))
    val = df.where(at_or_before(val_end)) if val_end else df.where(F.lit(False))
    val = val.where(after(train_end)) if train_end else val
    test = df.where(after(val_end)) if val_end else df
    labelled = [part.withColumn("split", F.lit(name)) for part, name in zip((train, val, test), SPLITS)]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


def minimum_history(split: DataFrame, min_rows: int = 5, user: str = "user_id") -> DataFrame:
    """Keeps val/test rows only of users with enough train rows.

    The qualified users are stored, so that the join shuffles both sides and a hot
    user's rows can be split.
    """
    qualified = materialize(
        split.where(F.col("split") == "train")
        .groupBy(user)
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") >= min_rows)
        .select(user)
    )
    train = split.where(F.col("split") == "train")
    rest = split.where(F.col("split") != "train").join(qualified, user, "left_semi")
    return train.unionByName(rest)


def retained_share(split: DataFrame, filtered: DataFrame) -> DataFrame:
    """Rows before and after the history filter per split."""
    before = split.groupBy("split").agg(F.count(F.lit(1)).alias("rows_before"))
    after = filtered.groupBy("split").agg(F.count(F.lit(1)).alias("rows_after"))
    kept = F.coalesce("rows_after", F.lit(0))
    return before.join(after, "split", "left").select(
        "split",
        "rows_before",
        kept.alias("rows_after"),
        F.round(kept * 100.0 / F.col("rows_before"), 6).alias("retained_pct"),
    )


def split_summary(split: DataFrame, ts: str = "ts", user: str = "user_id",
                  item: str = "item_id") -> DataFrame:
    """Rows and time range per split, with entities that train has never seen."""

    def unseen(entity: str, name: str) -> DataFrame:
        # One row per entity and split first; then the flags of all splits meet.
        seen = (
            split.groupBy(entity)
            .agg(*[F.max((F.col("split") == s).cast("int")).alias(s) for s in SPLITS])
            .agg(*[F.sum(F.when(F.col("train") == 0, F.col(s)).otherwise(0)).alias(s) for s in SPLITS],
                 *[F.sum(s).alias(f"all_{s}") for s in SPLITS])
        )
        pairs = ", ".join(f"'{s}', {s}, all_{s}" for s in SPLITS)
        return seen.selectExpr(f"stack({len(SPLITS)}, {pairs}) as (split, new_{name}s, n_{name}s)")

    ranges = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    return (
        ranges.join(F.broadcast(unseen(user, "user")), "split")
        .join(F.broadcast(unseen(item, "item")), "split")
    )
