"""From raw tables to the feature matrix of all splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.operators import features as f


@dataclass
class FeatureParts:
    """Everything learnt from train rows, shared by all splits and by serving.

    Only the tag vocabulary needs an action; it runs when first asked for.
    """

    user_stats: DataFrame
    item_stats: DataFrame
    defaults: DataFrame
    demographics: DataFrame
    items: DataFrame
    tag_mode: str = "substring"

    @cached_property
    def vocabulary(self) -> list[str]:
        return f.vocabulary_list(self.items)

    @property
    def multihot(self) -> DataFrame:
        return f.tag_multihot(self.items, self.vocabulary, mode=self.tag_mode)

    @property
    def columns(self) -> list[str]:
        return f.feature_columns(self.vocabulary)

    def matrix(self, rows: DataFrame, keep: Sequence[str], serving: bool = False) -> DataFrame:
        return f.feature_matrix(
            rows, self.user_stats, self.item_stats, self.defaults, self.demographics, self.multihot,
            self.vocabulary, keep=keep,
            demographic_defaults=f.SERVING_DEMOGRAPHICS if serving else None,
        )


def learn(split: DataFrame, items: DataFrame, users: DataFrame, mode: str = "substring") -> FeatureParts:
    train = split.where(F.col("split") == "train")
    return FeatureParts(
        user_stats=f.entity_stats(train, "user_id", "user"),
        item_stats=f.entity_stats(train, "item_id", "item"),
        defaults=f.cold_start_defaults(train),
        demographics=f.encode_demographics(users),
        items=items,
        tag_mode=mode,
    )


def additive_score(rows: DataFrame, parts: FeatureParts, keep: Sequence[str]) -> DataFrame:
    """Deterministic baseline prediction: user mean + item mean - global mean."""
    filled = f.attach_stats(rows.select(*keep), parts.user_stats, parts.item_stats, parts.defaults)
    overall = parts.defaults.select(F.col("user_avg_rating").alias("__g"))
    score = F.round(F.col("user_avg_rating") + F.col("item_avg_rating") - F.col("__g"), 6)
    return filled.join(F.broadcast(overall)).select(*keep, score.alias("prediction"))
