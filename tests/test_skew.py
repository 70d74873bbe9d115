"""A user with half of all rows: the joins that meet it are split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from winnow.operators import features, lookup_tables, splits
from winnow.runtime import materialize

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    rows = spark.range(0, 60_000, numPartitions=12).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 997).cast("long").alias("user_id"),
        (F.col("id") % 311).alias("item_id"), (F.col("id") % 5 + 1).cast("int").alias("rating"), F.md5(F.col("id").cast("string")).alias("pad"),
        F.when(F.col("id") % 3 == 0, "train").when(F.col("id") % 3 == 1, "val").otherwise("test").alias("split"))
    yield materialize(rows, "skewed")
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_attached_statistics(skewed):
    train = skewed.where("split = 'train'")
    users, items = features.entity_stats(train, "user_id", "user"), features.entity_stats(train, "item_id", "item")
    joined = features.attach_stats(skewed, users, items, features.cold_start_defaults(train))
    assert "skew=true" in executed(joined)


def test_minimum_history(skewed):
    assert "skew=true" in executed(splits.minimum_history(skewed, 3))


def test_layered_lookup(skewed):
    primary = skewed.groupBy("user_id").agg(F.avg("rating").alias("mean"))
    assert "skew=true" in executed(lookup_tables.layered_lookup(skewed, primary, "user_id", {"mean": 3.0}))
