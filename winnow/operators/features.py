"""Leakage-free features: entity statistics of train rows, defaults, encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions import tags
from winnow.runtime import materialize

# Statistic suffixes in saved order.
STATS = ("rating_count", "avg_rating", "rating_std", "rating_min", "rating_max")
INTERACTIONS = (
    "user_item_rating_diff",
    "user_rating_count_norm",
    "item_rating_count_norm",
    "user_item_activity_product",
)
DEMOGRAPHICS = ("gender", "age_group", "occupation")
# What the lookup path assumes about unknown users.
SERVING_DEMOGRAPHICS = {"gender": 0, "age_group": 25, "occupation": 0}


def stat_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{s}" for s in STATS]


def entity_stats(train: DataFrame, key: str, prefix: str, rating: str = "rating") -> DataFrame:
    """Count, mean, sample deviation (0 for one row), min and max per entity."""
    r = F.col(rating)
    aggregates = [F.count(r), F.avg(r), F.coalesce(F.stddev_samp(r), F.lit(0.0)), F.min(r), F.max(r)]
    return train.groupBy(key).agg(
        *[a.alias(name) for a, name in zip(aggregates, stat_columns(prefix))]
    )


def cold_start_defaults(train: DataFrame, rating: str = "rating",
                        prefixes: Sequence[str] = ("user", "item")) -> DataFrame:
    """One row: global statistics under the names of the entity statistics."""
    r = F.col(rating)
    values = [F.lit(0.0), F.avg(r), F.stddev_samp(r), F.min(r).cast("double"), F.max(r).cast("double")]
    return train.agg(
        *[v.alias(name) for p in prefixes for v, name in zip(values, stat_columns(p))]
    )


def encode_demographics(users: DataFrame) -> DataFrame:
    """Gender as 0/1; age codes kept under the name ``age_group``."""
    return users.select(
        "user_id",
        (F.col("gender") == "M").cast("int").alias("gender"),
        F.col("age").alias("age_group"),
        "occupation",
    )


def tag_vocabulary(items: DataFrame, packed: str = "genres") -> DataFrame:
    """Distinct tags of the packed column with their column names, sorted."""
    return (
        items.select(F.explode(tags.tokens(F.col(packed))).alias("tag"))
        .distinct()
        .select("tag", F.concat(F.lit("genre_"), tags.slug_column(F.col("tag"))).alias("column_name"))
        .orderBy("tag")
    )


def vocabulary_list(items: DataFrame, packed: str = "genres") -> list[str]:
    """The vocabulary on the driver, to fix the column list of a plan.

    It is as long as the catalogue has different tags.  For open vocabularies,
    whose tags would not do as columns, use ``tag_rows``.
    """
    return [r["tag"] for r in tag_vocabulary(items, packed).select("tag").collect()]


def tag_rows(items: DataFrame, packed: str = "genres", key: str = "item_id") -> DataFrame:
    """The long form of the tags, one row per item and distinct tag, for any vocabulary."""
    return items.select(key, F.explode(F.array_distinct(tags.tokens(F.col(packed)))).alias("tag"))


def tag_multihot(items: DataFrame, vocabulary: Sequence[str], packed: str = "genres",
                 mode: str = "substring", key: str = "item_id") -> DataFrame:
    """One 0/1 column per tag."""
    flags = [tags.flag(F.col(packed), t, mode).alias(f"genre_{tags.slug(t)}") for t in vocabulary]
    return items.select(key, *flags)


def fill_from_defaults(df: DataFrame, defaults: DataFrame) -> DataFrame:
    """Replaces missing statistics by the one-row defaults table."""
    names = defaults.columns
    one = defaults.select(*[F.col(c).alias(f"__d_{c}") for c in names])
    joined = df.join(F.broadcast(one), how="left")  # the defaults are one row
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"__d_{c}")) for c in names}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def attach_stats(df: DataFrame, user_stats: DataFrame, item_stats: DataFrame,
                 defaults: DataFrame, *, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Left joins both statistics tables and fills cold entities with defaults.

    The statistics are stored first.  Fresh from their aggregation they would
    already be partitioned by the entity, and adaptive execution could not split
    the partitions of hot entities; as stored tables both sides are shuffled, or
    the small side is broadcast by its measured size.
    """
    joined = df.join(materialize(user_stats, "user-stats"), user, "left").join(materialize(item_stats, "item-stats"), item, "left")
    return fill_from_defaults(joined, defaults)


def interaction_columns(df: DataFrame) -> DataFrame:
    """Difference of the means, log counts and their product."""
    user_log = F.log1p("user_rating_count")
    item_log = F.log1p("item_rating_count")
    values = [F.col("user_avg_rating") - F.col("item_avg_rating"), user_log, item_log, user_log * item_log]
    return df.withColumns(dict(zip(INTERACTIONS, values)))


def feature_columns(vocabulary: Sequence[str]) -> list[str]:
    """Saved order of the feature columns."""
    return [
        *stat_columns("user"), *stat_columns("item"), *DEMOGRAPHICS,
        *[f"genre_{tags.slug(t)}" for t in vocabulary], *INTERACTIONS,
    ]


def feature_groups(vocabulary: Sequence[str]) -> dict[str, list[str]]:
    return {
        "user_agg": stat_columns("user"),
        "item_agg": stat_columns("item"),
        "interaction": list(INTERACTIONS),
        "demographic": list(DEMOGRAPHICS),
        "genre": [f"genre_{tags.slug(t)}" for t in vocabulary],
    }


def feature_matrix(df: DataFrame, user_stats: DataFrame, item_stats: DataFrame,
                   defaults: DataFrame, demographics: DataFrame, multihot: DataFrame,
                   vocabulary: Sequence[str], *, demographic_defaults: dict | None = None,
                   keep: Sequence[str] = ()) -> DataFrame:
    """All features of ``df`` rows in saved order; whatever is still missing is 0.

    Everything known about a user, and about an item, is put together first,
    while it is one row per entity.  The interactions then meet two tables
    instead of four, which at scale means two shuffles of the large side.
    ``demographic_defaults`` switches to the lookup path's values for unknown
    users instead of 0.
    """
    wide = attach_stats(
        df.select(*keep), user_stats.join(demographics, "user_id", "full"),
        item_stats.join(multihot, "item_id", "full"), defaults,
    )
    wide = interaction_columns(wide)
    columns = feature_columns(vocabulary)
    if demographic_defaults:
        wide = wide.fillna(demographic_defaults)
    return wide.fillna(0, subset=columns).select(*keep, *columns)


def cold_start_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("user_rating_count") == 0)


def leakage_checks(features: DataFrame, defaults: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Violations of three promises over all rows of all splits.

    ``features`` holds ``split``, ``user_id`` and the feature columns.
    """
    names = stat_columns("user")
    d = F.broadcast(defaults.select(*[F.col(c).alias(f"__d_{c}") for c in names]))
    # One row per user and split, then per user: a frozen statistic has one value.
    per_user = (
        features.groupBy("user_id")
        .agg(*[F.max(c).alias(f"hi_{c}") for c in names], *[F.min(c).alias(f"lo_{c}") for c in names])
    )
    moved = None
    for c in names:
        differs = F.abs(F.col(f"hi_{c}") - F.col(f"lo_{c}")) >= 0.001
        moved = differs if moved is None else moved | differs
    stable = per_user.agg(F.count_if(moved).alias("violations")).select(
        F.lit("user_stats_equal_across_splits").alias("check"), "violations"
    )
    nulls = None
    off_default = None
    for c in columns:
        nulls = F.col(c).isNull() if nulls is None else nulls | F.col(c).isNull()
    for c in names:
        wrong = F.abs(F.col(c) - F.col(f"__d_{c}")) > 1e-9
        off_default = wrong if off_default is None else off_default | wrong
    cold = F.col("user_rating_count") == 0
    rest = features.join(d).agg(
        F.count_if(nulls).alias("no_missing_values"),
        F.count_if(cold & off_default).alias("cold_users_hold_defaults"),
        F.count_if(cold).alias("cold_user_rows"),
    )
    long = rest.unpivot(
        [], ["no_missing_values", "cold_users_hold_defaults", "cold_user_rows"], "check", "violations"
    )
    return stable.unionByName(long)
