"""Descriptive statistics of interaction tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.functions import tags
from winnow.operators.order_stats import counted_percentiles

# Fixed values
QUARTILES = (0.25, 0.5, 0.75)


def activity_summary(df: DataFrame, key: str) -> DataFrame:
    """Distribution of the number of rows per entity.

    Group sizes repeat, so equal sizes are merged before the percentile.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    moments = sizes.agg(
        F.lit(key).alias("entity"), F.count("n").alias("count"), F.avg("n").alias("mean"),
        F.stddev_samp("n").alias("std"), F.min("n").alias("min"), F.max("n").alias("max"),
    )
    return _with_quartiles(moments, counted_percentiles(sizes, "n", QUARTILES))


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, quartiles and range of a column with few values."""
    c = F.col(column)
    moments = df.agg(
        F.lit(column).alias("entity"), F.count(c).alias("count"), F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
    )
    return _with_quartiles(moments, counted_percentiles(df.where(c.isNotNull()), column, QUARTILES))


def _with_quartiles(moments: DataFrame, spread: DataFrame) -> DataFrame:
    return moments.join(F.broadcast(spread)).select(  # two one-row tables
        "entity", "count", "mean", "std", "min",
        *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
        "max",
    )


def value_shares(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows and share of each value, optionally within groups."""
    counts = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("n_rows"))
    totals = counts.groupBy(*by).agg(F.sum("n_rows").alias("__t"))
    joined = counts.join(totals, list(by)) if by else counts.join(F.broadcast(totals))
    return joined.withColumn("share", F.col("n_rows") / F.col("__t")).drop("__t")


def rating_distribution(split: DataFrame, values: Sequence[int] = (1, 2, 3, 4, 5),
                        rating: str = "rating") -> DataFrame:
    """Percent of each rating per split, 0 where a rating does not occur."""
    n = F.count(F.lit(1))
    return split.groupBy("split").agg(
        n.alias("n_rows"),
        *[(F.count_if(F.col(rating) == v) * 100.0 / n).alias(f"pct_{v}") for v in values],
    )


def tag_counts(items: DataFrame, packed: str = "genres") -> DataFrame:
    """Occurrences of every tag, repeated tags of one item included."""
    return items.select(F.explode(tags.tokens(F.col(packed))).alias("tag")).groupBy("tag").agg(
        F.count(F.lit(1)).alias("n")
    )


def column_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sum of each 0/1 column, as rows."""
    return df.agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "total"
    )


def dataset_overview(df: DataFrame, user: str = "user_id", item: str = "item_id",
                     approximate: bool = False) -> DataFrame:
    """Rows, users, items and sparsity of the interaction matrix."""
    n = F.count(F.lit(1)).alias("n_rows")
    if approximate:
        one = df.agg(n, F.approx_count_distinct(user).alias("n_users"),
                     F.approx_count_distinct(item).alias("n_items"))
    else:
        one = df.agg(n, F.count_distinct(user).alias("n_users"), F.count_distinct(item).alias("n_items"))
    cells = F.col("n_users").cast("double") * F.col("n_items")
    return one.withColumn("sparsity", 1 - F.try_divide(F.col("n_rows").cast("double"), cells))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "n_null"
    )


def daily_counts(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.groupBy(F.col(ts).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def epoch_to_timestamp(df: DataFrame, seconds: str, name: str = "ts") -> DataFrame:
    """Epoch seconds as a timestamp column."""
    return df.withColumn(name, F.timestamp_seconds(seconds))


def time_span(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")).withColumn(
        "span_days", F.datediff(F.col("last_ts").cast("date"), F.col("first_ts").cast("date"))
    )


def top_items(df: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent items with their titles; the titles meet only ``n`` rows."""
    head = (
        df.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy(F.desc("n_rows"), F.asc("item_id")).limit(n)
    )
    titles = items.select("item_id", "title")
    return head.join(titles, "item_id", "left")


def target_correlation(df: DataFrame, columns: Sequence[str], target: str = "rating") -> DataFrame:
    """Pearson correlation of each column with the target; null for constants."""
    t = F.col(target).cast("double")
    long = df.select(t.alias("__t"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ["__t"], list(columns), "feature", "value"
    )
    return long.groupBy("feature").agg(
        F.try_divide(
            F.covar_samp("value", "__t"), F.stddev_samp("value") * F.stddev_samp("__t")
        ).alias("correlation")
    )


def correlated_pairs(df: DataFrame, columns: Sequence[str], limit: float = 0.9) -> DataFrame:
    """Column pairs with an absolute correlation above ``limit``.

    The correlation matrix has one cell per column pair, independent of rows.
    """
    columns = list(columns)
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(doubles).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    pairs = [
        (columns[i], columns[j], float(matrix[i, j]))
        for i in range(len(columns)) for j in range(i + 1, len(columns))
        if abs(matrix[i, j]) > limit
    ]
    return df.sparkSession.createDataFrame(pairs, "feature_a string, feature_b string, correlation double")


def split_feature_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and deviation of each column per split."""
    long = df.select("split", *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        ["split"], list(columns), "feature", "value"
    )
    return long.groupBy("split", "feature").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std")
    )
