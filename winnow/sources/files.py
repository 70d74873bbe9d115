"""Readers and writers for the tables of the pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File layouts of the interaction data set.
RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType()),
    T.StructField("rating", T.IntegerType()), T.StructField("timestamp", T.LongType()),
])
ITEMS = T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])
USERS = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()), T.StructField("occupation", T.IntegerType()),
    T.StructField("zip_code", T.StringType()),
])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "::",
                   encoding: str = "UTF-8") -> DataFrame:
    """Text with a multi-character separator and no header; no quoting, no inference."""
    return (
        spark.read.schema(schema).option("sep", sep).option("encoding", encoding)
        .option("quote", "\u0000").option("mode", "FAILFAST").csv(path)
    )


def write_delimited(df: DataFrame, path: str, sep: str = "::", encoding: str = "UTF-8") -> None:
    """The counterpart of :func:`read_delimited`."""
    (
        df.write.mode("overwrite").option("sep", sep).option("encoding", encoding)
        .option("quote", "\u0000").option("escapeQuotes", False).csv(path)
    )


def write_splits(split: DataFrame, path: str) -> None:
    """One folder per split.

    Rows are written where they are: no shuffle, a hot split is no hot task.
    """
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("split") == name).drop("split") if name else df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def feature_metadata(spark: SparkSession, groups: Mapping[str, Sequence[str]], defaults: DataFrame,
                     split_sizes: DataFrame) -> DataFrame:
    """Groups, defaults and split sizes as rows ``(section, name, position, value)``."""
    members = spark.createDataFrame(
        [("feature_group", f"{g}.{c}", i, None) for g, cols in groups.items() for i, c in enumerate(cols)],
        "section string, name string, position int, value double",
    )
    names = defaults.columns
    filled = defaults.unpivot([], names, "name", "value").select(
        F.lit("cold_start_default").alias("section"), "name", F.lit(0).alias("position"), "value"
    )
    sizes = split_sizes.select(
        F.lit("split_size").alias("section"), F.col("split").alias("name"), F.lit(0).alias("position"),
        F.col("n_rows").cast("double").alias("value"),
    )
    return members.unionByName(filled).unionByName(sizes)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_embeddings(spark: SparkSession, path: str, key: str, vector: str) -> DataFrame:
    """``(id, vec)`` from a parquet table with an array column."""
    return spark.read.parquet(path).select(key, F.col(vector).alias("vec"))


def write_embeddings(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_table(df: DataFrame, path: str) -> None:
    """A baseline, histogram edges or an id map, to be read again by later runs."""
    df.write.mode("overwrite").parquet(path)


def append_reports(reports: DataFrame, path: str) -> None:
    """Adds reports to a history; every call adds files and rewrites none."""
    reports.write.mode("append").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
