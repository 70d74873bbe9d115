"""Collects named queries together with their SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

# Far below the last digit kept.  Exact halves such as k/64 would otherwise be
# rounded up or down by the last bit of a sum, which depends on row order.
TIE_SHIFT = 1.7e-9

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; its doubles are rounded to six digits, as in the SQL."""

    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame) -> DataFrame:
    def tidy(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            # Plain double arithmetic; F.round would go through decimals per value.
            return (F.rint((c.cast("double") + TIE_SHIFT) * 1e6) / 1e6 + F.lit(0.0)).alias(field.name)
        return c

    return df.select(*[tidy(f) for f in df.schema.fields])


def joined_text(array: str):
    """An array as comma-separated text, the same in both engines."""
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")
