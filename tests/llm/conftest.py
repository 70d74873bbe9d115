from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from ``(doc_id, text, lang, source)`` rows."""

    def make(rows, extra=False, parts=3):
        filled = [(*r, *[None] * (4 - len(r)), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(filled, DOCUMENTS).repartition(parts)
        if extra:
            # Names that the operators use inside.
            for name in ("h", "size", "row", "copies", "bits", "component_id", "root", "key", "shard", "k_id", "gone", "a.b"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
