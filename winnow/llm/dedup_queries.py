"""Queries of the deduplicating operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winnow.llm import exact_dedup, line_dedup, simhash
from winnow.llm.registry import query, table

OP1_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain
  FROM documents
), ranked AS (
  SELECT doc_id, plain,
         first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY plain) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256
FROM ranked
"""


@query("op1_exact_dedup", OP1_SQL)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every visible line, whether it stays, and the place of the line that its group keeps."""
    lines = line_dedup.line_groups(table(spark, sf_dir, "documents"))
    return lines.selectExpr("doc_id", "line_no", "kept", "keep.doc_id AS keep_doc_id", "keep.line_no AS keep_line_no", "copies")
