"""Queries of the archive, mixing, packing and scanning operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from winnow.llm import mixing, packing, secrets, warc
from winnow.llm.registry import query, table
from winnow.runtime import materialize


def word_vocabulary() -> str:
    """Path of the public word-wise BPE vocabulary on this machine and its executors."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# SHA-1 in base 32: the 40 hex digits become 160 bits, read five at a time.
OP5_SQL = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), digests AS (
  SELECT page_id, strlen(body) AS payload_bytes,
         list_transform(string_split(sha1(body), ''), lambda c: instr('0123456789abcdef', c) - 1) AS nibbles,
         max(page_id) OVER (PARTITION BY body) AS keeper
  FROM payloads
), bits AS (
  SELECT page_id, payload_bytes, keeper,
         array_to_string(list_transform(nibbles, lambda v: ((v >> 3) & 1)::VARCHAR || ((v >> 2) & 1)::VARCHAR
                                                      || ((v >> 1) & 1)::VARCHAR || (v & 1)::VARCHAR), '') AS b
  FROM digests
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * substr(b, 5 * i::INT + 1, 1)::INT + 8 * substr(b, 5 * i::INT + 2, 1)::INT
           + 4 * substr(b, 5 * i::INT + 3, 1)::INT + 2 * substr(b, 5 * i::INT + 4, 1)::INT
           + substr(b, 5 * i::INT + 5, 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM bits
"""


@query("op5_warc", OP5_SQL)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


@query("op7_packing")
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_vocabulary())


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", mixing.word_count("text").alias("size")), "sizes")
    out = mixing.mixed(sized, mixing.source_targets(sized))
    return out.selectExpr("doc_id", "size", "source_size", "target", "copies * size AS taken", "source")


@query("op10_secrets")
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))
