"""From raw documents to packed training sequences.

Five stages, each one operator of ``winnow.llm`` applied to all that its predecessor
kept.  Every stage is written and read again, so a lost executor repeats one stage at
most.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import line_dedup, mixing, packing, quality, simhash
from winnow.llm.registry import table
from winnow.llm.table_queries import word_vocabulary
from winnow.runtime import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose score is below the threshold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.kept(docs, quality.learnt(docs, labels))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that repeat an earlier one; ``n_chars`` follows the text that is left."""
    return line_dedup.drop_lines(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or thins documents so that sources meet their target weights."""
    return mixing.repeat_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of all documents into sequences."""
    return packing.pack_documents(docs, word_vocabulary())


STAGES = [("quality", good_quality), ("lines", fresh_lines), ("near_duplicates", one_of_each), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None  # fitted weights, hashes and token ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
