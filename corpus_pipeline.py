"""From raw documents to packed training sequences.

Each stage gets the documents that the one before it kept, written as Parquet and read again. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import mixing, packing, quality_rules, secret_scans, simhash
from ledgerlens.llm.text import table
from ledgerlens.plans.staging import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates by SimHash, the document with the least id."""
    return simhash.keep_one_of_each_group(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced."""
    return secret_scans.redact(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets."""
    return packing.pack(packing.pieces(docs)).select(
        F.col("id").alias("doc_id"), "piece", "start", "length",
        F.col("crc32").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("quality rules", good_documents),
    ("SimHash near-dedup", one_of_each_group),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed_sources),
    ("best-fit packing", packed_sequences),
]

#: SQL has neither XXH64 shingle hashes, nor the rounding's random numbers, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
