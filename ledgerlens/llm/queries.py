"""Registered queries over the corpus tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlens.llm import (
    alignment, embedding_dedup, html_extraction, mixing, oracle, packing, quality_classifier,
    quality_rules, secret_scans, simhash, spelling, substring_dedup, suffix_array, token_counts,
)
from ledgerlens.llm.text import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix_array.remove_earlier_strings(
        table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed",
                       F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op2_mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    taken = mixing.copies(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = embedding_dedup.near_duplicate_vectors(table(spark, folder, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links",
                        F.col("component").alias("component_id"), "kept")


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_quality_rules(
        table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "measures.*", "base_failed",
                         F.col("rejected_by").isNull().alias("kept"))


def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    ledger = secret_scans.ledger_folder(spark, f"{folder}/documents")
    found = secret_scans.findings_of_paths(
        documents, secret_scans.scan_with_ledger(documents, ledger))
    base = [r.name for r in secret_scans.BASE_RULES]

    def of(*kinds: str):
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    def listed(spans):
        return F.array_join(F.transform(
            spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    return found.select(
        F.col("path").alias("doc_id"),
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(listed(of(*base)), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(documents)).select(
        F.col("id").alias("doc_id"), "piece", "start", "length",
        F.col("crc32").alias("ids_crc32"), "sequence_id", "offset")


def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    texts = html_extraction.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return texts.select("*", F.length("text").cast("long").alias("n_chars"))


def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(
        table(spark, folder, "documents").select("doc_id", "text"))
    return groups.select(F.col("id").alias("doc_id"),
                         simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"),
                         F.col("component").alias("component_id"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.score_quality(
        table(spark, folder, "documents").select("doc_id", "text"),
        table(spark, folder, "labels")).withColumnRenamed("id", "doc_id")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(
        table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                       F.sha2("kept", 256).alias("kept_sha256"))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(
        table(spark, folder, "documents").select("doc_id", "text"),
        cache=token_counts.cache_folder(spark, f"{folder}/documents"))
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > token_counts.LIMIT).alias("over_limit"))


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(
        table(spark, folder, "documents").select("doc_id", "text")).withColumnRenamed(
            "id", "doc_id")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, folder, "documents").select("doc_id", "text"))


def queries() -> dict[str, Query]:
    return {
        "op1_suffix_array_dedup": op1_suffix_array_dedup,
        "op2_mixing_sources": op2_mixing_sources,
        "op3_embedding_dedup": op3_embedding_dedup,
        "op4_quality_rules": op4_quality_rules,
        "op5_secret_scans": op5_secret_scans,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_html_extraction": op7_html_extraction,
        "op8_simhash_near_dedup": op8_simhash_near_dedup,
        "op9_quality_classifier": op9_quality_classifier,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_token_counts": op11_token_counts,
        "op12_tokenizer_alignment": op12_tokenizer_alignment,
        "op13_spelling_variants": op13_spelling_variants,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_array_dedup": oracle.SUFFIX_ARRAY_DEDUP,
        "op3_embedding_dedup": oracle.EMBEDDING_DEDUP,
        "op4_quality_rules": oracle.QUALITY_RULES,
        "op5_secret_scans": oracle.SECRET_SCANS,
        "op10_substring_dedup": oracle.SUBSTRING_DEDUP,
    }
