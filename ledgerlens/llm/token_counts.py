"""Token counts of texts through a cache of digests.

A count depends on the normalised content (a missing text is the empty one) and on the tokenizer
version (its file, library and options), so the cache maps the digests of both to a count. Contents
of the given rows are looked up; what the cache does not list is encoded once for each distinct
content and appended, so a later run over the same or a grown table encodes only what is new. A run
that dies loses at most its own appends; a pair that two runs append at once counts once.

Texts cross the network at most once and only where their content is missing from the cache. Copies
are made one within each task before that.

Defined results: a missing or empty text has no tokens; missing and repeated ids and repeated rows
are kept, each with its count; texts are counted whole at any length; an empty table gives an empty
result and appends nothing; columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import tokenizing
from ledgerlens.llm.text import whole
from ledgerlens.plans.staging import drop_staged, stage, staging_folder

CACHE, TOKENIZER, LIMIT = "token-counts", "byte_bpe_50k.json", 1024
COLUMNS = "tokenizer string, content binary, n_tokens bigint"
#: Bytes that a broadcast digest takes at most.
DIGEST_BYTES = 128


def content_digest(text: str):
    """SHA-256 of the normalised content."""
    return F.unhex(F.sha2(whole(text), 256))


def cache_folder(spark: SparkSession, corpus: str = "shared") -> str:
    """The cache of a corpus, such as a table at some path; it never outgrows what was in there."""
    return f"{staging_folder(spark)}/{CACHE}/{hashlib.sha256(corpus.encode()).hexdigest()[:16]}"


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """(content, n_tokens) that the cache lists for a tokenizer version; pairs can repeat."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/tokenizer={version}")
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return spark.createDataFrame([], COLUMNS).drop("tokenizer")
    return (spark.read.schema(COLUMNS).parquet(folder)
            .where(F.col("tokenizer") == version).drop("tokenizer"))


def encode(texts: DataFrame, path: str) -> DataFrame:
    """(content, n_tokens) of rows (content, text)."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, ids = tokenizing.encoder(path)
        for part in parts:
            sizes = [len(i) for run in tokenizing.by_size(part.column(1).to_pylist())
                     for i in ids(run)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64())], ["content", "n_tokens"])

    return texts.mapInArrow(batches, "content binary, n_tokens bigint")


def _broadcast_limit(spark: SparkSession) -> int:
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _missing_texts(df: DataFrame, missing: DataFrame, text: str) -> DataFrame:
    """One row (content, text) of each missing content.

    Few missing digests go to the texts; many meet the texts where the distinct ones are shuffled.
    """
    spark = df.sparkSession
    texts = df.select(content_digest(text).alias("content"), whole(text).alias("text"))
    if missing.count() * DIGEST_BYTES <= _broadcast_limit(spark):
        return (texts.join(F.broadcast(missing), "content", "left_semi")
                .dropDuplicates(["content"]))
    return texts.dropDuplicates(["content"]).join(
        missing.hint("shuffle_merge"), "content", "left_semi")


def count_tokens(df: DataFrame, id: str = "doc_id", text: str = "text",
                 tokenizer: str | None = None, cache: str | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row of ``df``; new counts are appended to ``cache``.

    ``tokenizer`` is the path of a .json or .model file (default: byte_bpe_50k.json), ``cache`` a
    folder that driver and executors share (default: one for all corpora in the staging folder).
    """
    spark = df.sparkSession
    path = tokenizer or tokenizing.vocabulary(TOKENIZER)
    folder = cache or cache_folder(spark)
    version = tokenizing.version(path)
    rows = stage(df.select(F.col(id).alias("id"), content_digest(text).alias("content"),
                           F.octet_length(whole(text)).cast("bigint").alias("n_bytes")),
                 "contents")
    wanted = rows.select("content").distinct()
    known = stage(read_cache(spark, folder, version).join(wanted, "content", "left_semi")
                  .groupBy("content").agg(F.min("n_tokens").alias("n_tokens")), "known")
    missing = stage(wanted.join(known, "content", "left_anti"), "missing")
    counts = known
    staged = [rows, known, missing]
    if not missing.isEmpty():
        new = stage(encode(_missing_texts(df, missing, text), path), "counted")
        staged.append(new)
        (new.select(F.lit(version).alias("tokenizer"), "content", "n_tokens")
         .write.mode("append").partitionBy("tokenizer").parquet(folder))
        counts = known.unionByName(new)
    # one row a content, so the join multiplies nothing and Spark can split a content of many rows
    staged.append(counts := stage(counts, "counts"))
    counted = stage(rows.join(counts, "content").select("id", "n_bytes", "n_tokens"), "token-counts")
    for table in staged:
        drop_staged(table)
    return counted
