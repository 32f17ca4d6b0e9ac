"""Secrets in texts, scanned through a ledger of content-addressed blobs.

A blob is a distinct text, addressed by the SHA-256 of its UTF-8 bytes; many paths (documents,
versions of a file) can hold the same one. Only pairs of blob and rule version that the ledger does
not list are scanned; findings are kept per blob and joined back to every path.

Spans are counted in code points, the end exclusive, leftmost and non-overlapping per rule. A text
with n matches is walked in about sqrt(n) blocks of as many matches, so that no list or text is
copied once for every match.
Defined results: a missing text is the empty blob; a missing path is kept as a null path; repeated
rows give repeated results; an empty table gives an empty result. Built-in expressions only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.text import unused, whole
from ledgerlens.plans.staging import staging_folder


@dataclass(frozen=True)
class SecretRule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters.

    ``hints`` are strings of which any text with a match contains one; they only save time.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}:{self.version}"


BASE_RULES = (
    SecretRule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
               r"([A-Za-z0-9+/_.=-]+)", 2, 6),
    # runs are taken whole, so a shorter one can't hide a longer one behind it
    SecretRule("access", r"AKIA[A-Z0-9]{16,}", 0, 20, ("AKIA",)),
    SecretRule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    SecretRule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("-----BEGIN ",)),
    SecretRule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+",
               hints=("eyJ",)),
    SecretRule("prefixed_token", r"(?:ghp|gho|ghs|xoxb|xoxp|sk_live)[_-][A-Za-z0-9-]{16,}",
               hints=("ghp_", "gho_", "ghs_", "xoxb-", "xoxp-", "sk_live_")),
)
RULES = BASE_RULES + MORE_RULES
LEDGER = "secret-ledger"
SPAN = "array<struct<start:int,end:int,kind:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(items: Column) -> Column:
    """The array in about as many slices as a slice has elements; an empty one is one slice."""
    n = F.greatest(F.size(items), F.lit(1))
    width = F.ceil(F.sqrt(n)).cast("int")
    return F.transform(F.sequence(F.lit(1), n, width), lambda i: F.slice(items, i, width))


def _carried(blocks: Column, after: Callable[[Column, Column], Column]) -> Column:
    """What reaches each block from the ones before it, 0 the first, and what leaves the last."""
    return F.aggregate(blocks, F.array(F.lit(0)), lambda at, block: F.concat(
        at, F.array(after(F.element_at(at, -1), block))))


def _spans(text: Column, rule: SecretRule) -> Column:
    """Spans of one rule: the lengths of the matches and of the pieces between them, summed up."""
    p = F.lit(rule.pattern)
    pieces = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, p, F.lit(0))
    judged = F.regexp_extract_all(text, p, F.lit(rule.group))
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), F.arrays_zip(
        found.alias("m"), judged.alias("g")), lambda gap, x: F.struct(
            F.length(gap).alias("gap"), F.length(x.m).alias("size"),
            (F.length(x.g) >= rule.least).alias("ok")))


    def of_block(block: Column, at: Column) -> Column:
        start = F.struct(at.alias("at"), F.array().cast(SPAN).alias("spans"))
        return F.aggregate(block, start, lambda a, x: F.struct(
            (a.at + x.gap + x["size"]).alias("at"),
            F.when(x.ok, F.concat(a.spans, F.array(F.struct(
                (a.at + x.gap).alias("start"), (a.at + x.gap + x["size"]).alias("end"),
                F.lit(rule.name).alias("kind"))))).otherwise(a.spans).cast(SPAN).alias("spans"))
        ).spans

    def past(at: Column, block: Column) -> Column:
        return F.aggregate(block, at, lambda a, x: a + x.gap + x["size"])

    spans = _let(steps, lambda s: _let(_blocks(s), lambda blocks: _let(
        _carried(blocks, past), lambda starts: F.flatten(F.transform(
            blocks, lambda block, k: of_block(block, F.get(starts, k)))))))
    hinted = text.rlike(rule.pattern)
    if rule.hints:
        holds = F.lit(False)
        for hint in rule.hints:
            holds = holds | text.contains(hint)
        hinted = holds & hinted
    return F.when(hinted, spans).otherwise(F.array().cast(SPAN))


def blob_key(text: str) -> Column:
    return F.sha2(whole(text), 256)


def scan_unseen(versions: DataFrame, rules: Sequence[SecretRule] = RULES,
                ledger: DataFrame | None = None, text: str = "text") -> DataFrame:
    """(blob, rule, spans) of every blob and rule version that ``ledger`` does not list.

    ``ledger`` has columns blob and rule (see ``SecretRule.key``), any spans beside them. A pair
    without findings gets a row with an empty array: appended to the ledger, it is not scanned
    again. Blobs are made distinct before the shuffle within each task, so a text that a third of
    all paths hold costs one row a task.
    """
    blobs = (versions.select(blob_key(text).alias("blob"), whole(text).alias("text"))
             .dropDuplicates(["blob"]))
    if ledger is None:
        unseen = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = (ledger.select("blob", "rule").where(F.col("rule").isin([r.key for r in rules]))
                .groupBy("blob").agg(F.collect_set("rule").alias("seen")))
        unseen = (blobs.join(seen, "blob", "left")
                  .withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
                  .where(F.size("seen") < len(rules)))
    scanned = unseen.select("blob", F.array(*[
        F.when(~F.array_contains("seen", r.key), F.struct(
            F.lit(r.key).alias("rule"), _spans(F.col("text"), r).alias("spans")))
        for r in rules]).alias("pairs"))
    return (scanned.select("blob", F.explode("pairs").alias("pair")).where("pair is not null")
            .select("blob", "pair.rule", "pair.spans"))


def ledger_folder(spark: SparkSession, corpus: str = "shared") -> str:
    """The ledger of a corpus, such as a table at some path."""
    return f"{staging_folder(spark)}/{LEDGER}/{hashlib.sha256(corpus.encode()).hexdigest()[:16]}"


def read_ledger(spark: SparkSession, folder: str) -> DataFrame | None:
    """(blob, rule, spans) of all pairs scanned so far; None before the first scan."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    return spark.read.schema(f"blob string, rule string, spans {SPAN}").parquet(folder)


def scan_with_ledger(versions: DataFrame, folder: str, rules: Sequence[SecretRule] = RULES,
                     text: str = "text") -> DataFrame:
    """(blob, rule, spans) of the rules' pairs in the ledger, after ``versions`` has been added.

    Blobs that no row of ``versions`` holds any more stay listed: an old version that comes back is
    not scanned again. A run that dies in its append leaves the ledger without its pairs; a pair
    that two runs append at once counts once.
    """
    spark = versions.sparkSession
    scan_unseen(versions, rules, read_ledger(spark, folder), text).write.mode("append").parquet(
        folder)
    return (read_ledger(spark, folder).where(F.col("rule").isin([r.key for r in rules]))
            .where(F.size("spans") > 0).dropDuplicates(["blob", "rule"]))


def findings_of_paths(versions: DataFrame, findings: DataFrame, path: str = "doc_id",
                      text: str = "text", order: Sequence[str] = ()) -> DataFrame:
    """(path, blob, spans): all spans of a path's blob by start, then by kind as in ``order``.

    ``findings`` holds the rows of ``scan_unseen`` and earlier ones of the ledger.
    """
    order = list(order) or [r.name for r in RULES]
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("s.kind"))
    spans = (findings.where(F.size("spans") > 0).select("blob", F.explode("spans").alias("s"))
             .groupBy("blob").agg(F.sort_array(F.collect_list(F.struct(
                 F.col("s.start").alias("start"), rank.alias("rank"), F.col("s.end").alias("end"),
                 F.col("s.kind").alias("kind")))).alias("spans")))
    paths = versions.select(F.col(path).alias("path"), blob_key(text).alias("blob"))
    return paths.join(spans, "blob", "left").select("path", "blob", F.coalesce(
        "spans", F.array().cast("array<struct<start:int,rank:bigint,end:int,kind:string>>")
    ).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every run of overlapping spans, in order of start, replaced by ``mark``."""

    def of_block(block: Column, at: Column, piece: Column) -> Column:
        """A block's part of the text, from code point ``at`` on; ``piece`` starts there."""
        start = F.struct(F.lit("").alias("out"), at.alias("at"))
        return F.aggregate(block, start, lambda a, s: F.struct(
            F.when(s.start < a.at, a.out).otherwise(F.concat(
                a.out, F.substring(piece, a.at - at + 1, s.start - a.at), F.lit(mark))
            ).alias("out"), F.greatest(a.at, s.end).alias("at"))).out

    def past(at: Column, block: Column) -> Column:
        return F.aggregate(block, at, lambda a, s: F.greatest(a, s.end))

    def joined(blocks: Column, ats: Column) -> Column:
        parts = F.transform(blocks, lambda block, k: _let(F.get(ats, k), lambda at: _let(
            F.substring(text, at + 1, F.element_at(block, -1).start - at),
            lambda piece: of_block(block, at, piece))))
        return F.concat(F.array_join(parts, ""),
                        F.substring(text, F.element_at(ats, -1) + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(_let(_blocks(spans), lambda blocks: _let(
        _carried(blocks, past), lambda ats: joined(blocks, ats))))


def redact(df: DataFrame, rules: Sequence[SecretRule] = RULES, text: str = "text",
           size: str = "n_chars", mark: str = "[secret]") -> DataFrame:
    """The rows of ``df`` with secrets replaced by ``mark``; a column ``size`` follows the text.

    Columns and rows stay as they are otherwise; a missing text stays missing.
    """
    own = unused(df, "__redact")
    found = scan_unseen(df, rules, None, text).where(F.size("spans") > 0)
    spans = (found.select("blob", F.explode("spans").alias("s")).groupBy("blob")
             .agg(F.sort_array(F.collect_list("s")).alias("spans"))
             .select(F.col("blob").alias(f"{own}_blob"), F.col("spans").alias(f"{own}_spans")))
    out = df.withColumn(f"{own}_blob", blob_key(text)).join(spans, f"{own}_blob", "left")
    held = F.col(f"{own}_spans")
    clean = F.when(held.isNull(), F.col(text)).otherwise(redacted(F.col(text), held, mark))
    out = out.withColumn(text, clean)
    if size in df.columns:
        kind = dict(df.dtypes)[size]
        out = out.withColumn(size, F.when(held.isNull(), F.col(size)).otherwise(
            F.length(text).cast(kind)))
    return out.select(*[F.col(f"`{c}`") for c in df.columns])
