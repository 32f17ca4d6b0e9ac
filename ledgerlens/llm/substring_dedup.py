"""Passages that texts share, by compaction of a de Bruijn graph of words.

An edge is a window of ``window`` consecutive words; it leads from the node of its first words (all
but the last one) to the node of its last words. An edge that occurs at two places is a repeat.
Runs of edges that share an anchor (see ``anchors``) and occur again as a whole need no look at
single edges. Of the other runs whose anchor occurs again, all edges are spelled out; the repeated
ones form the graph, whose paths without branches are compacted by pointer doubling with Spark
joins. Every compacted path is laid back on its places in the texts, and only edges that the text
has at consecutive places make a span.

Defined results: a missing or blank text has no words; a text shorter than the window has no
repeats; rows with the same id and text are one document and get the same result; an empty table
gives an empty result; texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import anchors
from ledgerlens.llm.text import whole
from ledgerlens.plans.staging import drop_staged, stage

WINDOW, ANCHOR = 35, 16


def _documents(df: DataFrame, id: str, text: str) -> DataFrame:
    return df.select(F.col(id).alias("id"), F.xxhash64(F.col(id), F.col(text)).alias("key"),
                     whole(text).cast("binary").alias("text"))


def _edges(documents: DataFrame, alone: DataFrame, window: int) -> DataFrame:
    """(edge, head, tail, key, at) of all windows of the occurrences in ``alone``."""
    runs = anchors.runs_of(alone)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            runs = part.column("runs")
            for i, key in enumerate(part.column("key").to_pylist()):
                values = np.frombuffer(part.column("text")[i].as_buffer(), np.uint8)
                symbols, _, _ = anchors.word_symbols(values, np.array([0, len(values)]))
                hashes = anchors.RangeHashes(symbols)
                spots = runs[i].values
                low = spots.field("low").to_numpy()
                _, count = anchors.windows_of(spots.field("shape").to_numpy())
                at = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
                found = [hashes(at + a, at + b).view(np.int64)
                         for a, b in ((0, window), (0, window - 1), (1, window))]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, found), pa.array(np.full(len(at), key)), pa.array(at)],
                    ["edge", "head", "tail", "key", "at"])

    # repeated rows are one document, so each edge comes once for each of its places
    return (documents.select("key", "text").join(runs, "key").dropDuplicates(["key"])
            .mapInArrow(batches, "edge bigint, head bigint, tail bigint, key bigint, at bigint"))


def compacted(edges: DataFrame) -> DataFrame:
    """(edge, path, place) of distinct edges (edge, head, tail).

    Two edges belong to one path where the node between them has no other edge in or out. Each
    round doubles the distance that an edge looks back along its path; a path that closes in itself
    is named by its least edge.
    """
    into = edges.groupBy(F.col("tail").alias("node")).agg(
        F.count("*").alias("n_in"), F.min("edge").alias("before"))
    out = edges.groupBy(F.col("head").alias("node")).agg(
        F.count("*").alias("n_out"), F.min("edge").alias("after"))
    links = into.join(out, "node").where("n_in = 1 and n_out = 1 and before <> after").select(
        F.col("after").alias("edge"), "before")
    paths = stage(edges.select("edge").join(links, "edge", "left").select(
        "edge", F.coalesce("before", "edge").alias("back"),
        F.when(F.col("before").isNull(), 0).otherwise(1).cast("long").alias("place"),
        F.least("edge", F.coalesce("before", "edge")).alias("least"),
        F.col("before").isNull().alias("ended")), "paths")
    # a closed path never ends, so the rounds are bounded by the longest one that could
    rounds = max(1, paths.count()).bit_length()
    for _ in range(rounds):
        if paths.where("not ended").isEmpty():
            break
        ahead = paths.select(F.col("edge").alias("back"), F.col("back").alias("back2"),
                             F.col("place").alias("place2"), F.col("least").alias("least2"),
                             F.col("ended").alias("ended2"))
        going = paths.where("not ended").join(ahead, "back").select(
            "edge", F.col("back2").alias("back"), (F.col("place") + F.col("place2")).alias("place"),
            F.least("least", "least2").alias("least"), F.col("ended2").alias("ended"))
        longer = stage(paths.where("ended").union(going.select(paths.columns)), "paths")
        drop_staged(paths)
        paths = longer
    return paths.select("edge", F.when(F.col("ended"), F.col("back")).otherwise(
        F.col("least")).alias("path"), "place")


def repeated_spans(documents: DataFrame, window: int = WINDOW,
                   anchor: int = ANCHOR) -> DataFrame:
    """(key, low, high): words low to high - 1 lie in windows that occur elsewhere too."""
    marks = stage(anchors.marked(anchors.occurrences(
        documents.select("key", "text"), anchors.word_symbols, window, anchor, False), False),
        "marks")
    edges = stage(_edges(documents, marks.where("alone"), window), "edges")
    repeated = stage(edges.groupBy("edge").agg(
        F.count("*").alias("n"), F.min("head").alias("head"), F.min("tail").alias("tail"))
        .where("n > 1"), "repeated")
    paths = compacted(repeated)
    # the places of a path's edges in one text: one span where they are consecutive
    runs = (edges.join(paths, "edge").groupBy("key", "path", (F.col("at") - F.col("place")).alias(
        "shift")).agg(F.sort_array(F.collect_set("at")).alias("at")))
    at = F.col("at")
    first = F.filter(at, lambda x, i: (i == 0) | (x != F.get(at, i - 1) + 1))
    last = F.filter(at, lambda x, i: (i == F.size(at) - 1) | (x != F.get(at, i + 1) - 1))
    spans = runs.select("key", F.explode(F.arrays_zip(first.alias("low"), last.alias("last")))
                        .alias("s")).select("key", "s.low", (F.col("s.last") + window).alias("high"))
    count = anchors.windows_of(F.col("shape"))[1]
    whole_runs = marks.where("whole").select(
        "key", "low", (F.col("low") + count + (window - 1)).alias("high"))
    return whole_runs.union(spans)


def remove_repeats(df: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW,
                   anchor: int = ANCHOR) -> DataFrame:
    """(id, n_words, n_removed, spans, kept) of every row of ``df``.

    ``kept`` joins the remaining words by one space; ``spans`` lists the removed words' ranges.
    """
    documents = _documents(df, id, text)
    spans = repeated_spans(documents, window, anchor).groupBy("key").agg(
        F.collect_list(F.struct("low", "high")).alias("ranges"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ranges, made = part.column("ranges"), []
            for i, body in enumerate(part.column("text")):
                found = body.as_py().split()
                n, cut = len(found), []
                if ranges[i].is_valid:
                    spot = ranges[i].values
                    low, high = anchors.merged(spot.field("low").to_numpy(),
                                               spot.field("high").to_numpy())
                    cut = list(zip(low.tolist(), high.tolist()))
                    for a, b in reversed(cut):
                        del found[a:b]
                made.append((n, n - len(found), [{"low": a, "high": b} for a, b in cut],
                             b" ".join(found)))
            n, gone, cut, kept = zip(*made) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(cut, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["id", "n_words", "n_removed", "spans", "kept"])

    joined = documents.select("key", "text", "id").join(spans, "key", "left")
    return joined.select("id", "text", "ranges").mapInArrow(
        batches, f"id {dict(documents.dtypes)['id']}, n_words bigint, n_removed bigint, "
                 "spans array<struct<low:bigint,high:bigint>>, kept string")
