"""Quality scores by a regularised quadratic discriminant over statistics of a text.

Each text is reduced to a few transformed statistics in one pass. Counts, sums and products of the
labelled ones give each class's mean and covariance (every labelled row counts; what is gathered is
one small matrix a class). Covariances are shrunk towards the pooled one and towards a multiple of
the identity, and factored once by Cholesky; a score compares the classes' log densities, that is
their Mahalanobis distances and log determinants, and is squashed to 0..1.

Defined results: a missing text is empty and is scored like any other; rows without a label, or
whose label is neither 0 nor 1, are not learned from; if a class has no rows, every text scores the
share of label 1 among those learned from (0.5 if there are none); repeated rows are scored each for
itself; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import anchors
from ledgerlens.llm.text import whole
from ledgerlens.plans.staging import stage

FEATURES = ("words", "word_length", "symbols", "capitals", "marks", "bars", "digits", "breaks",
            "variety", "repeats", "neighbours")
#: Shares of the pooled covariance and of its mean variance in each class's covariance.
POOLED, ROUND = 0.1, 0.01

_KIND = np.zeros((5, 256), bool)
_KIND[0, list(b"#*$%&<>^~@{}[]\\=+_")] = True
_KIND[1, 65:91] = True
_KIND[2, list(b"!?")] = True
_KIND[3, list(b"|")] = True
_KIND[4, 48:58] = True


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def statistics(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of transformed statistics for each text of a batch of UTF-8 bytes."""
    start, end, first, last = anchors.word_ranges(values, offsets)
    hashes, _, _ = anchors.word_symbols(values, offsets)
    n = last - first
    some = np.maximum(n, 1)
    owner = np.repeat(np.arange(len(n)), n)
    letters = _per_text((values & 0xC0) != 0x80, offsets)  # one for each code point
    length = np.bincount(owner, weights=end - start, minlength=len(n))
    order = np.lexsort((hashes, owner))
    new = np.ones(len(order), bool)
    same_text = owner[1:] == owner[:-1]
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][new], minlength=len(n))
    pairs = hashes[:-1] * np.uint64(3) + hashes[1:]
    pair_owner = owner[1:][same_text]
    pairs = pairs[same_text]
    order = np.lexsort((pairs, pair_owner))
    new_pair = np.ones(len(order), bool)
    new_pair[1:] = (pairs[order][1:] != pairs[order][:-1]) | (
        pair_owner[order][1:] != pair_owner[order][:-1])
    distinct_pairs = np.bincount(pair_owner[order][new_pair], minlength=len(n))
    twice = np.bincount(owner[1:][same_text & (hashes[1:] == hashes[:-1])], minlength=len(n))
    kinds = [_per_text(k[values], offsets) for k in _KIND]
    breaks = _per_text(values == 10, offsets)
    share = [np.sqrt(k / np.maximum(letters, 1)) for k in kinds]
    return np.column_stack([
        np.log1p(n), np.log1p(length / some), *share, np.sqrt(breaks / some),
        np.log1p(distinct) / np.log1p(some), np.sqrt(1 - distinct_pairs / np.maximum(n - 1, 1)) * (
            n > 1), np.sqrt(twice / some)])


def text_statistics(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, x): ``x`` holds the statistics named in ``FEATURES``."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [statistics(values, offsets) for _, values, offsets in
                    anchors.symbol_batches(part.column(1), lambda v, o: (v, o))]
            found = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), flat.cast(pa.list_(pa.float64()))], ["id", "x"])

    rows = df.select(F.col(id).alias("id"), whole(text).cast("binary").alias("text"))
    return rows.mapInArrow(batches, f"id {dict(rows.dtypes)['id']}, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    share: float
    means: tuple[np.ndarray, np.ndarray] | None = None
    #: Inverses of the lower Cholesky factors, and log determinants of the covariances.
    whiten: tuple[np.ndarray, np.ndarray] | None = None
    log_det: tuple[float, float] | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        density = [-0.5 * (((x - m) @ w.T) ** 2).sum(axis=1) - 0.5 * d
                   for m, w, d in zip(self.means, self.whiten, self.log_det)]
        odds = (density[1] - density[0] + np.log(self.share / (1 - self.share))) / x.shape[1]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit(labelled: DataFrame, pooled: float = POOLED, rounded: float = ROUND) -> Discriminant:
    """Learn from rows (x, label). Sums are combined within each task before they are gathered."""
    d = len(FEATURES)

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for part in parts:
            x = part.column(0).values.to_numpy().reshape(-1, d)
            label = part.column(1).to_numpy()
            for c in (0, 1):
                own = x[label == c]
                total[c] += np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1]), pa.array(total.tolist(), pa.list_(pa.float64()))], ["label", "sums"])

    rows = labelled.where("label in (0, 1)").select("x", F.col("label").cast("int"))
    parts = rows.mapInArrow(sums, "label bigint, sums array<double>")
    found = (parts.select("label", F.posexplode("sums")).groupBy("label", "pos")
             .agg(F.sum("col").alias("s")).collect())  # 2 (1 + d + d d) numbers
    total = np.zeros((2, 1 + d + d * d))
    for r in found:
        total[r.label, r.pos] = r.s
    n = total[:, 0]
    if n.min() < 1:
        return Discriminant(n[1] / n.sum() if n.sum() else 0.5)
    means = [t[1:1 + d] / t[0] for t in total]
    own = [t[1 + d:].reshape(d, d) / t[0] - np.outer(m, m) for t, m in zip(total, means)]
    together = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    floor = np.eye(d) * (np.trace(together) / d + 1e-9)
    whiten, log_det = [], []
    for c in own:
        factor = np.linalg.cholesky(
            (1 - pooled - rounded) * c + pooled * together + rounded * floor)
        whiten.append(np.linalg.inv(factor))
        log_det.append(2 * np.log(np.diag(factor)).sum())
    return Discriminant(n[1] / n.sum(), tuple(means), tuple(whiten), tuple(log_det))


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_quality(df: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
                  label: str = "quality") -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``df``.

    The labels of rows that are held out by their id are never read into the model.
    """
    x = stage(text_statistics(df, id, text), "statistics")
    known = labels.select(F.col(id).alias("id"), F.col(label).alias("label")).where(
        ~held_out(F.col("id")))
    model = fit(x.join(known, "id"))

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = model.scores(part.column(1).values.to_numpy().reshape(-1, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["id", "score"])

    scores = x.mapInArrow(scored, f"id {dict(x.dtypes)['id']}, score double")
    return scores.select("id", held_out(F.col("id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
