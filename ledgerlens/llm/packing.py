"""Best-fit-decreasing packing of token pieces into sequences of one capacity.

Lengths are whole numbers up to the capacity, so all that best fit needs to know of any number of
pieces is how many there are of each length. That histogram (one count a length, never more) is
packed exactly as best-fit decreasing packs the pieces one by one: longest first, each into the
tightest open bin, found in a segment tree over the remaining capacities in logarithmic time. Bins
with the same remaining capacity are interchangeable and are kept as ranges, so a step places a run
of equal pieces. The steps tell the bin and the offset of the n-th piece of each length; pieces are
numbered within their length by Spark, in salted groups.

Defined results: a missing or empty text is its closing token alone; repeated rows are packed each
for itself; texts of any length are cut into whole pieces of the capacity and a rest; an empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.text import whole
from ledgerlens.plans.staging import stage

CAPACITY, CLOSING_ID = 2048, 0
#: Words whose ids a Python worker remembers, and bytes of a word worth remembering.
REMEMBERED, MEMORABLE = 1_000_000, 64
#: New words that are encoded as one text.
TOGETHER = 500
#: Bytes of texts that are split together, and words whose ids are put together at once.
SPLIT, GATHERED = 16_000_000, 1_000_000
#: Words that are letters in every version of Unicode.
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+$"
_CLOSING, _ALNUM = ".,;:!?|%&*#$", np.zeros(256, bool)
_ALNUM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
#: Pieces that one numbering group holds on average, and groups a length at least.
NUMBERED, SALTS = 500_000, 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _spans(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The positions of spans of ``n`` from ``starts``, one span after the other."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + n, n)


class WordIds:
    """Ids of texts under a tokenizer that never looks across ASCII white space.

    Arrow splits many texts and numbers their words, so each different word is looked up once, in
    the words remembered, and no step but the tokenizer's goes word by word. The
    closing punctuation is split off where the tokenizer does so too (behind an ASCII letter or
    digit), and ASCII capitals are lowered as the tokenizer lowers them. What is letters only is
    encoded many words at once and cut behind the tokens that end a word.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())  # the n-th one has the next self.n[n] of self.ids
        self.ids, self.n = np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _encode(self, new: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Some words in another order, their ids, and the number of ids of each."""
        plain = pc.match_substring_regex(new, LETTERS)
        letters, other = new.filter(plain), new.filter(pc.invert(plain)).to_pylist()
        words, joined, counts = [], [], []
        runs = [letters[i:i + TOGETHER] for i in range(0, len(letters), TOGETHER)]
        texts = [" ".join(run.to_pylist()) for run in runs]
        encode = self.tokenizer.encode_batch_fast
        for run, coded in zip(runs, encode(texts, add_special_tokens=False)):
            ids = np.array(coded.ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(run):
                other += run.to_pylist()
                continue
            words.append(run)
            joined.append(ids)
            counts.append(np.diff(ends, prepend=0))
        coded = [np.array(c.ids, "<u4") for c in encode(other, add_special_tokens=False)]
        words.append(pa.array(other, pa.string()))
        counts.append(np.fromiter(map(len, coded), np.int64, len(coded)))
        return (pa.concat_arrays(words), np.concatenate([*joined, *coded, self.ids[:0]]),
                np.concatenate(counts))

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, joined, and the number of ids of each."""
        whole = pc.binary_length(words).to_numpy()
        core = pc.ascii_rtrim(words, characters=_CLOSING)
        size = pc.binary_length(core).to_numpy()
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        starts = np.frombuffer(words.buffers()[1], np.int32)[words.offset:][:len(words)] + size
        special = pc.match_substring(words, "<")  # may hold a special token
        cut = (size > 0) & ~special.to_numpy(zero_copy_only=False)
        cut[cut] = _ALNUM[data[starts[cut] - 1]]
        core = pc.if_else(pa.array(cut), core, words)
        core = pc.if_else(special, core, pc.ascii_lower(core))
        size = np.where(cut, whole - size, 0)
        tail = pa.StringArray.from_buffers(
            len(words), pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32)),
            pa.py_buffer(data[_spans(starts, size)]))
        part = pa.concat_arrays([core, tail]).dictionary_encode()
        wanted = part.dictionary
        if len(self.known) > REMEMBERED:
            self._forget()
        new = wanted.filter(pc.is_null(pc.index_in(wanted, self.known)))
        short = pc.less_equal(pc.binary_length(new), MEMORABLE)
        for some, keep in ((new.filter(short), True), (new.filter(pc.invert(short)), False)):
            fresh, ids, n = self._encode(some)
            known = pa.concat_arrays([self.known if keep else known, fresh])
            joined = np.concatenate([self.ids if keep else joined, ids])
            counts = np.concatenate([self.n if keep else counts, n])
            if keep:
                self.known, self.ids, self.n = known, joined, counts
        # each word is its core, then its tail
        at = pc.index_in(wanted, known).to_numpy()[part.indices.to_numpy()]
        at = at.reshape(2, -1).T.ravel()
        n = counts[at]
        return joined[_spans((np.cumsum(counts) - counts)[at], n)], n.reshape(-1, 2).sum(axis=1)

    def __call__(self, texts: pa.Array) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each UTF-8 text, without special tokens."""
        split = pc.ascii_split_whitespace(texts.cast(pa.string()))
        coded = split.flatten().dictionary_encode()
        vocabulary, n = self._of_words(coded.dictionary)
        starts, word = np.cumsum(n) - n, coded.indices.to_numpy()
        bounds = split.offsets.to_numpy()
        for at, upto in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            found = []
            for some in range(at, upto, GATHERED):
                w = word[some:min(upto, some + GATHERED)]
                found.append(vocabulary[_spans(starts[w], n[w])].tobytes())
            yield b"".join(found)


def word_ids(path: str) -> WordIds:
    """One coder for all tasks that a Python worker runs, with the words it remembers."""
    import sys
    import types

    kept = sys.modules.setdefault("_word_ids_of_worker", types.ModuleType("_word_ids_of_worker"))
    if path not in kept.__dict__:
        kept.__dict__[path] = WordIds(path)
    return kept.__dict__[path]


def runs(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``SPLIT`` bytes, a longer text being a slice of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + SPLIT, side="right")))
        yield texts.slice(at, upto - at)
        at = upto


def pieces(df: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
           capacity: int = CAPACITY, closing: int = CLOSING_ID, ids: bool = False) -> DataFrame:
    """(id, piece, start, length, crc32) of every piece; with ``ids`` also its token ids."""
    path = tokenizer or default_tokenizer()
    names = ["id", "piece", "start", "length", "crc32"] + ["ids"] * ids

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = word_ids(path), np.array([closing], "<u4").tobytes()
        for part in parts:
            row, cut = [], []
            texts = (t for run in runs(part.column(1)) for t in coder(run))
            for i, t in enumerate(texts):
                coded = t + end
                for k, at in enumerate(range(0, len(coded), 4 * capacity)):
                    row.append(i)
                    cut.append((k, k * capacity, coded[at:at + 4 * capacity]))
            columns = [part.column(0).take(pa.array(row, pa.int64())),
                       pa.array([c[0] for c in cut], pa.int32()),
                       pa.array([c[1] for c in cut], pa.int64()),
                       pa.array([len(c[2]) // 4 for c in cut], pa.int64()),
                       pa.array([zlib.crc32(c[2]) for c in cut], pa.int64())]
            if ids:
                columns.append(pa.array([np.frombuffer(c[2], "<u4").astype(np.int32) for c in cut],
                                        pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = df.select(F.col(id).alias("id"), whole(text).cast("binary").alias("text"))
    schema = f"id {dict(rows.dtypes)['id']}, piece int, start bigint, length bigint, crc32 bigint"
    return rows.mapInArrow(batches, schema + (", ids array<int>" if ids else ""))


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity with ranges of open bins at the leaves."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.some = [False] * (2 * self.width)
        self.bins: list[deque[tuple[int, int]]] = [deque() for _ in range(capacity + 1)]

    def _mark(self, remaining: int) -> None:
        i, some = remaining + self.width, bool(self.bins[remaining])
        while i and self.some[i] != some:
            self.some[i] = some
            i //= 2
            some = self.some[2 * i] or self.some[2 * i + 1] if i else some

    def put(self, remaining: int, first: int, count: int) -> None:
        if count and remaining:
            self.bins[remaining].append((first, count))
            self._mark(remaining)

    def take(self, remaining: int) -> tuple[int, int]:
        found = self.bins[remaining].popleft()
        self._mark(remaining)
        return found

    def tightest(self, least: int) -> int | None:
        """The smallest remaining capacity of an open bin that is ``least`` or more."""
        i = least + self.width
        if self.some[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                i += 1
                while i < self.width:
                    i = 2 * i if self.some[2 * i] else 2 * i + 1
                return i - self.width
            i //= 2
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Steps (length, first, bin, per_bin, offset), in order of length and first.

    The pieces of a length numbered from ``first`` to the next step's go to bins from ``bin`` on,
    ``per_bin`` to each, behind ``offset`` tokens.
    """
    tree, steps, fresh = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        done, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                room, (first, bins) = capacity, (fresh, -(-left // (capacity // length)))
                fresh += bins
            else:
                first, bins = tree.take(room)
            fit = room // length  # the bin just used stays the tightest while a piece fits
            full = min(bins, left // fit)
            offset = capacity - room
            if full:
                steps.append((length, done, first, fit, offset))
                tree.put(room - fit * length, first, full)
                done, left = done + full * fit, left - full * fit
            elif left:
                steps.append((length, done, first, left, offset))
                tree.put(room - left * length, first, 1)
                full, done, left = 1, done + left, 0
            if full < bins:
                if room == capacity and left:  # the last new bin takes the rest
                    steps.append((length, done, first + full, left, 0))
                    tree.put(capacity - left * length, first + full, 1)
                    left = 0
                else:
                    tree.bins[room].appendleft((first + full, bins - full))
                    tree._mark(room)
    return np.array(sorted(steps), np.int64).reshape(-1, 5)


def numbered(pieces: DataFrame, salts: int) -> DataFrame:
    """Add ``number``, from 0 within each length.

    Pieces of a length are dealt over ``salts`` groups, numbered in each, and moved behind the
    groups before them, so a length that a third of all pieces have still goes to many tasks.
    """
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(salts)))
    within = Window.partitionBy("length", "salt").orderBy("id", "piece")
    groups = salted.groupBy("length", "salt").count()
    earlier = Window.partitionBy("length").orderBy("salt").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = groups.select("length", "salt", F.coalesce(
        F.sum("count").over(earlier), F.lit(0)).alias("behind"))
    return (salted.withColumn("number", F.row_number().over(within) - 1)
            .join(offsets, ["length", "salt"])
            .withColumn("number", F.col("number") + F.col("behind")).drop("salt", "behind"))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows (id, piece, ..., length)."""
    pieces = stage(pieces, "pieces")
    counts = dict(pieces.groupBy("length").count().collect())  # at most one row a length
    steps = plan(counts, capacity)
    salts = max(SALTS, sum(counts.values()) // (NUMBERED * max(1, len(counts))))
    width = max(counts.values(), default=0) + 1
    begins = steps[:, 0] * width + steps[:, 1]

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            length = part.column("length").to_numpy()
            number = part.column("number").to_numpy()
            step = steps[np.searchsorted(begins, length * width + number, side="right") - 1]
            ahead = number - step[:, 1]
            kept = part.drop_columns(["number"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(step[:, 2] + ahead // step[:, 3]),
                 pa.array(step[:, 4] + ahead % step[:, 3] * length)],
                [*kept.schema.names, "sequence_id", "offset"])

    rows = numbered(pieces, salts)
    schema = ", ".join(f"`{k}` {v}" for k, v in rows.drop("number").dtypes)
    return rows.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")
