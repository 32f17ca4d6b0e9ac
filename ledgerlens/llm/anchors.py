"""Where a text may repeat: windows of symbols, found through anchors that their content picks.

Symbols are bytes or words. Every window of ``window`` symbols picks its anchor, the k-gram in it
with the least hash (the leftmost of equals). Equal windows pick equal anchors, so windows need to
be compared only between occurrences of the same anchor, and there is one occurrence for every few
dozen windows. An occurrence owns the run of windows that pick it; the symbols of that run are its
context. One shuffle by anchor then tells

* contexts that occur again as a whole: every window of them is repeated, and
* single contexts whose anchor has other contexts too: only these are looked at window by window.

Before the shuffle each batch decides what it can: of the occurrences of one context only one goes
on, the others are repeats already, and are dealt over all tasks. An anchor with many contexts in a
batch is dealt by context instead; all its contexts then count as having others, also where another
batch dealt them by anchor (a witness row tells), so such anchors are split and nothing is lost.

All work is vectorised over the concatenated texts of an Arrow batch, in pieces of bounded size; no
window reaches over the end of its document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

#: Contexts of one anchor in a batch from which on they are dealt by context, not by anchor.
HOT = 16
#: States of an occurrence, above bit 40 of its shape.
DECIDED, REPEATED, SPREAD, WITNESS = 1, 2, 4, 8
_STATE = 40

#: Positions hashed at once; they must fit in the bits below that are free in an anchor's hash.
PIECE, PLACE_BITS = 1 << 18, 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers_of: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    if size not in _powers_of:
        _powers_of[size] = tuple(
            np.concatenate(([np.uint64(1)], np.cumprod(np.full(size, b, np.uint64))))
            for b in (_BASE, _INVERSE))
    return _powers_of[size]


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


class RangeHashes:
    """Hashes of any ranges of a sequence of 64-bit symbols, equal for equal ranges."""

    def __init__(self, symbols: np.ndarray):
        size = 1 << max(10, int(len(symbols)).bit_length())
        up, self.down = _powers(size)
        self.sums = np.concatenate((np.zeros(1, np.uint64),
                                    np.cumsum(symbols * up[:len(symbols)], dtype=np.uint64)))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mixed((self.sums[k:] - self.sums[:n]) * self.down[:n])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    out = x
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[:len(x) - width + 1], out[width - done:])
    return out


def owned_runs(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, k: int):
    """Yield arrays (document, low, windows, place, anchor, context) of a batch of sequences.

    ``low`` is the first window's start and ``place`` the anchor's, both within the document.
    """
    total = len(symbols)
    at = int(starts[0]) if len(starts) else 0
    stop = int(ends[-1]) if len(ends) else 0
    while at + window <= stop:
        upto = min(stop, at + PIECE + window - 1)  # windows that start in [at, upto - window]
        part = symbols[at:upto]
        hashes = RangeHashes(part)
        grams = hashes.grams(k)
        keys = ((grams >> np.uint64(PLACE_BITS)) << np.uint64(PLACE_BITS)) | np.arange(
            len(grams), dtype=np.uint64)
        picked = (sliding_least(keys, window - k + 1)
                  & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        first = np.arange(len(picked))
        document = np.searchsorted(ends, first + at, side="right")
        inside = first + at + window <= ends[np.minimum(document, len(ends) - 1)]
        first, picked, document = first[inside], picked[inside], document[inside]
        if len(first):
            new = np.flatnonzero(np.concatenate(
                ([True], (picked[1:] != picked[:-1]) | (document[1:] != document[:-1])
                 | (first[1:] != first[:-1] + 1))))
            low, place, owner = first[new], picked[new], document[new]
            count = np.diff(np.append(new, len(first)))
            # where the anchor lies in the run is part of what makes contexts equal
            context = hashes(low, low + count - 1 + window) ^ mixed(
                (place - low).astype(np.uint64) + np.uint64(1))
            base = starts[owner] - at
            yield owner, low - base, count, place - base, grams[place], context
        at = upto - window + 1
    assert total >= stop


def occurrences(df: DataFrame, symbols_of: Callable, window: int, k: int,
                ordered: bool) -> DataFrame:
    """(deal, context, ..., low, shape) of ``df``, whose last column is the text as binary.

    The columns before the text are carried along; by them documents come one after another, and
    the last of them tells documents apart. ``symbols_of`` gets the bytes of a batch and its
    offsets, and gives the 64-bit symbols and where each text's symbols start and end. ``shape``
    holds the anchor's place behind ``low`` and the number of windows, see ``windows_of``.
    """
    carried = df.columns[:-1]

    def decided(anchor, context, owner, document, key, low, shape):
        """Rows of one batch in an order by context, with their deal and state."""
        # by document, not by owner: places of repeated rows must come side by side
        order = np.lexsort((low, document, context, anchor))
        anchor, context, owner, key, low, shape = (
            x[order] for x in (anchor, context, owner, key, low, shape))
        new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
        new = new_anchor | np.concatenate(([True], context[1:] != context[:-1]))
        other = new | np.concatenate(([True], (key[1:] != key[:-1]) | (low[1:] != low[:-1])))
        group, of_anchor = np.cumsum(new) - 1, np.cumsum(new_anchor) - 1
        state = np.where(new, 0, DECIDED)
        if not ordered:
            state[new & (np.bincount(group, weights=other)[group] > 1)] = REPEATED
        hot = np.bincount(of_anchor, weights=new)[of_anchor] >= HOT
        deal = np.where(new, np.where(hot, mixed(anchor ^ mixed(context)), anchor),
                        mixed(key ^ low.astype(np.uint64)))
        state = np.where(new & hot, state | SPREAD, state)
        shape = shape | (state << _STATE)
        witness = np.flatnonzero(new_anchor & hot)
        keep = np.concatenate((np.flatnonzero(other), witness))
        shape = np.concatenate((shape[other], np.full(len(witness), WITNESS << _STATE)))
        deal = np.concatenate((deal[other], anchor[witness]))
        return deal, np.concatenate((context[other], np.zeros(len(witness), np.uint64))), \
            owner[keep], low[keep], shape

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            part = part.take(pc.sort_indices(
                part.select(carried), sort_keys=[(c, "ascending") for c in carried],
                null_placement="at_start"))
            keys = part.column(len(carried) - 1).to_numpy().view(np.uint64)
            documents = np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1])))
            for rows, symbols, starts, ends in symbol_batches(part.column(len(carried)),
                                                              symbols_of):
                runs = list(owned_runs(symbols, starts, ends, window, k))
                if not runs:
                    continue
                owner, low, count, place, anchor, context = map(np.concatenate, zip(*runs))
                deal, context, owner, low, shape = decided(
                    anchor, context, owner, documents[owner + rows], keys[owner + rows], low,
                    ((place - low) << 16) | count)
                row = pa.array(owner + rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(deal.view(np.int64)), pa.array(context.view(np.int64)),
                     *[part.column(i).take(row) for i in range(len(carried))],
                     pa.array(low.astype(np.int64)), pa.array(shape)],
                    ["deal", "context", *carried, "low", "shape"])

    kinds = "".join(f"`{c}` {t}, " for c, t in df.dtypes[:-1])
    return df.mapInArrow(batches, f"deal bigint, context bigint, {kinds}low bigint, shape bigint")


def windows_of(shape):
    """(anchor's place behind low, number of windows) of numbers, arrays or columns."""
    if hasattr(shape, "bitwiseAND"):
        return F.shiftright(shape, 16).bitwiseAND(0xFFFF), shape.bitwiseAND(0xFFFF)
    return (shape >> 16) & 0xFFFF, shape & 0xFFFF


def runs_of(alone: DataFrame) -> DataFrame:
    """(key, runs): each run of a document once, also if its copies were dealt in several ways."""
    shape = F.col("shape").bitwiseAND(F.lit((1 << 32) - 1)).alias("shape")
    return alone.groupBy("key").agg(F.collect_set(F.struct("low", shape)).alias("runs"))


def symbol_batches(texts: pa.Array, symbols_of: Callable, size: int = 1 << 22):
    """Cut an Arrow batch of binaries in runs of whole texts of about ``size`` bytes."""
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[
        texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    values = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(
        0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, side="right")) - 1)
        chunk = values[offsets[row]:offsets[end]]
        yield (row, *symbols_of(chunk, offsets[row:end + 1] - offsets[row]))
        row = end


def byte_symbols(values: np.ndarray, offsets: np.ndarray):
    return BYTE_VALUES[values], offsets[:-1], offsets[1:]


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_ranges(values: np.ndarray, offsets: np.ndarray):
    """Byte ranges of all words of a batch, and where each text's words start and end."""
    inside = ~_SPACE[values]
    cut = np.zeros(len(values) + 1, bool)
    cut[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return start, end, np.searchsorted(start, offsets[:-1]), np.searchsorted(start, offsets[1:])


#: Bytes of a word from which on it is hashed by itself.
LONG_WORD = 256


def word_symbols(values: np.ndarray, offsets: np.ndarray):
    start, end, first, last = word_ranges(values, offsets)
    symbols = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):  # in pieces, since the table of powers is as long as a piece
        upto = int(np.searchsorted(end, start[at] + PIECE, side="right"))
        upto = max(upto, at + 1)
        low = start[at]
        hashes = RangeHashes(BYTE_VALUES[values[low:end[upto - 1]]])
        symbols[at:upto] = hashes(start[at:upto] - low, end[at:upto] - low)
        at = upto
    # sums of powers modulo 2^64 can't tell some texts of a thousand letters and more apart
    for i in np.flatnonzero(end - start > LONG_WORD):
        symbols[i] = xxh64_intdigest(values[start[i]:end[i]].tobytes())
    return symbols, first, last


def marked(occurrences: DataFrame, ordered: bool) -> DataFrame:
    """Occurrences that matter: (..., low, shape, whole, alone).

    ``whole``: all windows of the occurrence are repeats; with ``ordered`` that spares the first
    occurrence of each context. ``alone``: the occurrence stands for its context among several
    contexts of its anchor. A document that comes twice counts once. Rows are sorted within their
    shuffled partition and pass once, batch by batch; only the rows of one anchor that a batch has
    cut are carried over.
    """
    order = occurrences.columns[2:-2]
    rows = occurrences.repartition("deal").sortWithinPartitions(
        "deal", "context", *[F.col(c).asc_nulls_first() for c in order], "low")
    names = [*order, "low", "shape"]

    def flags(table: pa.Table) -> pa.RecordBatch:
        deal, context, key, low, shape = (table.column(c).to_numpy()
                                          for c in ("deal", "context", order[-1], "low", "shape"))
        state = shape >> _STATE
        decided = state == DECIDED
        new_deal = np.concatenate(([True], deal[1:] != deal[:-1]))
        new = new_deal | np.concatenate(([True], context[1:] != context[:-1]))
        other = new | np.concatenate(([True], (key[1:] != key[:-1]) | (low[1:] != low[:-1])))
        group, of_deal = np.cumsum(new) - 1, np.cumsum(new_deal) - 1
        several = (np.bincount(group, weights=other)[group] > 1) | (
            np.bincount(group, weights=state & REPEATED)[group] > 0)
        contexts = (np.bincount(of_deal, weights=new)[of_deal] > 1) | (state & SPREAD > 0)
        whole = decided | (several & ~new if ordered else several)
        alone = new & contexts & ~decided
        keep = np.flatnonzero((whole | alone) & (other | decided) & (state != WITNESS))
        out = table.select(names).take(pa.array(keep))
        return out.append_column("whole", pa.array(whole[keep])).append_column(
            "alone", pa.array(alone[keep])).combine_chunks()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ready in whole_groups(parts, "deal", 1):
            yield from flags(ready).to_batches()

    kinds = dict(occurrences.dtypes)
    return rows.mapInArrow(batches, ", ".join(f"`{c}` {kinds[c]}" for c in names)
                           + ", whole boolean, alone boolean")


def whole_groups(parts: Iterator[pa.RecordBatch], by: str, least: int) -> Iterator[pa.Table]:
    """Tables of whole groups of sorted rows, of ``least`` rows or more but for the last."""
    carried, size = [], 0
    for part in parts:
        if not part.num_rows:
            continue
        values = part.column(by).to_numpy()
        last = int(np.searchsorted(values, values[-1]))
        if not last and carried and carried[-1].column(by)[-1].as_py() == int(values[0]):
            carried.append(part)  # all of it belongs to the group carried over
            size += part.num_rows
            continue
        if size + last >= least:
            ready = carried + ([part.slice(0, last)] if last else [])
            if ready:
                yield pa.Table.from_batches(ready)
            carried, size = [], 0
            part = part.slice(last)
        carried.append(part)
        size += part.num_rows
    if carried:
        yield pa.Table.from_batches(carried)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as maximal runs (ranges that touch are one)."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return starts[new], reach[np.append(new[1:], len(starts)) - 1]
