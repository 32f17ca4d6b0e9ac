"""Suffix arrays by linear grouping, and the removal of byte strings that occur earlier.

``suffix_array`` sorts suffixes in two passes. The first one groups them by their longest Lyndon
prefix: groups are taken in descending order, each member points to the nearest suffix before it
that lies in a lower group, and the suffixes pointed to move to the upper end of their own groups,
those pointed to most often last. The second pass goes through the suffixes in ascending order and
emits the order within each group, following the same pointers. Nothing is renamed and no part is
sorted again.

``remove_earlier_strings`` finds, for every string of ``window`` bytes, whether the same string
starts earlier. Windows are spread over tasks by anchors (see ``anchors``). Where contexts of an
anchor differ, the bytes behind it and, reversed, the bytes before it are packed eight to a symbol
and put in suffix arrays; the common prefixes of neighbours there give, for every split of a window
around its anchor, the classes of equal windows.

Defined results: a missing text is empty; matches never cross documents; a document comes before
another one by its id, nulls first; rows with the same id and text are one document and get the same
result; an empty table gives an empty result; texts of any length are taken whole. The remaining
bytes need not be valid UTF-8, so they are binary.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import anchors
from ledgerlens.llm.text import whole
from ledgerlens.plans.staging import stage

WINDOW, ANCHOR = 100, 36
#: Rows of contexts that are put in suffix arrays together, unless one group has more.
TOGETHER = 20_000
#: Kinds of windows by the number of bytes before their anchor.
KINDS = 4


def lyndon_groups(symbols: Sequence[int]) -> tuple[list[int], list[int]]:
    """(group, before) of every suffix; the last symbol must be the only least one.

    A group is named by the place of its first member in the suffix array; ``before`` is the
    nearest earlier suffix that is smaller, or -1.
    """
    n = len(symbols)
    members: dict[int, list[int]] = {}
    by_symbol: dict[int, list[int]] = {}
    for i, c in enumerate(symbols):
        by_symbol.setdefault(c, []).append(i)
    group, size, begin, at = [0] * n, [0] * n, [0] * n, 0
    for c in sorted(by_symbol):
        own = by_symbol[c]
        members[at], size[at] = own, len(own)
        for i in own:
            group[i] = at
        begin[at + len(own) - 1] = at
        at += len(own)
    before, top = [-1] * n, n
    while top:
        g = begin[top - 1]
        top = g
        pointed: dict[int, int] = {}
        for s in members.pop(g):
            if group[s] != g:
                continue  # it has moved up since
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = before[p]
            before[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_count: dict[int, list[int]] = {}
        for p, times in pointed.items():
            by_count.setdefault(times, []).append(p)
        for times in sorted(by_count, reverse=True) if len(by_count) > 1 else by_count:
            by_group: dict[int, list[int]] = {}
            for p in by_count[times]:
                by_group.setdefault(group[p], []).append(p)
            for old, moved in by_group.items():
                rest = size[old] - len(moved)
                if rest:
                    new = old + rest
                    size[old], size[new], members[new] = rest, len(moved), moved
                    begin[new + len(moved) - 1], begin[new - 1] = new, old
                    for p in moved:
                        group[p] = new
    return group, before


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes in ascending order of the suffixes."""
    text = list(symbols)
    if not text:
        return []
    text.append(min(text) - 1)
    group, before = lyndon_groups(text)
    n = len(text)
    order, free, placed = [n - 1] * n, list(range(n)), [False] * n
    placed[n - 1] = True
    for i in range(n):
        s = order[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            order[free[g]] = s
            free[g] += 1
            placed[s] = True
            s = before[s]
    return order[1:]


def sorted_strings(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common) of rows of bytes, by the suffix array of the rows behind each other.

    ``common[i]`` is the number of bytes that row ``order[i]`` shares with the one before it.
    """
    rows, width = strings.shape
    packed = np.ascontiguousarray(strings).view(">u8").astype(np.uint64).reshape(rows, -1)
    ranks = np.unique(packed.ravel(), return_inverse=True)[1].ravel()
    found = np.array(suffix_array(ranks.tolist()), np.int64)
    per_row = packed.shape[1]
    order = found[found % per_row == 0] // per_row
    differ = strings[order[1:]] != strings[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.concatenate(([-1], common))


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(
        len(parts), width)


def earlier_windows(group: np.ndarray, left: list[bytes], right: list[bytes], least: np.ndarray,
                    most: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, split) of windows that an earlier row of the same group has too.

    A row is an anchor with the bytes before it (reversed) and behind it. Its windows take
    ``split`` bytes before and ``span - split`` bytes behind, from ``least`` to ``most``.
    """
    width = -(-max(8, span) // 8) * 8
    sides = []
    for strings in (left, right):
        order, common = sorted_strings(_padded(strings, width))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        sides.append((rank, common))
    (rank_l, common_l), (rank_r, common_r) = sides
    n = len(left)
    found_rows, found_splits = [], []
    for split in range(span + 1):
        rows = np.flatnonzero((least <= split) & (split <= most))
        if len(rows) < 2:
            continue
        class_l = np.cumsum(common_l < split)[rank_l[rows]]
        class_r = np.cumsum(common_r < span - split)[rank_r[rows]]
        together = np.unique((group[rows] * (n + 1) + class_r) * (n + 1) + class_l,
                             return_index=True, return_inverse=True)
        later = rows[together[1][together[2].ravel()] != np.arange(len(rows))]
        found_rows.append(later)
        found_splits.append(np.full(len(later), split))
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(found_rows or empty), np.concatenate(found_splits or empty)


def _documents(df: DataFrame, id: str, text: str) -> DataFrame:
    return df.select(F.col(id).alias("id"), F.xxhash64(F.col(id), F.col(text)).alias("key"),
                     whole(text).cast("binary").alias("text"))


def _contexts(documents: DataFrame, alone: DataFrame, window: int, k: int) -> DataFrame:
    """Contexts of the occurrences in ``alone``, cut around their anchors.

    Windows are told apart by how many of their bytes lie before the anchor, in ``KINDS`` kinds. All
    windows of a kind have the anchor and some bytes on either side in common; these name the group
    that a context's windows of the kind go to, so contexts that differ near the anchor part at once.
    """
    span = window - k
    step = -(-(span + 1) // KINDS)
    runs = anchors.runs_of(alone)
    names = ["group", "id", "key", "place", "least", "most", "left", "right"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            runs, keys, ids = part.column("runs"), part.column("key"), part.column("id")
            for i, body in enumerate(part.column("text")):
                raw, spots = body.as_py(), runs[i].values
                place, count = anchors.windows_of(spots.field("shape").to_numpy())
                low = spots.field("low").to_numpy()
                hashes = anchors.RangeHashes(
                    anchors.BYTE_VALUES[np.frombuffer(raw, np.uint8)])
                at, last, first = low + place, place, place - count + 1
                rows = []
                for fewest in range(0, span + 1, step):
                    most = min(fewest + step - 1, span)
                    f, m = np.maximum(first, fewest), np.minimum(last, most)
                    has = np.flatnonzero(f <= m)
                    if len(has):
                        a = at[has]
                        rows.append((hashes(a - fewest, a + window - most).view(np.int64), a,
                                     f[has], m[has]))
                if not rows:
                    continue
                group, a, f, m = map(np.concatenate, zip(*rows))
                left = [raw[x - y:x][::-1] for x, y in zip(a.tolist(), m.tolist())]
                right = [raw[x + k:x + window - y] for x, y in zip(a.tolist(), f.tolist())]
                row = pa.array(np.full(len(a), i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group), ids.take(row), keys.take(row), pa.array(a),
                     pa.array(f.astype(np.int32)), pa.array(m.astype(np.int32)),
                     pa.array(left, pa.binary()), pa.array(right, pa.binary())], names)

    kind = dict(documents.dtypes)["id"]
    # repeated rows are one document, so each context comes once
    joined = documents.select("key", "text", "id").join(runs, "key").dropDuplicates(["key"])
    return joined.mapInArrow(
        batches, f"group bigint, id {kind}, key bigint, place bigint, least int, most int, "
                 "left binary, right binary")


def _earlier_in_groups(contexts: DataFrame, window: int, k: int) -> DataFrame:
    rows = contexts.repartition("group").sortWithinPartitions(
        "group", F.col("id").asc_nulls_first(), "key", "place")
    span = window - k

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in anchors.whole_groups(parts, "group", TOGETHER):
            group = table.column("group").to_numpy()
            group = np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))
            shared = np.flatnonzero(np.bincount(group)[group] > 1)
            if not len(shared):
                continue
            table, group = table.take(pa.array(shared)), group[shared]
            group = np.cumsum(np.concatenate(([0], group[1:] != group[:-1])))
            row, split = earlier_windows(
                group, *(table.column(c).to_pylist() for c in ("left", "right")),
                *(table.column(c).to_numpy() for c in ("least", "most")), span)
            low = table.column("place").to_numpy()[row] - split
            yield pa.RecordBatch.from_arrays(
                [table.column("key").take(pa.array(row)).combine_chunks(), pa.array(low),
                 pa.array(low + window)], ["key", "low", "high"])

    return rows.mapInArrow(batches, "key bigint, low bigint, high bigint")


def earlier_spans(documents: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """(key, low, high): bytes low to high - 1 lie in strings that start earlier too."""
    marks = stage(anchors.marked(anchors.occurrences(
        documents.select("id", "key", "text"), anchors.byte_symbols, window, k, True), True),
        "marks")
    count = anchors.windows_of(F.col("shape"))[1]
    whole_runs = marks.where("whole").select(
        "key", "low", (F.col("low") + count + (window - 1)).alias("high"))
    return whole_runs.union(_earlier_in_groups(
        _contexts(documents, marks.where("alone"), window, k), window, k))


def remove_earlier_strings(df: DataFrame, id: str = "doc_id", text: str = "text",
                           window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """(id, n_bytes, n_removed, spans, kept) of every row of ``df``."""
    documents = _documents(df, id, text)
    spans = earlier_spans(documents, window, k).groupBy("key").agg(
        F.collect_list(F.struct("low", "high")).alias("ranges"))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ranges, made = part.column("ranges"), []
            for i, body in enumerate(part.column("text")):
                raw, cut = body.as_py(), []
                if ranges[i].is_valid:
                    spot = ranges[i].values
                    cut = list(zip(*(x.tolist() for x in anchors.merged(
                        spot.field("low").to_numpy(), spot.field("high").to_numpy()))))
                ends = [0, *(x for ab in cut for x in ab), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2])) if cut else raw
                made.append((len(raw), len(raw) - len(kept),
                             [{"low": a, "high": b} for a, b in cut], kept))
            n, gone, cut, kept = zip(*made) if made else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(cut, pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
                 pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "spans", "kept"])

    joined = documents.select("key", "text", "id").join(spans, "key", "left")
    return joined.select("id", "text", "ranges").mapInArrow(
        batches, f"id {dict(documents.dtypes)['id']}, n_bytes bigint, n_removed bigint, "
                 "spans array<struct<low:bigint,high:bigint>>, kept binary")
