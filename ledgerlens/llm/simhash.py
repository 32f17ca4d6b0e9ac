"""SimHash near-duplicates by tiled exact comparison.

A text's fingerprint has a bit set where more than half of the hashes of its word shingles have it.
Distinct fingerprints are put in cells by the population counts of their upper and lower half; two
fingerprints that differ in at most ``radius`` bits lie in cells whose counts differ by at most
``radius`` in sum, so all other pairs of cells are skipped. Large cells are cut into tiles of a few
ten thousand fingerprints, and each pair of tiles is compared whole with numpy's exclusive-or and
bit counts. A pair of tiles emits a spanning forest of its links, at most one edge a fingerprint, so
large groups don't multiply.

Defined results: a missing or blank text has no words and the fingerprint zero, and zeros link like
any others; a text of fewer words than a shingle is one shingle; repeated rows and ids count once
for a group and get its id each; an empty table gives an empty result. A null id never becomes a
group's id unless the group has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.components import connected_components
from ledgerlens.llm.text import whole
from ledgerlens.plans.staging import stage

SHINGLE, RADIUS, SEED = 4, 4, 42
TILE = 32_768
#: Hashes whose bits are counted at once, and comparisons done at once: both bound memory.
COUNTED, COMPARED = 65_536, 1 << 21
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of UTF-8 text as an unsigned 64-bit number."""
    import xxhash

    found = text.translate(_LOWER).split()  # bytes split at the six ASCII white spaces
    if not found:
        return 0
    joined, size = b" ".join(found), min(shingle, len(found))
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(found) - size + 1].tolist()
    ends = ends[size - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), COUNTED):
        hashes = np.array([digest(joined[s:e], SEED) for s, e in
                           zip(starts[at:at + COUNTED], ends[at:at + COUNTED])], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, fingerprint): the unsigned number's bits as a long."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = np.array([fingerprint(t.as_py(), shingle) for t in part.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(made.view(np.int64))], ["id", "fingerprint"])

    rows = df.select(F.col(id).alias("id"), whole(text).cast("binary").alias("text"))
    return rows.mapInArrow(batches, f"id {dict(rows.dtypes)['id']}, fingerprint bigint")


def hexadecimal(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Edges that join what ``a`` and ``b`` (or ``a`` and itself) link, without cycles."""
    nodes = a if b is None else np.concatenate((a, b))
    other, shift = (a, 0) if b is None else (b, len(a))
    parent = np.arange(len(nodes))

    def roots(x: np.ndarray) -> np.ndarray:
        up = parent[x]
        while True:
            higher = parent[up]
            if np.array_equal(up, higher):
                return np.unique(up)
            up = higher

    edges = []
    step = max(1, COMPARED // max(1, len(other)))
    for at in range(0, len(a), step):
        close = np.bitwise_count(a[at:at + step, None] ^ other[None, :]) <= radius
        for i in np.flatnonzero(close.any(axis=1)).tolist():
            linked = np.flatnonzero(close[i]) + shift
            found = roots(np.append(linked, at + i))
            edges += [(int(nodes[found[0]]), int(nodes[x])) for x in found[1:]]
            parent[found[1:]] = found[0]
    return edges


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) between distinct fingerprints: the same components as all links have."""
    f = F.col("fingerprint")
    upper, lower = F.bit_count(F.shiftrightunsigned(f, 32)), F.bit_count(f.bitwiseAND(0xFFFFFFFF))
    cells = distinct.select("fingerprint", upper.cast("int").alias("upper"),
                            lower.cast("int").alias("lower"))
    sizes = cells.groupBy("upper", "lower").agg(
        F.ceil(F.count("*") / tile).cast("int").alias("n_tiles"))
    tiles = stage(
        cells.join(F.broadcast(sizes), ["upper", "lower"])  # at most 33 x 33 rows
        .withColumn("part", F.pmod(F.xxhash64("fingerprint"), "n_tiles").cast("int"))
        .groupBy("upper", "lower", "part").agg(F.collect_list("fingerprint").alias("prints")),
        "tiles")
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"))
                     for i in range(-radius, radius + 1)
                     for j in range(-radius, radius + 1) if abs(i) + abs(j) <= radius])
    here = tiles.select("upper", "lower", "part", F.col("prints").alias("a"))
    wanted = here.select("*", F.explode(near).alias("d")).select(
        "a", "upper", "lower", "part", (F.col("upper") + F.col("d.i")).alias("upper2"),
        (F.col("lower") + F.col("d.j")).alias("lower2"))
    there = tiles.select(F.col("upper").alias("upper2"), F.col("lower").alias("lower2"),
                         F.col("part").alias("part2"), F.col("prints").alias("b"))
    first = F.struct("upper", "lower", "part")
    second = F.struct(F.col("upper2").alias("upper"), F.col("lower2").alias("lower"),
                      F.col("part2").alias("part"))
    pairs = wanted.join(there, ["upper2", "lower2"]).where(first <= second).select(
        "a", F.when(first != second, F.col("b")).alias("b"))

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            edges = []
            for x, y in zip(part.column(0), part.column(1)):
                a = x.values.to_numpy().view(np.uint64)
                b = y.values.to_numpy().view(np.uint64) if y.is_valid else None
                edges += _forest(a, b, radius)
            ends = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(ends[:, k])) for k in (0, 1)], ["u", "v"])

    return pairs.mapInArrow(compare, "u bigint, v bigint")


def near_duplicate_groups(df: DataFrame, id: str = "doc_id", text: str = "text",
                          shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, fingerprint, component): component is the least id of all that links reach."""
    prints = stage(fingerprints(df, id, text, shingle), "fingerprints")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct")
    reached = stage(connected_components(links(distinct, radius)), "reached")
    labelled = distinct.join(reached, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("label"))
    least = labelled.groupBy("label").agg(F.min("least").alias("component"))
    groups = stage(labelled.join(least, "label").select("fingerprint", "component"), "groups")
    return prints.join(groups, "fingerprint").select("id", "fingerprint", "component")


def keep_one_of_each_group(df: DataFrame, id: str = "doc_id", text: str = "text",
                           shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` whose id is its group's; rows without an id stay.

    Rows that repeat an id are one document, of which all stay or go together.
    """
    groups = near_duplicate_groups(df, id, text, shingle, radius)
    gone = groups.where(F.col("id") != F.col("component")).select(F.col("id").alias(id)).distinct()
    return df.join(gone, id, "left_anti")
