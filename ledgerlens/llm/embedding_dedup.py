"""Near-duplicate vectors by cosine, found in a random-projection tree that parts no linked pair.

Equal vectors are made one first, with their number. A tree splits a bounded sample again and again
along a random direction (between two of the node's vectors), where the middle half of them lies
thinnest. Two linked unit vectors are at most sqrt(2 - 2 cosine) apart, along any direction too, so
vectors within half of that of a split go to both sides, and every linked pair stays together on one
side at least. Of several trees the one with the fewest pairs in its leaves is used, and every vector
goes down it. Leaves that are still too large for one task are split further in rounds over their own
vectors. Where all splits tried would put too many vectors on both sides, a leaf is compared whole,
in pairs of chunks. Within leaves all pairs are compared; what single precision leaves open is
decided in double precision. A pair that shares several leaves counts in the first of them only, so a
leaf returns a count for each vector and a spanning forest of its links, never the links themselves.

All links are found, and only links. The work of a leaf that does not split grows with the square of
its vectors, as it must where a group's cosines lie on both sides of the threshold. Defined
results: a vector that is null, empty or zero, or holds null or non-finite components, has no links
and is its own component; vectors of different lengths don't link; a row without an id has no links
and no component and is kept; repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.components import connected_components
from ledgerlens.plans.staging import drop_staged, stage

COSINE, TREES, LEAF, SPILL, SEED = 0.95, 8, 512, 0.06, 5
#: Bounds of the sample that trees are fitted on: vectors, bytes; and of a leaf in it.
SAMPLE, SAMPLE_BYTES, SAMPLE_LEAF = 20_000, 32_000_000, 24
#: Rounds that split leaves further, planes tried at a node, bytes of vectors in a chunk of a leaf.
ROUNDS, TRIES, CHUNK_BYTES = 48, 6, 8_000_000
CLOSE = 1e-12
#: Among these shares of a node's rows the split is looked for.
QUANTILES = np.linspace(0.25, 0.75, 26)


def _reach(cosine: float) -> float:
    """How far apart linked unit vectors can be, with room for rounding."""
    return float(np.sqrt(2 * max(0.0, 1 - cosine + CLOSE))) + 1e-9


def _vectors(df: DataFrame, id: str, embedding: str) -> DataFrame:
    """(id, vec): the components as bytes of doubles; null for vectors that link with nothing."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = []
            for x in part.column(1):
                v = x.values.to_numpy(zero_copy_only=False).astype("<f8") if x.is_valid else None
                good = v is not None and len(v) and np.isfinite(v).all() and v.any()
                made.append(v.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())],
                                             ["id", "vec"])

    rows = df.select(F.col(id).alias("id"), F.col(embedding).cast("array<double>").alias("vec"))
    return rows.mapInArrow(batches, f"id {dict(rows.dtypes)['id']}, vec binary")


def unit_rows(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of norm 1."""
    found = np.array([np.frombuffer(v.as_buffer(), "<f8") for v in vectors])
    found = found / np.abs(found).max(axis=1, keepdims=True)  # keeps squares finite
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _margins(projected: np.ndarray, reach: float) -> tuple[float, float]:
    """``reach`` around the place in the middle half with the fewest rows that near."""
    cuts = np.quantile(projected, QUANTILES)
    places = (cuts[1:] + cuts[:-1]) / 2
    ordered = np.sort(projected)
    low, high = places - reach / 2, places + reach / 2
    best = (np.searchsorted(ordered, high, "right") - np.searchsorted(ordered, low)).argmin()
    return float(low[best]), float(high[best])


class Tree:
    """Splits of one tree: rows up to ``high`` go left, rows from ``low`` on go right.

    A child is the number of a node, or -1 for a leaf, or -2 for one that no plane tried splits with
    at most twice ``spill`` of its rows on both sides. ``pairs`` is the work in all leaves.
    """

    def __init__(self, sample: np.ndarray, leaf: int, spill: float, cosine: float,
                 rng: np.random.Generator):
        self.planes, self.margins, self.children = [], [], []
        self.reach, self.pairs = _reach(cosine), 0
        self.root = self._grow(sample, np.arange(len(sample)), leaf, spill, rng)

    def _grow(self, sample, rows, leaf, spill, rng) -> int:
        if len(rows) > leaf:
            for _ in range(TRIES):
                a, b = rng.choice(rows, 2, replace=False)
                plane = sample[a] - sample[b]
                length = np.linalg.norm(plane)
                if not length:
                    continue
                plane = plane / length
                projected = sample[rows] @ plane
                low, high = _margins(projected, self.reach)
                left, right = rows[projected <= high], rows[projected >= low]
                if (len(left) + len(right) <= (1 + 2 * spill) * len(rows)
                        and max(len(left), len(right)) < 0.9 * len(rows)):
                    at = len(self.planes)
                    self.planes.append(plane)
                    self.margins.append((low, high))
                    self.children.append([-1, -1])
                    self.children[at] = [self._grow(sample, side, leaf, spill, rng)
                                         for side in (left, right)]
                    return at
        self.pairs += len(rows) ** 2
        return -2 if len(rows) > leaf else -1

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf number) of all rows; a row has several leaves where it is near a split.

        Numbers of leaves that don't split are negative.
        """
        if not self.planes:
            return np.arange(len(rows)), np.full(len(rows), -1 if self.root == -2 else 0)
        found, todo = [], [(0, np.arange(len(rows)))]
        while todo:
            at, own = todo.pop()
            projected = rows[own] @ self.planes[at]
            low, high = self.margins[at]
            for side, part in enumerate((own[projected <= high], own[projected >= low])):
                child = self.children[at][side]
                if child >= 0:
                    todo.append((child, part))
                else:
                    number = 2 * at + side
                    found.append((part, np.full(len(part), number if child == -1 else -1 - number)))
        return tuple(np.concatenate(x) for x in zip(*found))


def _first_leaves(distinct: DataFrame, lengths: list, trees: int, leaf: int, spill: float,
                  cosine: float, seed: int) -> DataFrame:
    """(node, leaf, final) by the best of the trees fitted on a sample of each length's vectors."""
    best: dict[int, Tree] = {}
    for size, n in lengths:
        most = max(1, min(SAMPLE, SAMPLE_BYTES // size))
        every = -(-n // most)
        sample = np.zeros((0, 1))
        if n > leaf:
            picked = distinct.where((F.col("size") == size) & (
                F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(every)) == 0))
            found = [bytes(r.vec) for r in picked.select("vec").limit(2 * most).collect()]
            sample = unit_rows(pa.array(found, pa.binary())) if found else sample
        stop = max(SAMPLE_LEAF, leaf * len(sample) // n)
        best[size] = min((Tree(sample, stop, spill, cosine, np.random.default_rng([seed, size, t]))
                          for t in range(max(1, trees) if n > leaf else 1)), key=lambda t: t.pairs)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            node, sizes = part.column(0).to_numpy(), part.column(1).to_numpy()
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                row, number = best[int(size)].leaves(unit_rows(part.column(2).take(pa.array(own))))
                code = (int(size) << 32) + np.where(number < 0, -1 - number, number)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[own[row]]), pa.array(code), pa.array(number < 0)],
                    ["node", "leaf", "final"])

    placed = distinct.select("node", "size", "vec").mapInArrow(
        batches, "node bigint, leaf bigint, final boolean")
    return placed.select("node", F.xxhash64("leaf").alias("leaf"), "final")


def _split_further(distinct: DataFrame, placed: DataFrame, leaf: int, spill: float, cosine: float,
                   rounds: int) -> tuple[DataFrame, DataFrame]:
    """(placed, sizes): no leaf above twice ``leaf`` but those that no longer split."""

    def projected(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            v, a, b = (unit_rows(part.column(k)) for k in (2, 3, 4))
            plane = a - b
            length = np.linalg.norm(plane, axis=1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array((v * plane).sum(axis=1) / np.where(length > 0, length, 1))],
                ["node", "leaf", "at"])

    reach = _reach(cosine)
    grid = np.linspace(0, 1, 101)
    done = placed.where("final").select("node", "leaf")
    placed = placed.where("not final").select("node", "leaf")
    for turn in range(rounds):
        sizes = placed.groupBy("leaf").agg(F.count("*").alias("n"))
        large = stage(sizes.where(F.col("n") > 2 * leaf), "large")
        if large.isEmpty():
            break
        done = done.union(placed.join(large.select("leaf"), "leaf", "left_anti")
                          .select("node", "leaf"))
        rows = (placed.join(large.select("leaf"), "leaf").join(distinct.select("node", "vec"), "node"))
        order = F.xxhash64("node", F.lit(turn))
        ends = rows.groupBy("leaf").agg(F.min_by("vec", order).alias("a"),
                                        F.max_by("vec", order).alias("b"))
        where = stage(rows.join(ends, "leaf").select("node", "leaf", "vec", "a", "b").mapInArrow(
            projected, "node bigint, leaf bigint, at double"), "projected")
        cuts = where.groupBy("leaf").agg(
            F.percentile_approx("at", grid.tolist(), 1000).alias("q"))
        places = F.transform(F.sequence(F.lit(25), F.lit(74)), lambda i: (
            F.get("q", i) + F.get("q", i + 1)) / 2)
        cuts = cuts.withColumn("cut", F.array_min(F.transform(places, lambda t: F.struct(
            F.size(F.filter("q", lambda x: F.abs(x - t) <= reach / 2)).alias("both"),
            t.alias("place"))))).select(
            "leaf", (F.col("cut.place") - reach / 2).alias("low"),
            (F.col("cut.place") + reach / 2).alias("high"),
            (F.col("cut.both") > 2 * spill * len(grid)).alias("final"))
        cut = where.join(cuts, "leaf")
        sides = cut.where("not final").select("node", F.explode(F.array_compact(F.array(
            F.when(F.col("at") <= F.col("high"), F.xxhash64("leaf", F.lit(0))),
            F.when(F.col("at") >= F.col("low"), F.xxhash64("leaf", F.lit(1)))))).alias("leaf"))
        done = stage(done.union(cut.where("final").select("node", "leaf")), "placed")
        placed = stage(sides, "placed")
        drop_staged(where)
    out = done.union(placed)
    return out, out.groupBy("leaf").agg(F.count("*").alias("n"))


def _compared(cosine: float):
    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        leaf, i, j = (rows.column(c)[0].as_py() for c in ("leaf", "i", "j"))
        x = unit_rows(rows.column("vec"))
        node, n, chunk = (rows.column(c).to_numpy() for c in ("node", "n", "chunk"))
        mine = rows.column("leaves").to_pylist()
        width = max(map(len, mine))
        leaves = np.array([sorted(m) + [m[0]] * (width - len(m)) for m in mine])
        own = np.array([len(m) for m in mine])
        counts, parent, edges = np.zeros(len(node), np.int64), np.arange(len(node)), []

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        def roots() -> np.ndarray:
            up = parent
            while (up[up] != up).any():
                up = up[up]
            return up

        single = x.astype(np.float32)
        slack = (x.shape[1] + 8) * 2.0 ** -22
        first, second = (np.flatnonzero(chunk == c) for c in (i, j))
        step = max(1, (1 << 22) // len(second)) if len(second) else 1
        for at in range(0, len(first), step):
            block, others = first[at:at + step], second[at:] if i == j else second
            near = single[block] @ single[others].T
            p, q = np.nonzero(near >= cosine - slack)
            close = near[p, q] < cosine + slack
            p, q = block[p], others[q]
            good = ~close
            if i == j:
                good &= p < q
                close &= p < q
            for some in np.array_split(np.flatnonzero(close), close.sum() // (1 << 14) + 1):
                good[some] = (x[p[some]] * x[q[some]]).sum(axis=1) >= cosine - CLOSE
            p, q = p[good], q[good]
            piece = 1 << 18 if width == 1 else 1 << 14
            for low in range(0, len(p), piece):
                a, b = p[low:low + piece], q[low:low + piece]
                if width == 1:
                    u, v = a, b
                else:
                    shared = (leaves[a][:, :, None] == leaves[b][:, None, :]).any(axis=2)
                    shared &= np.arange(width) < own[a][:, None]
                    here = leaves[a, shared.argmax(axis=1)] == leaf
                    u, v = a[here], b[here]
                np.add.at(counts, u, n[v])
                np.add.at(counts, v, n[u])
                up = roots()
                a, b = up[a], up[b]
                apart = np.unique(a[a != b] * len(node) + b[a != b])
                for u, v in zip((apart // len(node)).tolist(), (apart % len(node)).tolist()):
                    u, v = root(u), root(v)
                    if u != v:
                        parent[max(u, v)] = min(u, v)
                        edges.append((node[u], node[v]))
        some = np.flatnonzero(counts)
        ends = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({
            "u": np.concatenate((node[some], ends[:, 0])),
            "v": pa.array([None] * len(some) + ends[:, 1].tolist(), pa.int64()),
            "links": pa.array(counts[some].tolist() + [None] * len(ends), pa.int64())})

    return compare


def near_duplicate_vectors(df: DataFrame, id: str = "vec_id", embedding: str = "embedding",
                           cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF,
                           spill: float = SPILL, seed: int = SEED,
                           rounds: int = ROUNDS) -> DataFrame:
    """(id, n_links, component, kept) of every row of ``df``; ids are whole numbers."""
    rows = stage(_vectors(df, id, embedding).withColumn("key", F.when(
        F.col("id").isNotNull(), F.md5("vec"))), "vectors")
    distinct = stage(rows.where("key is not null").groupBy("key").agg(
        F.min("id").cast("long").alias("node"), F.count("*").alias("n"),
        F.first("vec").alias("vec")).withColumn("size", F.length("vec")), "distinct")
    lengths = distinct.groupBy("size").agg(F.count("*").alias("n")).collect()  # few lengths exist
    placed, sizes = _split_further(
        distinct, stage(_first_leaves(distinct, lengths, trees, leaf, spill, cosine, seed), "placed"),
        leaf, spill, cosine, rounds)
    most = max(2 * leaf, CHUNK_BYTES // max((size for size, _ in lengths), default=1))
    homes = placed.groupBy("node").agg(F.collect_list("leaf").alias("leaves"))
    chunks = sizes.where("n > 1").select("leaf", F.ceil(F.col("n") / most).cast("int").alias(
        "chunks"))
    several = placed.join(chunks, "leaf").withColumn(
        "chunk", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    met = several.select("node", "leaf", "chunk", F.explode(F.sequence(
        F.lit(0), F.col("chunks") - 1)).alias("y")).select(
        "node", "leaf", "chunk", F.least("chunk", "y").alias("i"),
        F.greatest("chunk", "y").alias("j"))
    full = met.join(distinct.select("node", "n", "vec"), "node").join(homes, "node")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # few rows are much work
    full = full.repartition(parts, "leaf", "i", "j")
    found = stage(full.groupBy("leaf", "i", "j").applyInArrow(
        _compared(cosine), "u bigint, v bigint, links bigint"), "links")
    links = found.where("links is not null").groupBy(F.col("u").alias("node")).agg(
        F.sum("links").alias("links"))
    reached = connected_components(found.where("v is not null").select("u", "v"))
    known = stage(distinct.select("key", "node", "n").join(links, "node", "left")
                  .join(reached, "node", "left").select(
        "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "node").alias("component")), "known")
    out = rows.select("id", "key").join(known, "key", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component", F.col("id").cast("long")).alias("component"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component"), F.lit(True)))
