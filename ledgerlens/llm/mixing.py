"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted the same, usually fractional, number of times. The whole part
is taken as it is; the fractions are rounded by the pivotal method: two documents meet, words move
at random from one to the other until one of them is taken a whole number of times, and the other
one goes on. The expected copies of each document stay what they were, and so does the sum of the
words. Documents meet in blocks of a source, the longest first, so that what a block leaves over is
a short one; these go up a reduction tree until each source has one, whose fraction is drawn.

Random numbers depend on the seed and the block only, and blocks on the documents only, so reruns
agree. Defined results: a missing text has size 0; a missing source is a source of its own, last in
order; a document of size 0 is taken 0 times; an empty table gives an empty result. Rows that share
id, source and text are one unit: the copies wanted of them are added up, only what is missing to a
whole number is rounded, and each of the rows gets an equal share, one more or less.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.text import unused, whole, words
from ledgerlens.plans.staging import stage

WEIGHTS, VOLUME, MOST, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, 17
#: Documents that meet in one block, and fractions that meet in one node of the tree, on average.
BLOCK, FAN = 10_000, 64
CLOSE = 1e-9
#: ``monotonically_increasing_id`` numbers the rows of a partition in its lower bits.
PART_BITS = 33


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, volume: float = VOLUME,
                   most: float = MOST) -> DataFrame:
    """(source, rank, source_size, target) from (source, source_size).

    Targets share ``volume`` times all sizes by weight, none above ``most`` times its source's
    size. What is cut off goes to the others by weight, which makes every target the lesser of its
    limit and weight times one common level; the sources are put in the order in which a rising
    level reaches their limits, and running sums give the level. One row a source: the windows run
    over the sources, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    filled = Window.orderBy("fills_at", "rank")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    out = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    out = out.withColumn("weight", F.get(cycle, F.col("rank") % len(weights)))
    out = out.withColumn("limit", most * F.col("source_size").cast("double"))
    out = out.withColumn("fills_at", F.col("limit") / F.col("weight"))
    wanted = volume * F.sum(F.col("source_size").cast("double")).over(every)
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    out = out.withColumn(
        "level", (wanted - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / weight_left)
    open_level = F.when(F.col("fills_at") > F.col("level"), F.col("level"))
    final = F.first(open_level, ignorenulls=True).over(
        filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = out.withColumn("target", F.least(
        F.col("limit"), F.coalesce(F.col("weight") * final, F.col("limit"))))
    return out.select("source", F.col("rank").cast("long").alias("rank"), "source_size", "target")


def pivot(fractions: Sequence[float], sizes: Sequence[int],
          rng: np.random.Generator) -> tuple[np.ndarray, int, float]:
    """Round fractions in order: (0 or 1 of each, place left open or -1, its fraction)."""
    n = len(fractions)
    taken, open_at, p, a = np.zeros(n, np.int64), -1, 0.0, 0
    for i, (q, b, u) in enumerate(zip(fractions, sizes, rng.random(n))):
        if open_at >= 0:
            gain, loss = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
            moved = gain if u * (gain + loss) < loss else -loss
            p, q = p + moved / a, q - moved / b
            if p <= CLOSE or p >= 1 - CLOSE:
                taken[open_at], open_at = p > 0.5, -1
        if q <= CLOSE or q >= 1 - CLOSE:
            taken[i] = q > 0.5
        else:
            open_at, p, a = i, q, b
    return taken, open_at, p if open_at >= 0 else 0.0


def _node(seed: int):
    """Rounds the rows of one block or node; at most one row keeps a fraction in ``open``."""

    def run(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "order"], ascending=False, kind="stable").reset_index(drop=True)
        code = [seed, *(int(k) % (1 << 32) for k in keys)]
        taken, place, held = pivot(rows["open"].tolist(), rows["size"].tolist(),
                                   np.random.default_rng(code))
        rows["extra"] = taken
        rows["open"] = np.nan
        if place >= 0:
            rows.loc[place, "open"] = held
        return rows[list(_COLUMNS)]

    return run


_COLUMNS = {"key": "binary", "rank": "bigint", "block": "bigint", "size": "bigint",
            "order": "bigint", "open": "double", "extra": "bigint"}
_SCHEMA = ", ".join(f"`{k}` {v}" for k, v in _COLUMNS.items())


def unit_key(id: str, source: str, text: str) -> Column:
    """Rows with the same key are one unit of the mix."""
    name = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit(""))
    ids = F.coalesce(F.concat(F.lit("="), F.col(id).cast("string")), F.lit(""))
    return F.unhex(F.md5(F.to_json(F.array(name, ids, F.md5(whole(text))))))


def copies(df: DataFrame, weights: Sequence[float] = WEIGHTS, volume: float = VOLUME,
           most: float = MOST, seed: int = SEED, id: str = "doc_id", source: str = "source",
           text: str = "text", block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """One row per row of ``df``: id, source, key, size, source_size, target, copies."""
    rows = stage(df.select(
        F.col(id).alias("id"), F.col(source).alias("source"),
        unit_key(id, source, text).alias("key"),
        F.size(words(text)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("row")), "sizes")
    return copies_of_rows(rows, weights, volume, most, seed, block, fan).drop("row")


def copies_of_rows(rows: DataFrame, weights: Sequence[float] = WEIGHTS, volume: float = VOLUME,
                   most: float = MOST, seed: int = SEED, block: int = BLOCK,
                   fan: int = FAN) -> DataFrame:
    """``copies``, with ``row``, of a written table (id, source, key, size, row: its number)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stage(source_targets(sizes, weights, volume, most)
                    .withColumnRenamed("source", "target_source"), "targets")
    of_source = F.col("source").eqNullSafe(F.col("target_source"))

    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    part = F.shiftright("row", PART_BITS)  # a bounded number of rows in a row, whatever they hold
    held = rows.where("size > 0").groupBy("key", part.alias("part")).agg(
        F.first("source").alias("source"), F.first("size").alias("size"), F.count("*").alias("n"))
    units = held.groupBy("key").agg(F.first("source").alias("source"),
                                    F.first("size").alias("size"), F.sum("n").alias("n"))
    units = stage(units.join(targets, of_source)
                  .withColumn("wanted", wanted * F.col("n"))
                  .withColumn("sure", F.floor("wanted"))
                  .select("key", "rank", "size", "n", "sure",
                          (F.col("wanted") - F.col("sure")).alias("open")), "units")
    fractions = units.select("key", "rank", "size", F.xxhash64("key").alias("order"), "open",
                             F.lit(0).cast("long").alias("extra"))
    blocks = fractions.groupBy("rank").agg(F.ceil(F.count("*") / block).alias("n_blocks"))
    first = stage(fractions.join(blocks, "rank")
                  .withColumn("block", F.pmod(F.shiftright("order", 8), "n_blocks"))
                  .select(*_COLUMNS)
                  # the join leaves a source in one task, which would do for the groups
                  .repartition("rank", "block").groupBy("rank", "block")
                  .applyInPandas(_node(seed), _SCHEMA), "rounded")

    # up the tree: each pass leaves at most one open fraction per node of the level
    settled, still, level = [], first.where("open is not null"), 0
    while True:
        level += 1
        top = still.agg(F.max("block")).first()[0]
        if top is None:
            break
        up = still.withColumn("block", F.floor(F.col("block") / fan))
        done = stage(up.groupBy("rank", "block").applyInPandas(_node(seed + level), _SCHEMA),
                     "rounded")
        settled.append(done)
        if top < fan:
            break
        still = done.where("open is not null")
    lone = (F.xxhash64(F.lit(seed), "key").bitwiseAND((1 << 52) - 1) / float(1 << 52)
            < F.col("open")).cast("long")
    extra = F.when(F.col("open").isNull(), F.col("extra"))
    decided = first.select("key", extra.alias("extra")).where("extra is not null")
    for done in settled[:-1]:
        decided = decided.union(done.select("key", extra.alias("extra")).where("extra is not null"))
    for done in settled[-1:]:
        decided = decided.union(done.select("key", F.coalesce(extra, lone).alias("extra")))

    # each part of a unit's rows gets its share, so that no unit is numbered in one task
    total = F.col("sure") + F.col("extra")
    shared = units.join(decided, "key").select(
        "key", F.floor(total / F.col("n")).alias("each"), (total % F.col("n")).alias("more"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    shares = (held.select("key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(
        "before")).join(shared, "key"))
    place = F.row_number().over(Window.partitionBy("key", "part").orderBy("row")) - 1
    placed = rows.withColumn("part", part).withColumn("place", place)
    more = (F.col("before") + F.col("place") < F.col("more")).cast("long")
    return (placed.join(shares, ["key", "part"], "left")
            .join(targets, of_source)
            .select("id", "source", "key", "row", "size", "source_size", "target",
                    F.coalesce(F.col("each") + more, F.lit(0)).cast("long").alias("copies")))


def mix(df: DataFrame, weights: Sequence[float] = WEIGHTS, volume: float = VOLUME,
        most: float = MOST, seed: int = SEED, id: str = "doc_id", source: str = "source",
        text: str = "text") -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it; columns and their names unchanged."""
    own = unused(df, "__mix")
    numbered = stage(df.withColumns({
        f"{own}_key": unit_key(id, source, text), f"{own}_row": F.monotonically_increasing_id(),
        f"{own}_size": F.size(words(text)).cast("long")}), "numbered")
    taken = copies_of_rows(numbered.select(
        F.col(id).alias("id"), F.col(source).alias("source"),
        *[F.col(f"{own}_{c}").alias(c) for c in ("key", "size", "row")]),
        weights, volume, most, seed).where("copies > 0")
    taken = taken.select(F.col("row").alias(f"{own}_row"), F.col("copies").alias(f"{own}_copies"))
    return (numbered.join(taken, f"{own}_row")
            .withColumn(f"{own}_copy", F.explode(F.sequence(
                F.lit(1), F.col(f"{own}_copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in df.columns]))
