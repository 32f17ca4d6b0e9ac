"""Exact and approximate quantiles of amounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.money import cents, dollars, with_amount
from ledgerlens.plans.staging import stage

#: Cents of a slice of the value range, from level to level. Fourteen digits of cents give at most
#: two hundred slices first, and a million slices of a slice at every further level.
WIDTHS = (10**12, 10**6, 1)


def _target_rank(probability: float, total: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.lit(probability) * total))


def exact_amount_quantiles(transactions: DataFrame, probabilities: list[float]) -> DataFrame:
    """Rows (``probability``, ``amount``): the smallest amount that at least this share of the
    amounts does not exceed.

    Works on the counts per distinct amount, which are read once a level and therefore staged.
    Running totals are taken over slices of the value range, then over slices of those that hold a
    wanted rank, down to single amounts, so a running total never has more than a million rows
    whatever the amounts are.
    """
    histogram = stage(with_amount(transactions).filter(F.col("amount_clean").isNotNull())
                      .groupBy(cents(F.col("amount_clean")).alias("value"))
                      .agg(F.count("*").alias("n")), "amount_counts")
    wanted = F.array(*[
        F.struct(F.lit(p).alias("probability"), _target_rank(p, F.col("total")).alias("rank"))
        for p in probabilities])
    found = histogram.agg(F.sum("n").alias("total")).where("total is not null").select(
        F.explode(wanted).alias("w")).select("w.*", F.lit(0).cast("bigint").alias("slice"))
    width = None
    for finer in WIDTHS:
        # the slices that hold a wanted rank: at most one for each probability
        within = F.lit(0).cast("bigint") if width is None else F.floor(F.col("value") / width)
        rows = (histogram.withColumn("slice", within).join(F.broadcast(found), "slice")
                .groupBy("probability", "rank", F.floor(F.col("value") / finer).alias("slice"))
                .agg(F.sum("n").alias("n")))
        running = (Window.partitionBy("probability").orderBy("slice")
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        found = stage(rows.withColumn("upto", F.sum("n").over(running))
                      .withColumn("before", F.col("upto") - F.col("n"))
                      .filter((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("upto")))
                      .select("probability", (F.col("rank") - F.col("before")).alias("rank"),
                              "slice"), "quantile_slices")
        width = finer
    return found.select("probability", dollars(F.col("slice")).alias("amount"))


def approximate_amount_quantiles(transactions: DataFrame, probabilities: list[float],
                                 relative_error: float = 0.01) -> DataFrame:
    """The same rows from one pass with mergeable summaries; ranks are off by at most
    ``relative_error`` of the row count."""
    values = F.percentile_approx("amount_clean", probabilities, int(round(1 / relative_error)))
    return (with_amount(transactions).agg(values.alias("values"))
            .select(F.explode(F.arrays_zip(
                F.array(*[F.lit(p) for p in probabilities]).alias("probability"),
                F.col("values").alias("amount"))).alias("q"))
            .select("q.probability", F.col("q.amount").cast("double").alias("amount")))
