"""Kept sketches: distinct counts and quantiles without reading the facts again.

Sketches are made once for each month of the facts and kept as small tables. They merge, so figures
of any span of months, or of all, come from the kept rows alone, and a new or corrected month
replaces only its own rows. Rows without a date are a month of their own (null).

- Distinct counts: HyperLogLog with 2^``precision`` registers, standard error 1.04 / 2^(precision/2).
- Quantiles: KLL; ``accuracy`` 800 keeps the error of a rank well below 0.01 of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.flags import has_error, is_night, is_online
from ledgerlens.functions.money import cents, dollars, with_amount
from ledgerlens.functions.ratios import mean_amount

KEYS = {"clients": "client_id", "cards": "card_id", "merchants": "merchant_id"}
#: Distinct counts of a client, as in the exact indicators.
OF_CLIENT = {"cards": "card_id", "cities": "merchant_city", "active_days": "day",
             "merchants": "merchant_id"}


@dataclass(frozen=True)
class SketchSize:
    """Registers of a distinct count over everything and of a client, and accuracy of quantiles."""

    precision: int = 14
    client_precision: int = 12
    accuracy: int = 800

    @staticmethod
    def error(precision: int) -> float:
        """Relative standard error of a distinct count."""
        return 1.04 / 2 ** (precision / 2)


DEFAULT = SketchSize()


def _facts(transactions: DataFrame) -> DataFrame:
    return with_amount(transactions).withColumns({
        "date_month": F.date_format("date", "yyyy-MM"), "c": cents(F.col("amount_clean"))})


def monthly_sketches(transactions: DataFrame, size: SketchSize = DEFAULT) -> DataFrame:
    """One row per month: rows, amounts, sketches of clients, cards, merchants and amounts."""
    distinct = [F.hll_sketch_agg(column, size.precision).alias(name)
                for name, column in KEYS.items()]
    missing = [F.max(F.col(column).isNull()).alias(f"missing_{name}")
               for name, column in KEYS.items()]
    return _facts(transactions).groupBy("date_month").agg(
        F.count("*").alias("transactions"), F.count("c").alias("valid"), *distinct, *missing,
        F.kll_sketch_agg_bigint("c", F.lit(size.accuracy)).alias("amounts"))


def monthly_client_sketches(transactions: DataFrame, size: SketchSize = DEFAULT) -> DataFrame:
    """One row per month and client: sums, and sketches of cards, cities, days and merchants."""
    rows = _facts(transactions).withColumns({
        "day": F.date_format("date", "yyyy-MM-dd"), "failed": has_error(),
        "at_night": is_night(), "is_online": is_online()})
    return rows.groupBy("date_month", "client_id").agg(
        F.count("*").alias("transactions"), F.sum("c").alias("c"), F.count("c").alias("valid"),
        F.max("c").alias("max_c"), F.count_if("failed").alias("errors"),
        F.count_if("at_night").alias("night"), F.count_if("is_online").alias("online"),
        *[F.hll_sketch_agg(column, size.client_precision).alias(name)
          for name, column in OF_CLIENT.items()])


def keep_sketches(sketches: DataFrame, path: str) -> None:
    """Write the months of ``sketches`` under ``path``; other months there stay as they are."""
    (sketches.hint("rebalance", F.col("date_month"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date_month").parquet(path))


def kept_sketches(spark: SparkSession, path: str, first: str | None = None,
                  last: str | None = None) -> DataFrame:
    """The kept rows, of the months from ``first`` to ``last`` (``yyyy-MM``) where given."""
    rows = spark.read.parquet(path).withColumn("date_month", F.col("date_month").cast("string"))
    if first is not None:
        rows = rows.where(F.col("date_month") >= first)
    return rows if last is None else rows.where(F.col("date_month") <= last)


def _united(name: str) -> Column:
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0))


def approximate_volumetry(sketches: DataFrame) -> DataFrame:
    """``quality.volumetry`` from kept sketches; a missing key counts as one more value."""
    return sketches.agg(
        F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions"),
        *[(_united(name) + F.coalesce(F.max(F.col(f"missing_{name}").cast("int")), F.lit(0)))
          .alias(name) for name in KEYS])


def approximate_client_indicators(sketches: DataFrame) -> DataFrame:
    """``risk.client_indicators`` from kept sketches: sums are exact, distinct counts estimates."""
    sums = sketches.groupBy("client_id").agg(
        F.sum("transactions").alias("transactions"), F.sum("c").alias("c"),
        F.sum("valid").alias("valid"), F.max("max_c").alias("max_c"),
        *[F.sum(n).alias(n) for n in ("errors", "night", "online")],
        *[_united(name).alias(name) for name in OF_CLIENT])
    return sums.select(
        "client_id", "transactions", dollars(F.col("c")).alias("total_amount"),
        mean_amount(F.col("c"), F.col("valid")).alias("mean_amount"),
        dollars(F.col("max_c")).alias("max_amount"), "cards", "cities", "active_days", "errors",
        "night", "online", "merchants")


def approximate_quantiles(sketches: DataFrame, probabilities: list[float]) -> DataFrame:
    """Rows (``probability``, ``amount``) from kept sketches; amount is null without any amounts."""
    merged = sketches.where(F.col("valid") > 0).agg(
        F.kll_merge_agg_bigint("amounts").alias("amounts"), F.sum("valid").alias("valid"))
    found = F.array(*[F.struct(
        F.lit(p).alias("probability"), F.when(F.col("valid") > 0, dollars(
            F.kll_sketch_get_quantile_bigint("amounts", F.lit(p)))).alias("amount"))
        for p in probabilities])
    return merged.select(F.explode(found).alias("q")).select("q.*")


def rank_errors(transactions: DataFrame, quantiles: DataFrame) -> DataFrame:
    """(probability, rank_error): how far the share of amounts up to each quantile is from it.

    A value that many rows share covers a span of ranks; inside the span the error is zero.
    """
    amounts = _facts(transactions).where("c is not null").groupBy("c").agg(F.count("*").alias("n"))
    values = quantiles.select("probability", F.round(F.col("amount") * 100).cast("bigint").alias("v"))
    return (amounts.join(F.broadcast(values)).groupBy("probability").agg(
        F.sum(F.when(F.col("c") < F.col("v"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("c") <= F.col("v"), F.col("n")).otherwise(0)).alias("upto"),
        F.sum("n").alias("total"))
        .select("probability", F.greatest(
            F.lit(0.0), F.col("below") / F.col("total") - F.col("probability"),
            F.col("probability") - F.col("upto") / F.col("total")).alias("rank_error")))
