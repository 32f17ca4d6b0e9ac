"""Distribution of amounts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.flags import banded, rank_of
from ledgerlens.functions.money import cents, dollars, with_amount
from ledgerlens.functions.ratios import mean_amount, percent
from ledgerlens.labels import ENGLISH, Labels
from ledgerlens.operators.quantiles import approximate_amount_quantiles, exact_amount_quantiles

BAND_LIMITS = (10, 50, 200)


def transactions_clean(transactions: DataFrame) -> DataFrame:
    return with_amount(transactions)


def amount_statistics(transactions: DataFrame) -> DataFrame:
    """One row: mean, minimum, maximum and number of valid amounts."""
    c = cents(F.col("amount_clean"))
    return with_amount(transactions).agg(
        F.try_divide(F.sum(c), F.count(c) * F.lit(100)).alias("mean_amount"),
        dollars(F.min(c)).alias("min_amount"),
        dollars(F.max(c)).alias("max_amount"),
        F.count(c).alias("amounts"),
    )


def _quantiles(transactions: DataFrame, probabilities: list[float], exact: bool) -> DataFrame:
    if exact:
        return exact_amount_quantiles(transactions, probabilities)
    return approximate_amount_quantiles(transactions, probabilities)


def amount_median(transactions: DataFrame, exact: bool = True) -> DataFrame:
    return _quantiles(transactions, [0.5], exact).agg(F.max("amount").alias("median_amount"))


def amount_quartiles(transactions: DataFrame, exact: bool = True) -> DataFrame:
    """One row: first, second and third quartile."""
    q = _quantiles(transactions, [0.25, 0.5, 0.75], exact)
    return q.agg(*[F.max(F.when(F.col("probability") == p, F.col("amount"))).alias(name)
                   for p, name in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))])


def amount_bands(transactions: DataFrame, labels: Labels = ENGLISH,
                 unknown: str | None = None) -> DataFrame:
    """Count, mean, total and share of all rows per amount band, in band order.

    A row without a valid amount counts in the last band, or in a band of its own named
    ``unknown``.
    """
    amount = F.col("amount_clean")
    band = banded(amount, BAND_LIMITS, labels.amount_bands)
    names = labels.amount_bands
    if unknown is not None:
        band = F.when(amount.isNull(), F.lit(unknown)).otherwise(band)
        names = names + (unknown,)
    c = cents(amount)
    everything = Window.partitionBy()  # over the bands, not over the facts
    return (with_amount(transactions)
            .groupBy(band.alias("band"))
            .agg(F.count("*").alias("transactions"), F.sum(c).alias("c"), F.count(c).alias("valid"))
            .select("band", "transactions",
                    mean_amount(F.col("c"), F.col("valid")).alias("mean_amount"),
                    dollars(F.col("c")).alias("total_amount"),
                    percent(F.col("transactions"),
                            F.sum("transactions").over(everything)).alias("pct"))
            .orderBy(rank_of(F.col("band"), names)))
