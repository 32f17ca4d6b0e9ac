"""Errors by type, card and client."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.flags import banded, has_error, rank_of
from ledgerlens.functions.ratios import percent
from ledgerlens.labels import ENGLISH, Labels

RATE_LIMITS = (5, 10, 25)


def error_type_share(transactions: DataFrame, top: int | None = None) -> DataFrame:
    """Rows per error text and their share of the rows with errors; each row also carries the
    number of rows with errors and of all rows."""
    everything = Window.partitionBy()  # over the error texts, not over the facts
    is_error = F.col("errors") != ""
    shares = (transactions.groupBy("errors").agg(F.count("*").alias("occurrences"))
              .withColumn("total_rows", F.sum("occurrences").over(everything))
              .withColumn("error_rows",
                          F.sum(F.when(is_error, F.col("occurrences"))).over(everything))
              .filter(is_error)
              .select("errors", "occurrences",
                      percent(F.col("occurrences"), F.col("error_rows")).alias("pct"),
                      "error_rows", "total_rows")
              .orderBy(F.desc("occurrences"), "errors"))
    return shares if top is None else shares.limit(top)


def error_rates(transactions: DataFrame, key: str) -> DataFrame:
    """Transactions, errors and error rate of every value of ``key``."""
    return (transactions.groupBy(key)
            .agg(F.count("*").alias("transactions"), F.count_if(has_error()).alias("errors"))
            .withColumn("error_pct", percent(F.col("errors"), F.col("transactions"))))


def _most_errors(transactions: DataFrame, key: str, top: int | None) -> DataFrame:
    rates = error_rates(transactions, key)
    return rates if top is None else rates.orderBy(F.desc("errors"), key).limit(top)


def card_error_rate(transactions: DataFrame, top: int | None = None) -> DataFrame:
    return _most_errors(transactions, "card_id", top)


def client_error_rate(transactions: DataFrame, top: int | None = None) -> DataFrame:
    return _most_errors(transactions, "client_id", top)


def cards_all_errors(transactions: DataFrame) -> DataFrame:
    """One row: number of cards on which every transaction failed."""
    return error_rates(transactions, "card_id").agg(
        F.count_if(F.col("errors") == F.col("transactions")).alias("cards"))


def client_error_rate_bands(transactions: DataFrame, labels: Labels = ENGLISH) -> DataFrame:
    """Clients per band of the error rate, in band order. The rounded rate decides."""
    names = labels.error_rate_bands
    rate = F.col("error_pct")
    band = F.when(rate == 0, names[0]).otherwise(banded(rate, RATE_LIMITS, names[1:]))
    return (error_rates(transactions, "client_id")
            .groupBy(band.alias("band")).agg(F.count("*").alias("clients"))
            .orderBy(rank_of(F.col("band"), names)))
