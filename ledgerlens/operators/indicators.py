"""Indicators per card, all taken from one pass over the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.flags import ONLINE, has_error, is_physical_city
from ledgerlens.functions.money import cents, dollars, with_amount
from ledgerlens.functions.ratios import mean_amount, percent
from ledgerlens.operators.errors import error_rates
from ledgerlens.operators.rollups import ValueSets


def card_days(transactions: DataFrame) -> DataFrame:
    """Transactions and cents per card and day."""
    return (with_amount(transactions)
            .groupBy("card_id", F.to_date("date").alias("day"))
            .agg(F.count("*").alias("transactions"),
                 F.sum(cents(F.col("amount_clean"))).alias("cents")))


def card_day_counts(transactions: DataFrame, top: int | None = None) -> DataFrame:
    counts = card_days(transactions).select("card_id", "day", "transactions")
    return counts if top is None else counts.orderBy(
        F.desc("transactions"), "card_id", "day").limit(top)


def card_day_amounts(transactions: DataFrame, top: int | None = None) -> DataFrame:
    totals = card_days(transactions).select(
        "card_id", "day", dollars(F.col("cents")).alias("total_amount"))
    return totals if top is None else totals.orderBy(
        F.desc("total_amount"), "card_id", "day").limit(top)


def card_city_counts(transactions: DataFrame, top: int | None = None) -> DataFrame:
    """Distinct physical cities per card (online and empty cities left out)."""
    city = F.col("merchant_city")
    counts = (transactions.filter((city != "") & (city != ONLINE))
              .groupBy("card_id").agg(F.count_distinct(city).alias("physical_cities")))
    return counts if top is None else counts.orderBy(F.desc("physical_cities"), "card_id").limit(top)


def card_error_ratio(transactions: DataFrame, top: int | None = None) -> DataFrame:
    rates = error_rates(transactions, "card_id")
    return rates if top is None else rates.orderBy(F.desc("error_pct"), "card_id").limit(top)


def card_profile(transactions: DataFrame) -> DataFrame:
    """Everything the card reports need, one row per card, from one pass over the facts."""
    facts = with_amount(transactions).select(
        "card_id", "client_id", F.to_date("date").alias("day"), "merchant_city",
        cents(F.col("amount_clean")).alias("c"), has_error().alias("failed"))
    sets = ValueSets(
        facts, "card_id", ["day", "merchant_city"],
        F.count("*").alias("n"), F.sum("c").alias("c"), F.count("c").alias("valid"),
        F.max("c").alias("max_c"), F.count_if("failed").alias("failed"),
        F.min("client_id").alias("client_id"))
    of_day = sets.measure
    return sets.groups.groupBy("card_id").agg(
        F.min(of_day("client_id")).alias("client_id"),
        F.sum(of_day("n")).alias("transactions"),
        F.sum(of_day("c")).alias("cents"),
        F.sum(of_day("valid")).alias("valid"),
        F.max(of_day("max_c")).alias("max_cents"),
        F.sum(of_day("failed")).alias("errors"),
        sets.distinct("day").alias("active_days"),
        F.max(of_day("n")).alias("max_daily_count"),
        F.max(of_day("c")).alias("max_daily_cents"),
        sets.distinct("merchant_city").alias("cities"),
        sets.distinct("merchant_city", is_physical_city()).alias("physical_cities"),
    )


def card_indicators(transactions: DataFrame, top: int | None = None) -> DataFrame:
    """Counts, amounts, active days, cities (online counts as one) and errors per card."""
    table = card_profile(transactions).select(
        "card_id", "transactions", dollars(F.col("cents")).alias("total_amount"),
        mean_amount(F.col("cents"), F.col("valid")).alias("mean_amount"),
        "active_days", "cities", "errors",
        percent(F.col("errors"), F.col("transactions")).alias("error_pct"))
    return table if top is None else table.orderBy(F.desc("transactions"), "card_id").limit(top)
