"""Cards that exceed a threshold on any day or in the number of cities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import Thresholds
from ledgerlens.functions.money import dollars
from ledgerlens.functions.ratios import ratio
from ledgerlens.labels import ENGLISH, Labels
from ledgerlens.operators.indicators import card_city_counts, card_days, card_profile

DEFAULT = Thresholds()


def _limit_cents(thresholds: Thresholds) -> int:
    return round(thresholds.daily_amount * 100)


def suspects_by_daily_count(transactions: DataFrame, thresholds: Thresholds = DEFAULT) -> DataFrame:
    """Cards with more transactions than allowed on some day."""
    return (card_days(transactions).filter(F.col("transactions") > thresholds.daily_count)
            .select("card_id").distinct())


def suspects_by_cities(transactions: DataFrame, thresholds: Thresholds = DEFAULT) -> DataFrame:
    """Cards used in more physical cities than allowed."""
    return (card_city_counts(transactions).filter(F.col("physical_cities") > thresholds.cities)
            .select("card_id"))


def suspects_by_daily_amount(transactions: DataFrame, thresholds: Thresholds = DEFAULT) -> DataFrame:
    """Cards that spent more than allowed on some day."""
    return (card_days(transactions).filter(F.col("cents") > _limit_cents(thresholds))
            .select("card_id").distinct())


def _criteria(thresholds: Thresholds) -> dict[str, Column]:
    return {
        "over_daily_count": F.col("max_daily_count") > thresholds.daily_count,
        "over_cities": F.col("physical_cities") > thresholds.cities,
        "over_daily_amount": F.coalesce(
            F.col("max_daily_cents") > _limit_cents(thresholds), F.lit(False)),
    }


def with_criteria(profile: DataFrame, thresholds: Thresholds = DEFAULT) -> DataFrame:
    """Keep the cards of ``card_profile`` that meet a criterion and say which ones they meet."""
    criteria = _criteria(thresholds)
    return profile.withColumns(criteria).filter(" or ".join(criteria))


def suspicious_cards(transactions: DataFrame, thresholds: Thresholds = DEFAULT) -> DataFrame:
    """Distinct cards that meet at least one criterion, with the criteria they meet."""
    return with_criteria(card_profile(transactions), thresholds).select(
        "card_id", "over_daily_count", "over_cities", "over_daily_amount")


def suspect_counts(transactions: DataFrame, thresholds: Thresholds = DEFAULT) -> DataFrame:
    """One row: number of cards per criterion and in total."""
    return suspicious_cards(transactions, thresholds).agg(
        F.count_if("over_daily_count").alias("by_daily_count"),
        F.count_if("over_cities").alias("by_cities"),
        F.count_if("over_daily_amount").alias("by_daily_amount"),
        F.count("*").alias("suspicious_cards"))


def suspect_details(transactions: DataFrame, thresholds: Thresholds = DEFAULT,
                    labels: Labels = ENGLISH, top: int | None = None) -> DataFrame:
    """Figures of the suspicious cards and a reason text.

    The text compares means per active day and counts online as a city, so it can be empty or name
    a criterion the card was not selected by; the ``over_`` columns are the exact criteria.
    """
    days = F.col("active_days")
    per_day = ratio(F.col("transactions"), days)
    daily_amount = F.try_divide(F.col("cents"), days)
    many, cities, high = labels.reasons
    reason = F.concat_ws(
        ", ",
        F.when(per_day > thresholds.daily_count, many),
        F.when(F.col("cities") > thresholds.cities, cities),
        F.when(daily_amount > _limit_cents(thresholds), high))
    details = with_criteria(card_profile(transactions), thresholds).select(
        "card_id", "transactions", dollars(F.col("cents")).alias("total_amount"),
        F.col("active_days"), "cities", dollars(F.col("max_cents")).alias("max_amount"),
        per_day.alias("transactions_per_day"), reason.alias("reason"),
        "over_daily_count", "over_cities", "over_daily_amount")
    return details if top is None else details.orderBy(F.desc("transactions"), "card_id").limit(top)


def suspicious_cards_output(transactions: DataFrame, thresholds: Thresholds = DEFAULT) -> DataFrame:
    """Table to save: client, count, total and cities of each suspicious card."""
    return with_criteria(card_profile(transactions), thresholds).select(
        "card_id", "client_id", "transactions", dollars(F.col("cents")).alias("total_amount"),
        "cities")


def describe_cards(transactions: DataFrame, cards: DataFrame) -> DataFrame:
    """The same table for a given list of distinct cards."""
    return (card_profile(transactions).join(cards.select("card_id"), "card_id", "left_semi")
            .select("card_id", "client_id", "transactions",
                    dollars(F.col("cents")).alias("total_amount"), "cities"))
