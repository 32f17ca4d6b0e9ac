"""Risk score of clients from six weighted parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import LevelCutoffs, RiskWeights
from ledgerlens.functions.flags import has_error, is_night, is_online
from ledgerlens.functions.money import cents, dollars, rounded_cents, with_amount
from ledgerlens.functions.ratios import mean_amount
from ledgerlens.labels import ENGLISH, Labels
from ledgerlens.operators.rollups import ValueSets
from ledgerlens.plans.staging import stage

PARTS = ("volume", "amount", "geography", "error", "night", "diversity")


def client_indicators(transactions: DataFrame) -> DataFrame:
    """Activity, amounts, distinct cards, cities, days and merchants, errors per client.

    One plan for all clients: rows are grouped by (client, value) first, which spreads a client of
    very many rows over its values, and then by client. No value set is held in memory.
    """
    facts = with_amount(transactions).select(
        "client_id", "card_id", "merchant_city", F.to_date("date").alias("day"), "merchant_id",
        cents(F.col("amount_clean")).alias("c"), has_error().alias("failed"),
        is_night().alias("is_night"), is_online().alias("is_online"))
    sets = ValueSets(facts, "client_id", list(DISTINCT.values()), *_measures())
    sums = sets.groups.groupBy("client_id").agg(
        *[combine(sets.measure(name)).alias(name) for name, combine in MEASURES.items()],
        *[sets.distinct(v).alias(n) for n, v in DISTINCT.items()])
    return sums.select(
        "client_id", "transactions", dollars(F.col("c")).alias("total_amount"),
        mean_amount(F.col("c"), F.col("valid")).alias("mean_amount"),
        dollars(F.col("max_c")).alias("max_amount"), "cards", "cities", "active_days", "errors",
        "night", "online", "merchants")


# Name of each distinct count and the column it counts.
DISTINCT = {"cards": "card_id", "cities": "merchant_city", "active_days": "day",
            "merchants": "merchant_id"}

# How the measures of several groups of a client are combined.
MEASURES = {"transactions": F.sum, "c": F.sum, "valid": F.sum, "max_c": F.max, "errors": F.sum,
            "night": F.sum, "online": F.sum}


def _measures() -> list[Column]:
    return [F.count("*").alias("transactions"), F.sum("c").alias("c"), F.count("c").alias("valid"),
            F.max("c").alias("max_c"), F.count_if("failed").alias("errors"),
            F.count_if("is_night").alias("night"), F.count_if("is_online").alias("online")]


def population_stats(indicators: DataFrame) -> DataFrame:
    """One row: means and sample deviations over the clients."""
    mean_c = rounded_cents(F.col("mean_amount"))
    return indicators.agg(
        F.count("*").alias("clients"),
        F.try_divide(F.sum("transactions"), F.count("*")).alias("avg_transactions"),
        F.stddev_samp("transactions").alias("std_transactions"),
        (F.try_divide(F.sum(mean_c), F.count(mean_c)) / F.lit(100)).alias("avg_mean_amount"),
        F.stddev_samp("mean_amount").alias("std_mean_amount"),
        F.try_divide(F.sum("cities"), F.count("*")).alias("avg_cities"),
        F.try_divide(F.sum("errors"), F.count("*")).alias("avg_errors"),
    )


def _part(cap: float, value: Column) -> Column:
    """``least`` skips a null, so a part that cannot be computed gets its cap."""
    return F.least(F.lit(cap), value)


def risk_level(score: Column, cutoffs: LevelCutoffs, labels: Labels = ENGLISH) -> Column:
    high, medium, low, very_low = labels.levels
    return (F.when(score >= cutoffs.high, high).when(score >= cutoffs.medium, medium)
            .when(score >= cutoffs.low, low).otherwise(very_low))


def score_clients(indicators: DataFrame, stats: DataFrame, weights: RiskWeights = RiskWeights(),
                  cutoffs: LevelCutoffs = LevelCutoffs(), labels: Labels = ENGLISH) -> DataFrame:
    """Add the six parts, the rounded total and the level. ``stats`` has exactly one row."""
    w = weights
    n = F.col("transactions")

    def share(name: str) -> Column:
        return F.try_divide(F.col(name), n)

    def against(name: str, average: str) -> Column:
        return F.try_divide(F.col(name), F.col(average))

    parts = {
        "volume_score": _part(w.volume_cap, against("transactions", "avg_transactions")
                              * w.volume_scale),
        "amount_score": _part(w.amount_cap, against("mean_amount", "avg_mean_amount")
                              * w.amount_scale),
        "geography_score": _part(w.geography_cap, against("cities", "avg_cities")
                                 * w.geography_scale),
        "error_score": _part(w.error_cap, share("errors") * w.error_scale),
        "night_score": _part(w.night_cap, share("night") * w.night_scale),
        "diversity_score": _part(w.diversity_cap, share("merchants") * w.diversity_scale),
    }
    total = sum((F.col(f"{p}_score") for p in PARTS[1:]), F.col(f"{PARTS[0]}_score"))
    averages = stats.select("avg_transactions", "avg_mean_amount", "avg_cities")
    return (indicators.crossJoin(F.broadcast(averages))
            .withColumns(parts).drop(*averages.columns)
            .withColumn("risk_score", F.round(total, 2))
            .withColumn("risk_level", risk_level(F.col("risk_score"), cutoffs, labels)))


def client_risk(transactions: DataFrame, weights: RiskWeights = RiskWeights(),
                cutoffs: LevelCutoffs = LevelCutoffs(), labels: Labels = ENGLISH) -> DataFrame:
    """Scores straight from transactions.

    The indicators are needed twice, for the population means and for the score, and are far
    smaller than the facts; they are staged so that the facts are scanned once.
    """
    indicators = stage(client_indicators(transactions), "client_indicators")
    return score_clients(indicators, population_stats(indicators), weights, cutoffs, labels)


def _mean_of_cents(value: str) -> Column:
    """Mean of a column of two-decimal doubles, exact and rounded half up."""
    c = rounded_cents(F.col(value))
    return mean_amount(F.sum(c), F.count(c))


def risk_level_summary(scores: DataFrame) -> DataFrame:
    """Clients, mean score and mean total amount per level, riskiest first."""
    return (scores.groupBy("risk_level")
            .agg(F.count("*").alias("clients"),
                 _mean_of_cents("risk_score").alias("mean_score"),
                 _mean_of_cents("total_amount").alias("mean_total_amount"))
            .orderBy(F.desc("mean_score")))


def high_risk_clients(scores: DataFrame, labels: Labels = ENGLISH,
                      top: int | None = None) -> DataFrame:
    rows = (scores.filter(F.col("risk_level") == labels.levels[0])
            .select("client_id", "risk_score", "risk_level", "transactions", "total_amount",
                    "cards", "cities", "errors", "night")
            .orderBy(F.desc("risk_score"), "client_id"))
    return rows if top is None else rows.limit(top)


def score_components(scores: DataFrame, top: int | None = None) -> DataFrame:
    """The parts with one decimal, highest scores first."""
    rows = (scores.select("client_id", "risk_score",
                          *[F.round(f"{p}_score", 1).alias(f"{p}_score") for p in PARTS])
            .orderBy(F.desc("risk_score"), "client_id"))
    return rows if top is None else rows.limit(top)


def risk_scores_output(scores: DataFrame) -> DataFrame:
    """Table to save: score, level and main figures per client."""
    return scores.select("client_id", "risk_score", "risk_level", "transactions", "total_amount",
                         "mean_amount", "cards", "cities", "errors")


def risk_summary_output(scores: DataFrame) -> DataFrame:
    """Table to save: clients, total amount, mean score and errors per level."""
    return scores.groupBy("risk_level").agg(
        F.count("*").alias("clients"),
        dollars(F.sum(rounded_cents(F.col("total_amount")))).alias("total_amount"),
        _mean_of_cents("risk_score").alias("mean_score"),
        F.sum("errors").alias("errors"))
