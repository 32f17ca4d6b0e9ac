"""Normal against suspect clients.

Facts are reduced to the client (or client and category, city, band) first and the classes are
joined to those rows, so no join ever moves the facts and a client with very many rows is combined
before the shuffle. Clients without a class count as normal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.flags import banded, has_error, is_night, is_online, is_weekend, rank_of
from ledgerlens.functions.money import cents, dollars, with_amount
from ledgerlens.functions.ratios import mean_amount, percent, ratio
from ledgerlens.labels import ENGLISH, Labels
from ledgerlens.sources.buckets import SALT

GROUP_LIMITS = (10, 50, 200, 500)


def client_classes(scores: DataFrame, labels: Labels = ENGLISH) -> DataFrame:
    """Clients of the two upper levels are suspect."""
    return scores.select("client_id", F.col("risk_level").isin(*labels.levels[:2])
                         .alias("is_suspect"))


def behaviour_flags(transactions: DataFrame) -> DataFrame:
    """Add error, online, night and weekend as 0 or 1."""
    return with_amount(transactions).withColumns({
        "has_error": has_error().cast("int"),
        "is_online": is_online().cast("int"),
        "is_night": is_night().cast("int"),
        "is_weekend": is_weekend().cast("int"),
    })


def _classify(df: DataFrame, classes: DataFrame) -> DataFrame:
    return (df.join(classes.select("client_id", "is_suspect"), "client_id", "left")
            .fillna(False, ["is_suspect"]))


def classified_transactions(transactions: DataFrame, classes: DataFrame) -> DataFrame:
    """Every transaction with its flags and class. Pass classes read from a table: their size is
    then known and Spark can broadcast them instead of moving the facts."""
    return _classify(behaviour_flags(transactions), classes)


def classified_by_client(transactions: DataFrame, classes: DataFrame) -> DataFrame:
    """The same of tables that are laid out by client (``sources.buckets``): classes of any number
    of clients join without moving the facts, and a client of very many facts goes to many tasks."""
    of_salt = classes.select("client_id", SALT, "is_suspect")
    return (behaviour_flags(transactions).join(of_salt, ["client_id", SALT], "left")
            .fillna(False, ["is_suspect"]).drop(SALT))


def _group(labels: Labels) -> Column:
    normal, suspect = labels.groups
    return F.when(F.col("is_suspect"), suspect).otherwise(normal).alias("group")


def _by_group(per_client: DataFrame, classes: DataFrame, *aggregates: Column) -> DataFrame:
    return _classify(per_client, classes).groupBy("is_suspect").agg(*aggregates)


def client_sums(transactions: DataFrame) -> DataFrame:
    """Sums per client that add up to sums per group."""
    c = cents(F.col("amount_clean"))
    hour = F.hour("date")
    return with_amount(transactions).groupBy("client_id").agg(
        F.count("*").alias("n"),
        F.sum(c).alias("c"),
        F.count(c).alias("valid"),
        F.min(c).alias("min_c"),
        F.max(c).alias("max_c"),
        (F.var_pop(c) * F.count(c)).alias("squares"),  # squared distances from the client's mean
        F.count_if(is_night()).alias("night"),
        F.count_if(is_weekend()).alias("weekend"),
        F.sum(hour).alias("hours"),
        F.count(hour).alias("timed"),
        F.count_if(has_error()).alias("errors"),
    )


def group_general_stats(transactions: DataFrame, classes: DataFrame,
                        labels: Labels = ENGLISH) -> DataFrame:
    """Clients, count, mean, sample deviation, minimum and maximum amount per group.

    Squared distances within clients and between client means add up to those of the group.
    """
    between = F.pow(F.col("c"), 2) / F.nullif(F.col("valid"), F.lit(0))
    g = _by_group(
        client_sums(transactions), classes,
        F.count("client_id").alias("clients"), F.sum("n").alias("transactions"),
        F.sum("c").alias("c"), F.sum("valid").alias("valid"),
        F.sum("squares").alias("within"), F.sum(between).alias("between"),
        F.min("min_c").alias("min_c"), F.max("max_c").alias("max_c"))
    valid = F.col("valid")
    squares = F.col("within") + F.col("between") - F.try_divide(F.pow(F.col("c"), 2), valid)
    deviation = F.sqrt(F.greatest(F.lit(0.0), squares) / F.when(valid > 1, valid - 1))
    return g.select(
        _group(labels), "clients", "transactions",
        mean_amount(F.col("c"), valid).alias("mean_amount"),
        (F.round(deviation) / F.lit(100)).alias("std_amount"),
        dollars(F.col("min_c")).alias("min_amount"), dollars(F.col("max_c")).alias("max_amount"))


def group_temporal_behaviour(transactions: DataFrame, classes: DataFrame,
                             labels: Labels = ENGLISH) -> DataFrame:
    """Share of night and weekend, and mean hour, per group."""
    n = F.sum("n")
    g = _by_group(
        client_sums(transactions), classes,
        percent(F.sum("night"), n).alias("night_pct"),
        percent(F.sum("weekend"), n).alias("weekend_pct"),
        ratio(F.sum("hours"), F.sum("timed"), 1).alias("mean_hour"))
    return g.select(_group(labels), "night_pct", "weekend_pct", "mean_hour")


def group_error_rate(transactions: DataFrame, classes: DataFrame,
                     labels: Labels = ENGLISH) -> DataFrame:
    g = _by_group(
        client_sums(transactions), classes,
        percent(F.sum("errors"), F.sum("n")).alias("error_pct"),
        F.sum("errors").alias("errors"), F.sum("n").alias("transactions"))
    return g.select(_group(labels), "error_pct", "errors", "transactions")


def client_mcc_sums(transactions: DataFrame) -> DataFrame:
    c = cents(F.col("amount_clean"))
    return with_amount(transactions).groupBy("client_id", "mcc").agg(
        F.count("*").alias("n"), F.sum(c).alias("c"), F.count(c).alias("valid"),
        F.count_if(is_online()).alias("online"))


def group_purchase_behaviour(transactions: DataFrame, classes: DataFrame,
                             labels: Labels = ENGLISH) -> DataFrame:
    """Mean amount, total and count per client, online share, distinct codes per group."""
    g = _by_group(
        client_mcc_sums(transactions), classes,
        F.sum("n").alias("n"), F.sum("c").alias("c"), F.sum("valid").alias("valid"),
        F.sum("online").alias("online"), F.count_distinct("client_id").alias("clients"),
        F.count_distinct("mcc").alias("distinct_mcc"))
    return g.select(
        _group(labels),
        mean_amount(F.col("c"), F.col("valid")).alias("mean_amount"),
        mean_amount(F.col("c"), F.col("clients")).alias("amount_per_client"),
        ratio(F.col("n"), F.col("clients")).alias("transactions_per_client"),
        percent(F.col("online"), F.col("n")).alias("online_pct"), "distinct_mcc")


def group_geography(transactions: DataFrame, classes: DataFrame,
                    labels: Labels = ENGLISH) -> DataFrame:
    """Distinct cities and states, and cities per client, per group."""
    places = transactions.select("client_id", "merchant_city", "merchant_state").distinct()
    g = _by_group(
        places, classes,
        F.count_distinct("merchant_city").alias("cities"),
        F.count_distinct("merchant_state").alias("states"),
        F.count_distinct("client_id").alias("clients"))
    return g.select(_group(labels), "cities", "states",
                    ratio(F.col("cities"), F.col("clients")).alias("cities_per_client"))


def group_amount_bands(transactions: DataFrame, classes: DataFrame,
                       labels: Labels = ENGLISH) -> DataFrame:
    """Transactions per amount band, one column per group, in band order."""
    band = banded(F.col("amount_clean"), GROUP_LIMITS, labels.group_bands)
    per_client = (with_amount(transactions).groupBy("client_id", band.alias("band"))
                  .agg(F.count("*").alias("n")))
    return (_classify(per_client, classes)
            .select("band", "n", _group(labels))
            .groupBy("band").pivot("group", list(labels.groups)).agg(F.sum("n"))
            .fillna(0, list(labels.groups))
            .orderBy(rank_of(F.col("band"), labels.group_bands)))


def group_top_mcc(transactions: DataFrame, classes: DataFrame, labels: Labels = ENGLISH,
                  top: int = 10) -> DataFrame:
    """Most frequent codes of each group."""
    per_client = (transactions.filter(F.col("mcc").isNotNull())
                  .groupBy("client_id", "mcc").agg(F.count("*").alias("n")))
    order = Window.partitionBy("group").orderBy(F.desc("transactions"), "mcc")
    return (_classify(per_client, classes)
            .groupBy(_group(labels), "mcc").agg(F.sum("n").alias("transactions"))
            .withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= top))


def group_shares(classes: DataFrame, labels: Labels = ENGLISH) -> DataFrame:
    """Clients per group and their share."""
    both = Window.partitionBy()  # over two rows
    return (classes.groupBy(_group(labels)).agg(F.count("*").alias("clients"))
            .select("group", "clients",
                    percent(F.col("clients"), F.sum("clients").over(both), 1).alias("pct")))
