"""Activity by hour, weekday and month."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.dates import weekday_name
from ledgerlens.functions.ratios import percent, ratio
from ledgerlens.labels import ENGLISH, Labels


def temporal_columns(transactions: DataFrame, labels: Labels = ENGLISH) -> DataFrame:
    """Add hour, weekday number (1 is Sunday), weekday name and month of the year."""
    return transactions.withColumns({
        "hour": F.hour("date"),
        "weekday": F.dayofweek("date"),
        "weekday_name": weekday_name(F.dayofweek("date"), labels),
        "month": F.month("date"),
    })


def transactions_by_hour(transactions: DataFrame) -> DataFrame:
    return (transactions.groupBy(F.hour("date").alias("hour"))
            .agg(F.count("*").alias("transactions")).orderBy("hour"))


def transactions_by_weekday(transactions: DataFrame, labels: Labels = ENGLISH) -> DataFrame:
    """Sunday first."""
    return (transactions.groupBy(F.dayofweek("date").alias("weekday"))
            .agg(F.count("*").alias("transactions"))
            .orderBy("weekday")
            .select(weekday_name(F.col("weekday"), labels).alias("weekday_name"), "transactions"))


def transactions_by_month(transactions: DataFrame) -> DataFrame:
    """Month of the year, all years together."""
    return (transactions.groupBy(F.month("date").alias("month"))
            .agg(F.count("*").alias("transactions")).orderBy("month"))


def hour_share(transactions: DataFrame) -> DataFrame:
    """Share of each hour and, on every row, the busiest hour as a multiple of the quietest."""
    hours = Window.partitionBy()  # over at most 25 rows
    n = F.col("transactions")
    return (transactions_by_hour(transactions)
            .select("hour", "transactions",
                    percent(n, F.sum(n).over(hours)).alias("pct"),
                    ratio(F.max(n).over(hours), F.min(n).over(hours)).alias("peak_to_trough"))
            .orderBy("hour"))
