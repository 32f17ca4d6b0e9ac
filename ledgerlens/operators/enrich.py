"""Merchant categories.

The dimension has no broadcast hint: Spark broadcasts it when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with skewed codes split at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.money import cents, dollars, with_amount
from ledgerlens.functions.ratios import mean_amount


def _join_category(df: DataFrame, mcc: DataFrame, how: str) -> DataFrame:
    codes = mcc.select(F.col("mcc").alias("mcc_code"), "merchant_category")
    return df.join(codes, F.col("mcc").cast("string") == F.col("mcc_code"), how).drop("mcc_code")


def transactions_with_category(transactions: DataFrame, mcc: DataFrame) -> DataFrame:
    """Every transaction with its ``merchant_category``, null where the code is unknown."""
    return _join_category(transactions, mcc, "left")


def category_totals(transactions: DataFrame, mcc: DataFrame) -> DataFrame:
    """Count, valid amounts and cents per category name.

    Facts are first reduced to one row per code and only then meet the dimension, so the join and
    the second grouping work on a few thousand rows. Codes with the same name are merged.
    """
    c = cents(F.col("amount_clean"))
    per_code = (with_amount(transactions).filter(F.col("mcc").isNotNull())
                .groupBy("mcc")
                .agg(F.count("*").alias("n"), F.sum(c).alias("c"), F.count(c).alias("valid")))
    return (_join_category(per_code, mcc.filter(F.col("merchant_category").isNotNull()), "inner")
            .groupBy("merchant_category")
            .agg(F.sum("n").alias("transactions"), F.sum("c").alias("cents"),
                 F.sum("valid").alias("valid")))


def top_categories_by_volume(transactions: DataFrame, mcc: DataFrame, top: int = 10) -> DataFrame:
    return (category_totals(transactions, mcc)
            .select("merchant_category", "transactions")
            .orderBy(F.desc("transactions"), "merchant_category").limit(top))


def category_amounts(transactions: DataFrame, mcc: DataFrame, top: int = 15) -> DataFrame:
    """Categories with the highest mean amount (mean rounded before sorting)."""
    return (category_totals(transactions, mcc)
            .select("merchant_category",
                    mean_amount(F.col("cents"), F.col("valid")).alias("mean_amount"),
                    "transactions", dollars(F.col("cents")).alias("total_amount"))
            .orderBy(F.desc("mean_amount"), "merchant_category").limit(top))
