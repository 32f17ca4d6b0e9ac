"""Volume and data quality (one pass over the facts per report)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.flags import has_error
from ledgerlens.functions.money import money_problem, with_amount
from ledgerlens.functions.ratios import percent, ratio


def _distinct_with_null(name: str) -> Column:
    """Distinct values, a null counted as one more value."""
    return F.count_distinct(F.col(name)) + F.coalesce(
        F.max(F.col(name).isNull().cast("int")), F.lit(0))


def volumetry(transactions: DataFrame) -> DataFrame:
    """One row: rows, and distinct clients, cards and merchants."""
    return transactions.agg(
        F.count("*").alias("transactions"),
        _distinct_with_null("client_id").alias("clients"),
        _distinct_with_null("card_id").alias("cards"),
        _distinct_with_null("merchant_id").alias("merchants"),
    )


def transactions_per_key(transactions: DataFrame) -> DataFrame:
    """One row: mean transactions per client, card and merchant, and cards per client."""
    v = volumetry(transactions)
    n = F.col("transactions")
    return v.select(
        ratio(n, F.col("clients")).alias("per_client"),
        ratio(F.col("cards"), F.col("clients")).alias("cards_per_client"),
        ratio(n, F.col("cards")).alias("per_card"),
        ratio(n, F.col("merchants")).alias("per_merchant"),
    )


def _is_missing(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    if isinstance(field.dataType, T.StringType):
        return c.isNull() | (c == "")
    return c.isNull()


def missing_value_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, missing values and their percentage.

    All columns are counted in the same pass; the single result row is then turned into rows.
    """
    fields = df.schema.fields
    counts = df.agg(F.count("*").alias("total"),
                    *[F.count_if(_is_missing(f)).alias(f"m{i}") for i, f in enumerate(fields)])
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.typeName()).alias("type"),
                 F.col(f"m{i}").alias("missing"))
        for i, f in enumerate(fields)])
    return (counts.select("total", F.explode(rows).alias("r"))
            .select("r.column_name", "r.type", "r.missing",
                    F.coalesce(percent(F.col("r.missing"), F.col("total")),
                               F.lit(0.0)).alias("missing_pct")))


def _share(part: Column, name: str) -> list[Column]:
    return [part.alias(name), percent(part, F.count("*")).alias(f"{name}_pct")]


def _non_positive() -> Column:
    return F.count_if(F.col("amount_clean") <= 0)


def quality_summary(transactions: DataFrame) -> DataFrame:
    """One row: total, and count and percentage of each of the quality problems.

    Unreadable amounts are those with a text that is no amount; they count in no other figure.
    """
    unreadable = F.col("amount").isNotNull() & F.col("amount_clean").isNull()
    return with_amount(transactions).agg(
        F.count("*").alias("transactions"),
        *_share(_non_positive(), "non_positive"),
        *_share(F.count_if(unreadable), "unreadable_amounts"),
        *_share(F.count_if(F.col("mcc").isNull()), "without_mcc"),
        *_share(F.count_if(has_error()), "with_errors"),
    )


def non_positive_summary(transactions: DataFrame) -> DataFrame:
    return with_amount(transactions).agg(*_share(_non_positive(), "non_positive"))


def non_positive_amounts(transactions: DataFrame) -> DataFrame:
    return (with_amount(transactions).filter(F.col("amount_clean") <= 0)
            .select("id", "amount", "amount_clean", "client_id", "card_id"))


def unreadable_amounts(transactions: DataFrame) -> DataFrame:
    """The rows whose amount can't be read, with the reason: kept apart instead of lost."""
    reason = money_problem(F.col("amount"))
    return (transactions.withColumn("reason", reason).where("reason is not null")
            .select("id", "client_id", "card_id", "amount", "reason"))


def unreadable_summary(transactions: DataFrame) -> DataFrame:
    """Rows per reason."""
    return unreadable_amounts(transactions).groupBy("reason").agg(F.count("*").alias("transactions"))


def without_mcc_summary(transactions: DataFrame) -> DataFrame:
    return transactions.agg(*_share(F.count_if(F.col("mcc").isNull()), "without_mcc"))


def transactions_without_mcc(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("mcc").isNull())


def with_errors_summary(transactions: DataFrame) -> DataFrame:
    return transactions.agg(*_share(F.count_if(has_error()), "with_errors"))


def transactions_with_errors(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("errors") != "")


def error_type_counts(transactions: DataFrame, top: int | None = None) -> DataFrame:
    """Rows per error text, most frequent first; ``top=None`` gives all."""
    counts = (transactions_with_errors(transactions)
              .groupBy("errors").agg(F.count("*").alias("occurrences"))
              .orderBy(F.desc("occurrences"), "errors"))
    return counts if top is None else counts.limit(top)
