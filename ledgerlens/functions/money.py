"""Money as exact decimals, summed as whole cents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

#: Twelve digits before the point; cents and products with small integers still fit a long.
MONEY = DecimalType(14, 2)
NOT_A_NUMBER, NOT_CENTS, TOO_LARGE = "not a number", "not whole cents", "too large"
#: Digits behind the cents, and an exponent, which can move them.
_FINER, _EXPONENT = r"\.\d\d\d*[1-9]", "[eE]"


def _bare(text: Column) -> Column:
    return F.replace(text, F.lit("$"), F.lit(""))


def parse_money(text: Column) -> Column:
    """``"$-77.00"`` to decimal; null where the text is no amount (see ``money_problem``)."""
    amount = _bare(text).try_cast(MONEY)
    whole = F.when(text.rlike(_EXPONENT), _bare(text).try_cast("double") == amount.cast("double")
                   ).otherwise(~text.rlike(_FINER))
    return F.when(whole, amount)


def money_problem(text: Column) -> Column:
    """Why a text is no amount; null where it is one, or is missing.

    Nothing is rounded or cut to fit: more than two decimals and more than twelve digits before the
    point are problems, not amounts.
    """
    number = _bare(text).try_cast("double")
    finite = F.coalesce(~F.isnan(number) & (F.abs(number) < float("inf")), F.lit(False))
    return F.when(text.isNotNull() & parse_money(text).isNull(), F.when(
        ~finite, NOT_A_NUMBER).when(_bare(text).try_cast(MONEY).isNull(), TOO_LARGE).otherwise(
            NOT_CENTS))


def with_amount(df: DataFrame) -> DataFrame:
    """Add ``amount_clean``. A table that already has it is returned as it is."""
    if "amount_clean" in df.columns:
        return df
    return df.withColumn("amount_clean", parse_money(F.col("amount")))


def cents(amount: Column) -> Column:
    """Whole cents. A bigint sum is exact and order-free like a decimal sum, but stays in the
    fixed-width aggregation buffer; a decimal sum wider than 18 digits does not. A sum beyond 92
    quadrillion dollars is an error in ANSI mode, never a wrong figure."""
    return (amount * F.lit(100)).cast("bigint")


def rounded_cents(amount: Column) -> Column:
    """Cents of a double that holds a value with two decimals."""
    return F.round(amount * F.lit(100)).cast("bigint")


def dollars(cents_col: Column) -> Column:
    return cents_col / F.lit(100)
