"""Rounded ratios of exact integers.

``round(a / b)`` on two integers meets a tie exactly when there is one, so half-up rounding does
not depend on the binary form of a decimal fraction. Division by zero gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, decimals: int = 2) -> Column:
    scale = 10**decimals
    return F.round(F.try_divide(part * F.lit(100 * scale), whole)) / F.lit(scale)


def ratio(part: Column, whole: Column, decimals: int = 2) -> Column:
    scale = 10**decimals
    return F.round(F.try_divide(part * F.lit(scale), whole)) / F.lit(scale)


def mean_cents(cents_sum: Column, count: Column) -> Column:
    """Mean in whole cents, half up."""
    return F.round(F.try_divide(cents_sum, count)).cast("bigint")


def mean_amount(cents_sum: Column, count: Column) -> Column:
    """Mean amount with two decimals from a sum of cents."""
    return mean_cents(cents_sum, count) / F.lit(100)
