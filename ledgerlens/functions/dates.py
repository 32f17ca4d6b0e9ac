"""Calendar parts of the transaction time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.labels import ENGLISH, Labels


def weekday_name(number: Column, labels: Labels = ENGLISH) -> Column:
    """Name of a weekday number (1 is Sunday). ``element_at`` on a constant array does not check
    the index for null, so the missing number is kept apart."""
    names = F.array(*[F.lit(n) for n in labels.weekdays])
    return F.when(number.isNotNull(), F.element_at(names, number))


def epoch_second(date: Column) -> Column:
    """Whole seconds since 1970 of a time without zone, or of a timestamp in session time."""
    return F.unix_timestamp(date)
