"""Row-level facts about one transaction. Every flag is true or false, never null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ONLINE = "ONLINE"  # fixed value: the city text of an online purchase


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def has_error(errors: Column | None = None) -> Column:
    """Null and the empty text both mean that no error happened."""
    errors = F.col("errors") if errors is None else errors
    return _known(errors != "")


def is_online(city: Column | None = None) -> Column:
    city = F.col("merchant_city") if city is None else city
    return _known(city == ONLINE)


def is_physical_city(city: Column | None = None) -> Column:
    city = F.col("merchant_city") if city is None else city
    return _known((city != "") & (city != ONLINE))


def is_night(date: Column | None = None, first_hour: int = 0, last_hour: int = 5) -> Column:
    date = F.col("date") if date is None else date
    return _known(F.hour(date).between(first_hour, last_hour))


def is_weekend(date: Column | None = None) -> Column:
    date = F.col("date") if date is None else date
    return _known(F.dayofweek(date).isin(1, 7))


def banded(value: Column, limits: tuple[float, ...], names: tuple[str, ...]) -> Column:
    """First name whose upper limit lies above ``value``; the last name otherwise, also for null."""
    chain = F.when(value < limits[0], names[0])
    for limit, name in zip(limits[1:], names[1:]):
        chain = chain.when(value < limit, name)
    return chain.otherwise(names[-1])


def rank_of(value: Column, names: tuple[str, ...]) -> Column:
    """Position of a label in its list, for sorting bands in their own order."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), value)
