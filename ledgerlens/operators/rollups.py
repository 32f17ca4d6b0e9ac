"""Exact distinct counts beside other aggregates, per key, in one pass.

The rows are grouped by (key, value) for each of several value columns at once. Neither this nor the
following grouping by key gathers the rows of one key in one task: the first spreads a busy key over
its values, the second adds partial results of the few rows that remain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ValueSets:
    """Groups of ``df`` by (``key``, value) for every column in ``values``."""

    def __init__(self, df: DataFrame, key: str, values: list[str], *measures: Column):
        self.values = values
        self.groups = (df.groupingSets([[key, v] for v in values], key, *values)
                       .agg(F.grouping_id().alias("set_id"), *measures))

    def member(self, value: str) -> Column:
        """Whether a row stands for a group by this value; all other value columns are then null.
        The grouping id has one bit per column, set where the column is left out."""
        n = len(self.values)
        return F.col("set_id") == 2**n - 1 - 2 ** (n - 1 - self.values.index(value))

    def measure(self, name: str) -> Column:
        """A measure of the first value's groups. They partition the rows, so it adds up."""
        return F.when(self.member(self.values[0]), F.col(name))

    def distinct(self, value: str, condition: Column | None = None) -> Column:
        """Number of distinct values other than null, of those that meet ``condition``."""
        counted = self.member(value) & F.col(value).isNotNull()
        return F.count_if(counted if condition is None else counted & condition)
