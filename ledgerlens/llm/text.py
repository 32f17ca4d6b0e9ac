"""Words of a text as column expressions.

A word is a run of characters other than the six ASCII white-space characters. A missing text has
no words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def whole(text: str) -> Column:
    """The text, empty where it is missing."""
    return F.coalesce(F.col(text), F.lit(""))


def words(text: str) -> Column:
    return F.array_remove(F.split(whole(text), SPACES, -1), "")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one: no column of ``df`` starts with it, in either case."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = "_" + name
    return name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
