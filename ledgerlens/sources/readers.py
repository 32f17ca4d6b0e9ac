"""CSV, JSON and Parquet readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources import schemas

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, types: dict[str, T.DataType] | None = None,
             keep_corrupt: bool = False) -> DataFrame:
    """CSV with a header line, columns found by name.

    Only the header is read to learn the names; no pass over the data guesses types. Fields that do
    not fit their type become null. With ``keep_corrupt`` the text of lines with a wrong number of
    fields is kept in ``_corrupt_record``.
    """
    names = spark.read.option("header", True).csv(path).columns
    fields = [T.StructField(n, T.StringType()) for n in names]
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    raw = (spark.read.schema(T.StructType(fields))
           .option("header", True)
           .option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT)
           .csv(path))
    types = types or {}
    typed = [F.col(f"`{f.name}`").try_cast(types[f.name]).alias(f.name)
             if f.name in types and not isinstance(types[f.name], T.StringType)
             else F.col(f"`{f.name}`") for f in fields]
    return raw.select(*typed)


def read_transactions(spark: SparkSession, path: str, keep_corrupt: bool = False) -> DataFrame:
    return read_csv(spark, path, schemas.TRANSACTIONS, keep_corrupt)


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    """Cards as text; see ``operators.features.typed_cards`` for the typed form."""
    return read_csv(spark, path)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """Users as text; see ``operators.features.typed_users`` for the typed form."""
    return read_csv(spark, path)


def read_mcc(spark: SparkSession, path: str) -> DataFrame:
    """Merchant categories from one JSON object that maps code to name."""
    return codes_from_json(spark.read.text(path, wholetext=True))


def codes_from_json(objects: DataFrame) -> DataFrame:
    """One row (``mcc``, ``merchant_category``) per entry of the JSON objects in ``value``.

    Parsed as a map, so the codes need not become columns and no pass over the file guesses types.
    """
    entries = F.from_json("value", "map<string,string>")
    return objects.select(F.explode(entries).alias("mcc", "merchant_category"))


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(id, label, is_fraud) of label files: JSON objects that map transaction ids to yes or no.

    A file may be one object, or have one a line, which lets Spark read it in parts. ``is_fraud`` is
    null where the label is neither yes nor no; an id that is no number is null.
    """
    entries = F.from_json("value", "map<string,string>")
    rows = spark.read.text(path).select(F.explode(entries).alias("id", "label"))
    if rows.isEmpty():  # no line is an object by itself
        rows = spark.read.text(path, wholetext=True).select(F.explode(entries).alias("id", "label"))
    said = F.lower(F.trim("label"))
    return rows.select(
        F.col("id").try_cast("bigint").alias("id"), "label",
        F.when(said.isin("yes", "true", "1"), True).when(said.isin("no", "false", "0"), False)
        .alias("is_fraud"))


def read_typed_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Transactions written by ``writers.land_transactions``."""
    return spark.read.parquet(path)
