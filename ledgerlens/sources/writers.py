"""Parquet writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.money import with_amount


def write_table(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite ``path``. The number of files follows the data size unless ``files`` is given;
    then a shuffle, not a coalesce, brings the rows together, so the work before stays parallel."""
    sized = df.hint("rebalance") if files is None else df.repartition(files)
    sized.write.mode("overwrite").parquet(path)


def publish(tables: dict[str, DataFrame], path: str) -> int:
    """Write tables together as a new version under ``path`` and return its number.

    Readers see the version only when its pointer is set, after all tables are written; until then,
    and if this stops half way, they read the version before. Setting the pointer creates one empty
    file, which fails if another run took the same number.
    """
    spark = next(iter(tables.values())).sparkSession
    number = max([0, *_versions(spark, f"{path}/versions")]) + 1
    for name, df in tables.items():
        write_table(df, f"{path}/versions/{number}/{name}")
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/published/{number}")
    files = pointer.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.createNewFile(pointer):
        raise FileExistsError(f"version {number} was published by another run")
    return number


def published(spark: SparkSession, path: str, name: str, version: int | None = None) -> DataFrame:
    """A table of the newest published version, or of a given one."""
    numbers = _versions(spark, f"{path}/published")
    if not numbers or version is not None and version not in numbers:
        raise FileNotFoundError(f"no such version is published under {path}")
    return spark.read.parquet(f"{path}/versions/{version or numbers[-1]}/{name}")


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the newest ``keep`` published versions, and what older runs left half done.

    The pointer goes first, so that no reader begins with a version whose files are going.
    """
    newest = _versions(spark, f"{path}/published")[-keep:]
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    for number in _versions(spark, f"{path}/versions"):
        if newest and number < newest[0]:
            for old in (f"{path}/published/{number}", f"{path}/versions/{number}"):
                p = path_class(old)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _versions(spark: SparkSession, folder: str) -> list[int]:
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    names = [s.getPath().getName() for s in files.listStatus(root)]
    return sorted(int(n) for n in names if n.isdigit())


def land_transactions(transactions: DataFrame, path: str) -> None:
    """Keep typed transactions as Parquet, one folder per month of the transaction date.

    Done once, it replaces text parsing in every later run by a column-pruned scan. The rebalance
    hint lets adaptive execution split a month that holds much of the data over several writers.
    """
    (with_amount(transactions)
     .withColumn("date_month", F.date_format("date", "yyyy-MM"))
     .hint("rebalance", F.col("date_month"))
     .write.mode("overwrite").partitionBy("date_month").parquet(path))
