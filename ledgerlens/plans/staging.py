"""Intermediate tables that several later steps read.

A staged table is written once to a folder that all executors share and read back. The rows behind
it are then computed once however many steps follow, a lost executor costs no recomputation of them,
and the planner knows the true size when it chooses between a broadcast and a shuffled join.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "staged"


def _local(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    scheme = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme()
    return scheme == "file"


def staging_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one inside the warehouse.

    The rule is the same on every master. A warehouse on a machine's own disk is refused where
    executors run on other machines; a configured checkpoint folder is taken as it is, since it may
    be a mounted share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context_folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    if context_folder.isDefined():
        return context_folder.get()
    folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and _local(spark, folder):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{folder}/{FOLDER}"


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the staging folder and return a DataFrame that reads it."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a DataFrame returned by ``stage``; it can't be read afterwards."""
    spark = df.sparkSession
    root = staging_folder(spark)
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    bare = path_class(root).toUri().getPath()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = path_class(folder)
        if not path.toUri().getPath().startswith(bare):
            raise ValueError(f"{folder} is not a staged table")
        path.getFileSystem(configuration).delete(path, True)
