"""Facts and client tables laid out so that joining them by client moves nothing.

Both are written in the same number of buckets of (client, salt). The salt of a fact is a hash of its
id, so a client of very many facts lies in as many buckets as there are salts; a client table has
each client once a salt. Spark then joins bucket with bucket, however large the client table is.

The layout is read from the folder, so a later session needs only the path. Tables are declared in
the session under a name made from the path.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS, SALTS, SALT = 64, 16, "client_salt"


def _table(path: str) -> str:
    return f"by_client_{hashlib.md5(path.encode()).hexdigest()}"


def _write(df: DataFrame, path: str, buckets: int) -> None:
    spark, folder = df.sparkSession, f"{path}/buckets={buckets}"
    spark.sql(f"DROP TABLE IF EXISTS {_table(path)}")
    # a task a bucket, so that a bucket is one sorted file
    (df.repartition(buckets, "client_id", SALT).write.mode("overwrite").option("path", folder)
     .bucketBy(buckets, "client_id", SALT).sortBy("client_id", SALT).saveAsTable(_table(path)))


def land_by_client(transactions: DataFrame, path: str, buckets: int = BUCKETS,
                   salts: int = SALTS) -> None:
    """Write facts for joins by client; ``path`` is a folder of its own."""
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    _write(transactions.withColumn(SALT, salt), path, buckets)


def keep_by_client(clients: DataFrame, path: str, buckets: int = BUCKETS,
                   salts: int = SALTS) -> None:
    """Write a table of one row a client for joins with facts of the same buckets and salts."""
    salted = clients.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    _write(salted, path, buckets)


def read_by_client(spark: SparkSession, path: str) -> DataFrame:
    """The bucketed table under ``path``, with its salt."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(root)]
    (folder,) = [n for n in names if n.startswith("buckets=")]
    if not spark.catalog.tableExists(_table(path)):
        schema = spark.read.parquet(f"{path}/{folder}").schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {_table(path)} ({columns}) USING parquet CLUSTERED BY (client_id, "
                  f"{SALT}) SORTED BY (client_id, {SALT}) INTO {folder.partition('=')[2]} BUCKETS "
                  f"LOCATION '{path}/{folder}'")
    return spark.table(_table(path))
