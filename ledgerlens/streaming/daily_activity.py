"""Daily card checks on a live stream.

Counts and cents of a card's day add up, so each micro-batch is reduced for itself and written to a
folder named by the batch; a batch that runs again after a failure overwrites its folder, so nothing
is counted twice. Readers sum over the batches. There is no state and no watermark: a row counts
however late it comes. ``compact`` replaces the folders of past batches by one table of their sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.config import Thresholds
from ledgerlens.functions.money import cents, dollars, with_amount

SCHEMA = "card_id bigint, day date, transactions bigint, cents bigint"


def daily_activity(transactions: DataFrame) -> DataFrame:
    """Count and cents per card and day."""
    return (with_amount(transactions).groupBy("card_id", F.to_date("date").alias("day"))
            .agg(F.count("*").alias("transactions"),
                 F.sum(cents(F.col("amount_clean"))).alias("cents")))


def start_daily_activity(transactions: DataFrame, path: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """Write every batch's sums under ``path``; by default all that is there now, then stop."""
    def save(rows: DataFrame, batch: int) -> None:
        daily_activity(rows).write.mode("overwrite").parquet(f"{path}/batches/batch={batch}")

    return (transactions.writeStream.foreachBatch(save)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def _numbers(spark: SparkSession, folder: str, finished: bool = False) -> list[int]:
    """Numbers in the names of the folders ``name=number``, of whole tables only if ``finished``."""
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    root = path_class(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = [s.getPath() for s in files.listStatus(root) if "=" in s.getPath().getName()]
    return sorted(int(p.getName().partition("=")[2]) for p in found
                  if not finished or files.exists(path_class(p, "_SUCCESS")))


def finished_folders(spark: SparkSession, folder: str) -> list[str]:
    """The folders ``batch=number`` of finished batches."""
    return [f"{folder}/batch={b}" for b in _numbers(spark, folder, finished=True)]


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame, list[int], list[int]]:
    """All rows that count, the compacted tables and the batches that are not in the last one."""
    compacted = _numbers(spark, f"{path}/compacted", finished=True)
    done = compacted[-1] if compacted else -1
    batches = [b for b in _numbers(spark, f"{path}/batches", finished=True) if b > done]
    folders = [f"{path}/batches/batch={b}" for b in batches] + [
        f"{path}/compacted/upto={done}"] * bool(compacted)
    rows = (spark.read.schema(SCHEMA).parquet(*folders) if folders
            else spark.createDataFrame([], SCHEMA))
    return rows, compacted, batches


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("card_id", "day").agg(F.sum("transactions").alias("transactions"),
                                              F.sum("cents").alias("cents"))


def current_activity(spark: SparkSession, path: str) -> DataFrame:
    """Count and total of every card and day over all batches."""
    return _summed(_parts(spark, path)[0])


def compact(spark: SparkSession, path: str) -> None:
    """Put the sums of all finished batches but the newest in one table, then delete their folders.

    The newest batch stays, since it may still be run again. Readers go by the newest finished
    table, so a stop at any point loses nothing; readers that began before should be done.
    """
    rows, compacted, batches = _parts(spark, path)
    if len(batches) < 2:
        return
    upto = batches[-2]
    folders = [f"{path}/batches/batch={b}" for b in batches[:-1]] + [
        f"{path}/compacted/upto={c}" for c in compacted[-1:]]
    _summed(spark.read.schema(SCHEMA).parquet(*folders)).write.mode("overwrite").parquet(
        f"{path}/compacted/upto={upto}")
    path_class = spark._jvm.org.apache.hadoop.fs.Path
    old = [f"{path}/batches/batch={b}" for b in _numbers(spark, f"{path}/batches") if b <= upto]
    for folder in old + [f"{path}/compacted/upto={c}" for c in compacted]:
        p = path_class(folder)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def alerts(activity: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Card days above the daily count or the daily amount."""
    over_count = F.col("transactions") > thresholds.daily_count
    over_amount = F.coalesce(F.col("cents") > round(thresholds.daily_amount * 100), F.lit(False))
    return (activity.filter(over_count | over_amount)
            .select("card_id", "day", "transactions", dollars(F.col("cents")).alias("total_amount"),
                    over_count.alias("over_daily_count"), over_amount.alias("over_daily_amount")))
