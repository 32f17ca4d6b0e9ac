"""Ordered features kept month by month.

What the order needs of the past is kept beside the features: for the cards, the last row and the
open run of errors at the end of each month; for the clients, which merchants or codes they have
used. A new month reads its own facts and that table, not the facts before it. A month that is
landed again rebuilds itself and what follows; what comes before it stays.

The facts have a column ``date_month`` as ``writers.land_transactions`` lays them out, so a month is
one folder of them. Rows without a date come before all months for cards and after all of them for
first uses, as in the features of whole tables. Each month's folder is overwritten as a whole, and
one that is not finished is built again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.dates import epoch_second
from ledgerlens.functions.flags import has_error
from ledgerlens.operators import sequences
from ledgerlens.plans.staging import drop_staged, stage

UNDATED = "undated"
CARRY = "card_id bigint, last bigint, open bigint"


def landed_months(spark: SparkSession, landed: str) -> list[str | None]:
    """The months of landed facts by the names of their folders, None for rows without a date."""
    root = spark._jvm.org.apache.hadoop.fs.Path(landed)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName().partition("date_month=") for s in files.listStatus(root)]
    found = [None if m == "__HIVE_DEFAULT_PARTITION__" else m for _, sign, m in names if sign]
    return [None] * (None in found) + sorted(m for m in found if m is not None)


def _of_month(facts: DataFrame, month: str | None) -> DataFrame:
    own = F.col("date_month")
    return facts.where(own.isNull() if month is None else own == month).drop("date_month")


def _folder(path: str, table: str, month: str | None) -> str:
    return f"{path}/{table}/month={month or UNDATED}"


def _finished(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _to_build(spark: SparkSession, order: list[str | None], path: str, table: str,
              changed: str | None) -> int:
    """Place in ``order`` of the first month that is not built, or is ``changed``."""
    for i, month in enumerate(order):
        if month == (changed or "") or changed == UNDATED and month is None or not _finished(
                spark, _folder(path, table, month)):
            return i
    return len(order)


def _write(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").parquet(folder)


def card_sequences(transactions: DataFrame, before: DataFrame | None = None,
                   slices: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(id, card_id, seconds, error_run) of each row, and (card_id, last, open) for what follows.

    ``before`` is the second result for the rows before. Time since the previous row and runs of
    errors come from one sliced plan: within a slice by windows, along a card by one row a slice.
    """
    spark = transactions.sparkSession
    before = spark.createDataFrame([], CARRY) if before is None else before
    rows = sequences._slice(transactions.select(
        "id", "card_id", "date", has_error().alias("failed")), "card_id", slices)
    order = sequences._in_slice("card_id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (rows.withColumn("second", epoch_second(F.col("date")))
              .withColumn("previous", F.lag("second").over(order))
              .withColumn("position", F.row_number().over(order).cast("bigint"))
              .withColumn("last_ok", F.max(F.when(~F.col("failed"), F.col("position"))).over(upto)))
    ends = placed.groupBy("card_id", "slice").agg(
        F.count("*").alias("n"), F.max("second").alias("last"), F.max("last_ok").alias("last_ok"))
    old = before.select(F.col("card_id").alias("old_card"), F.col("last").alias("old_last"),
                        F.col("open").alias("old_open"))
    ends = ends.join(old, F.col("card_id").eqNullSafe(F.col("old_card")), "left").drop("old_card")
    along = Window.partitionBy("card_id").orderBy("slice")
    sofar = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # positions counted through the card; a run from before is open until the first row without error
    ends = stage(ends.withColumn("total", F.sum("n").over(sofar))
                 .withColumn("ok_at", F.max(F.col("total") - F.col("n") + F.col("last_ok"))
                             .over(sofar))
                 .withColumn("open", F.when(F.col("ok_at").isNotNull(),
                                            F.col("total") - F.col("ok_at"))
                             .otherwise(F.col("total") + F.coalesce("old_open", F.lit(0)))),
                 "slice_ends")
    carry = ends.select("card_id", "slice",
                        F.coalesce(F.lag("last").over(along), "old_last").alias("carried"),
                        F.coalesce(F.lag("open").over(along), "old_open", F.lit(0)).alias("run"))
    run = F.when(F.col("last_ok").isNull(), F.col("position") + F.col("run")).otherwise(
        F.col("position") - F.col("last_ok"))
    features = sequences._join_carry(placed, carry, "card_id").select(
        "id", "card_id", (F.col("second") - F.coalesce("previous", "carried")).alias("seconds"),
        F.when(F.col("failed"), run).otherwise(0).alias("error_run"))
    now = ends.groupBy("card_id").agg(
        F.coalesce(F.max_by("last", "slice"), F.max("old_last")).alias("last"),
        F.max_by("open", "slice").alias("open"))
    idle = before.join(now.select(F.col("card_id").alias("busy")),
                       F.col("card_id").eqNullSafe(F.col("busy")), "left_anti")
    return features, now.unionByName(idle)


def build_card_sequences(spark: SparkSession, landed: str, path: str,
                         changed: str | None = None) -> list[str]:
    """Build the months of the facts under ``landed`` that are missing under ``path``; with
    ``changed``, also that month and all after it. Returns the months built."""
    facts, order = spark.read.parquet(landed), landed_months(spark, landed)
    built = order[_to_build(spark, order, path, "carry", changed):]
    for month in built:
        place = order.index(month)
        before = (spark.read.schema(CARRY).parquet(_folder(path, "carry", order[place - 1]))
                  if place else None)
        features, carry = card_sequences(_of_month(facts, month), before)
        _write(features, _folder(path, "features", month))
        _write(carry, _folder(path, "carry", month))  # last: the month is built when it is there
    return [m or UNDATED for m in built]


def build_first_uses(spark: SparkSession, landed: str, other: str, path: str,
                     changed: str | None = None) -> list[str]:
    """First uses of a merchant or code by a client, as ``build_card_sequences``.

    The ledger has one row of each client and value, in the month of its first use. A month's own
    firsts, one row a pair, are looked up there; its other rows need no look-up.
    """
    facts, months = spark.read.parquet(landed), landed_months(spark, landed)
    order = [m for m in months if m is not None] + [None] * (None in months)
    built = order[_to_build(spark, order, path, "ledger", changed):]
    if None in order and built and built[-1] is not None:
        built.append(None)
    for month in built:
        place, own = order.index(month), _of_month(facts, month)
        marked = stage(sequences._first_in_pair(own, other, "leads"), "marked")
        pairs = marked.where("leads").select("client_id", other, "id")
        earlier = [_folder(path, "ledger", m) for m in order[:place]]
        if earlier:
            ledger = spark.read.schema(pairs.drop("id").schema).parquet(*earlier).select(
                F.col("client_id").alias("old_client"), F.col(other).alias("old_value"))
            known = F.col("client_id").eqNullSafe(F.col("old_client")) & (
                F.col(other) == F.col("old_value"))
            pairs = stage(pairs.join(ledger, known, "left_anti"), "first_uses")
        firsts = pairs.select("id", "client_id", other, F.lit(True).alias("is_first"))
        leaders = marked.where("leads").select("id", "client_id", other)
        same = F.col("client_id").eqNullSafe(F.col("first_client")) & (
            F.col(other) == F.col("first_value"))
        again = leaders.join(pairs.select(F.col("client_id").alias("first_client"),
                                          F.col(other).alias("first_value")), same, "left_anti")
        rest = again.unionByName(marked.where("not leads").select("id", "client_id", other))
        _write(firsts.unionByName(rest.withColumn("is_first", F.lit(False))),
               _folder(path, "features", month))
        _write(pairs.drop("id"), _folder(path, "ledger", month))
        drop_staged(marked)
    return [m or UNDATED for m in built]


def features_of(spark: SparkSession, path: str) -> DataFrame:
    """The features of all months."""
    return spark.read.parquet(f"{path}/features").drop("month")
