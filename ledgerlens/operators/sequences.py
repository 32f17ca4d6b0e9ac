"""Features that depend on the order of a card's or client's transactions.

All rows are range partitioned by (key, date, id), which is balanced however uneven keys and times
are, and each partition becomes a slice. Windows run within (key, slice), and one row per key and
slice is carried along the key, so no key's rows need to meet in one task. The sliced rows are
staged, since a range partitioning that is computed twice may cut elsewhere. Order is by date, then
id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.dates import epoch_second
from ledgerlens.functions.flags import has_error
from ledgerlens.plans.staging import stage

#: Groups over which the rows of one pair of client and value are dealt.
FIRST_SALTS = 64


def _slice(df: DataFrame, key: str, slices: int | None) -> DataFrame:
    """Add ``slice``, the number of a row's range: as many as shuffles have partitions, or
    ``slices``."""
    order = (key, "date", "id")
    ranges = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return stage(ranges.withColumn("slice", F.spark_partition_id()), "slices")


def _in_slice(key: str):
    return Window.partitionBy(key, "slice").orderBy("date", "id")


def _join_carry(rows: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    c = carry.withColumnsRenamed({key: "carry_key", "slice": "carry_slice"})
    same = F.col(key).eqNullSafe(F.col("carry_key")) & (F.col("slice") == F.col("carry_slice"))
    return rows.join(c, same, "left").drop("carry_key", "carry_slice")


def time_since_previous(transactions: DataFrame, slices: int | None = None) -> DataFrame:
    """Whole seconds since the card's previous transaction; null for the first."""
    rows = _slice(transactions.select("id", "card_id", "date"), "card_id", slices).withColumn(
        "second", epoch_second(F.col("date")))
    ends = rows.groupBy("card_id", "slice").agg(F.max("second").alias("last"))
    along = Window.partitionBy("card_id").orderBy("slice")
    carry = ends.select("card_id", "slice", F.lag("last").over(along).alias("carried"))
    previous = F.lag("second").over(_in_slice("card_id"))
    rows = _join_carry(rows.withColumn("previous", previous), carry, "card_id")
    return rows.select("id", "card_id", (
        F.col("second") - F.coalesce("previous", "carried")).alias("seconds"))


def consecutive_errors(transactions: DataFrame, slices: int | None = None) -> DataFrame:
    """Length of the card's run of errors up to and including each transaction."""
    facts = transactions.select("id", "card_id", "date", has_error().alias("failed"))
    order = _in_slice("card_id")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (_slice(facts, "card_id", slices)
            .withColumn("position", F.row_number().over(order).cast("bigint"))
            .withColumn("last_ok", F.max(F.when(~F.col("failed"), F.col("position"))).over(upto)))
    ends = rows.groupBy("card_id", "slice").agg(F.count("*").alias("n"),
                                                F.max("last_ok").alias("last_ok"))
    along = Window.partitionBy("card_id").orderBy("slice")
    sofar = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    open_runs = (ends.withColumn("total", F.sum("n").over(sofar))
                 .withColumn("ok_at", F.col("total") - F.col("n") + F.col("last_ok"))
                 .withColumn("open", F.col("total")
                             - F.coalesce(F.max("ok_at").over(sofar), F.lit(0))))
    carry = open_runs.select("card_id", "slice", F.lag("open").over(along).alias("carried"))
    run = F.when(F.col("last_ok").isNull(), F.col("position") + F.coalesce("carried", F.lit(0))
                 ).otherwise(F.col("position") - F.col("last_ok"))
    return _join_carry(rows, carry, "card_id").select(
        "id", "card_id", F.when(F.col("failed"), run).otherwise(0).alias("error_run"))


def _running(df: DataFrame, *keys: str) -> DataFrame:
    """Running sum of ``change`` in the order of ``at``, all of the same second included. It grows
    row by row; a sliding frame would add up its whole content again for every row."""
    upto = Window.partitionBy(*keys).orderBy("at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("velocity", F.sum("change").over(upto)).filter("counted")


def _mark(at: Column, change: Column, counted: bool) -> Column:
    return F.struct(at.alias("at"), change.cast("bigint").alias("change"),
                    F.lit(counted).alias("counted"))


def velocity(transactions: DataFrame, seconds: int) -> DataFrame:
    """Transactions of the card in the last ``seconds``, the current one and all of its second
    included. A transaction without a date has no count.

    Transactions are first counted per card and second. A count is added at its second and taken
    away when it has left the period. Time is cut into blocks of ``seconds``, and each second is also
    known to the next block, so that a block holds all it looks back on and has at most three rows
    per second of its length, however busy the card is.
    """
    facts = transactions.select("id", "card_id", epoch_second(F.col("date")).alias("second"))
    second, n = F.col("second"), F.col("n")
    over = second + seconds + 1
    block = F.floor(second / seconds)
    marks = F.array(
        F.struct(block.alias("block"), _mark(second, n, True).alias("m")),
        F.struct((block + 1).alias("block"), _mark(second, n, False).alias("m")),
        F.struct((block + 1).alias("block"), _mark(over, -n, False).alias("m")))
    ticks = (facts.where(second.isNotNull()).groupBy("card_id", "second")
             .agg(F.count("*").alias("n")).select("card_id", F.inline(marks))
             .select("card_id", "block", "m.*"))
    counted = _running(ticks, "card_id", "block").select(
        F.col("card_id").alias("tick_card"), F.col("at").alias("tick"), "velocity")
    matched = F.col("card_id").eqNullSafe(F.col("tick_card")) & (second == F.col("tick"))
    return facts.join(counted, matched, "left").select("id", "card_id", "velocity")


def _first_in_pair(transactions: DataFrame, other: str, name: str) -> DataFrame:
    """Whether a transaction is the client's first with this value of ``other``.

    The rows of a pair are dealt over salted groups and numbered there; only the first of each group
    is compared with the firsts of the pair's other groups. A pair that holds a third of all rows
    still goes to many tasks, and rows that repeat an id stay single rows.
    """
    facts = transactions.select("id", "client_id", other, "date").withColumn(
        "salt", F.pmod(F.xxhash64("id", "date"), F.lit(FIRST_SALTS)))
    order = [F.col("date").asc_nulls_last(), "id"]
    within = Window.partitionBy("client_id", other, "salt").orderBy(*order)
    numbered = facts.withColumn("number", F.row_number().over(within))
    order_key = F.struct(F.col("date").isNull().alias("undated"), "date", "id", "salt")
    among = Window.partitionBy("client_id", other, "leads").orderBy(order_key)
    # rows that don't lead their group need no order among groups; their own salt spreads them
    leads = F.when(F.col("number") == 1, F.lit(-1)).otherwise(F.col("salt")).alias("leads")
    ranked = numbered.select("*", leads).withColumn("place", F.row_number().over(among))
    first = (F.col("number") == 1) & (F.col("place") == 1) & F.col(other).isNotNull()
    return ranked.select("id", "client_id", other, first.alias(name))


def first_at_merchant(transactions: DataFrame) -> DataFrame:
    return _first_in_pair(transactions, "merchant_id", "is_first_at_merchant")


def first_in_mcc(transactions: DataFrame) -> DataFrame:
    return _first_in_pair(transactions, "mcc", "is_first_in_mcc")
