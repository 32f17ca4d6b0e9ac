"""Alerts in the batch in which a card goes over a limit.

State is kept per card: count and cents of its days, and its physical cities. A batch gives a row
when a card goes over a limit, and one when refunds bring a day's total back under it, so the last
row of a card, day and criterion tells how it stands, which is what the batch analysis of the same
rows tells.

Days more than ``keep_days`` before the newest day that earlier batches have brought for the card
are closed. A timer clears them from the state. A row that arrives for a closed day is not lost: it
comes out at once as a row of the criterion ``late``, with its count and cents, and it still counts
for the card's cities. Rows are combined by card, day and city before the shuffle, so a card with
very many rows sends few.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ledgerlens.config import Thresholds
from ledgerlens.functions.flags import is_physical_city
from ledgerlens.functions.money import cents, with_amount
from ledgerlens.streaming.daily_activity import finished_folders

COUNT, AMOUNT, CITIES, LATE = "daily_count", "daily_amount", "cities", "late"
ALERT = ("card_id bigint, day date, criterion string, over boolean, transactions bigint, "
         "cents bigint, cities bigint")
KEEP_DAYS, CLEAR_AFTER_MS = 35, 3_600_000
#: What the stateful stream needs of the session while it starts. Without batches that bring no
#: rows, a run over all that is there ends; timers fire with the next rows.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
NO_DAY = ""  # the key of rows without a date
#: Cities of a card that are kept beside its figures; each city beyond them is an entry of its own.
NAMED = 200


def combined(transactions: DataFrame) -> DataFrame:
    """(card_id, day, city, transactions, cents), combined within each batch of rows of a task."""
    rows = with_amount(transactions).select(
        "card_id", F.to_date("date").alias("day"),
        F.when(is_physical_city(), F.col("merchant_city")).alias("city"),
        F.lit(1).cast("bigint").alias("transactions"), cents(F.col("amount_clean")).alias("cents"))
    names = ["card_id", "day", "city"]

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            groups = pa.Table.from_batches([part]).group_by(names).aggregate(
                [("transactions", "sum"), ("cents", "sum")])
            yield from groups.select([*names, "transactions_sum", "cents_sum"]).rename_columns(
                [*names, "transactions", "cents"]).to_batches()

    return rows.mapInArrow(
        sums, "card_id bigint, day date, city string, transactions bigint, cents bigint")


def _plus(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else a + b


class CardLimits(StatefulProcessor):
    """The state of one card.

    Each call on the state is a trip to the JVM and back, so a card's open days are one entry (JSON,
    under the oldest of them), which ``keep_days`` bounds, and its cities are beside its figures. A
    batch takes the same few calls for a card however many days and cities it brings.
    """

    def __init__(self, thresholds: Thresholds, keep_days: int, clear_after_ms: int):
        self.limits, self.keep, self.clear_after = thresholds, timedelta(keep_days), clear_after_ms
        self.limit_cents = round(thresholds.daily_amount * 100)

    def init(self, handle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day string", "held string")
        self.cities = handle.getMapState("cities", "city string", "seen boolean")
        self.card = handle.getValueState(
            "card", "cities bigint, named string, newest string, oldest string, clearing boolean")

    def _over(self, transactions: int, amount: int | None) -> dict[str, bool]:
        return {COUNT: transactions > self.limits.daily_count,
                AMOUNT: amount is not None and amount > self.limit_cents}

    def _closed(self, newest: str) -> str:
        return (date.fromisoformat(newest) - self.keep).isoformat()

    def _held(self, oldest: str | None) -> dict[str, list]:
        return json.loads(self.days.getValue((oldest or NO_DAY,))[0])

    def _hold(self, held: dict[str, list], oldest: str | None, before: str | None) -> None:
        if oldest != before:
            self.days.removeKey((before or NO_DAY,))
        self.days.updateValue((oldest or NO_DAY,), (json.dumps(held),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        card = self.card.get()
        known, names, newest, oldest, clearing = card or (0, "[]", None, None, False)
        closed = self._closed(newest) if newest else ""
        new_days, new_cities = {}, set()
        for r in rows:
            day = r.day.isoformat() if r.day else NO_DAY
            before = new_days.get(day, (0, None))
            new_days[day] = (before[0] + r.transactions, _plus(before[1], r.cents))
            if r.city is not None:
                new_cities.add(r.city)
        held, first, changed = self._held(oldest) if card else {}, oldest, False
        for day, (n, amount) in sorted(new_days.items()):
            if day != NO_DAY and day < closed:
                yield self._row(key, day, LATE, True, n, amount, None)
                continue
            was = held.get(day, (0, None))
            total = held[day] = (was[0] + n, _plus(was[1], amount))
            changed, was = True, self._over(*was)
            for criterion, over in self._over(*total).items():
                if over != was[criterion]:
                    yield self._row(key, day, criterion, over, *total, None)
            if day != NO_DAY:
                newest, oldest = max(newest or day, day), min(oldest or day, day)
        if changed:
            self._hold(held, oldest, first if card else oldest)
        named = json.loads(names)
        found, new_cities = known, new_cities.difference(named)
        for city in sorted(new_cities):
            if len(named) < NAMED:
                named.append(city)
            elif not self.cities.containsKey((city,)):
                self.cities.updateValue((city,), (True,))
            else:
                continue
            found += 1
        if known <= self.limits.cities < found:
            yield self._row(key, NO_DAY, CITIES, True, None, None, found)
        if newest and not clearing and oldest < self._closed(newest):
            self.handle.registerTimer(
                timerValues.getCurrentProcessingTimeInMs() + self.clear_after)
            clearing = True
        now = (found, json.dumps(named) if new_cities else names, newest, oldest, clearing)
        if now != card:
            self.card.update(now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        found, names, newest, oldest, _ = self.card.get()
        closed = self._closed(newest)
        held = {d: v for d, v in self._held(oldest).items() if d == NO_DAY or d >= closed}
        first = min(d for d in held if d != NO_DAY)
        self._hold(held, first, oldest)
        self.card.update((found, names, newest, first, False))
        yield from ()

    @staticmethod
    def _row(key, day, criterion, over, transactions, amount, cities) -> Row:
        return Row(card_id=key[0], day=date.fromisoformat(day) if day else None,
                   criterion=criterion, over=over, transactions=transactions, cents=amount,
                   cities=cities)

    def close(self) -> None:
        pass


@contextmanager
def _settings(spark: SparkSession):
    """``SETTINGS`` while a query starts; a running query keeps those it started with."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_live_alerts(transactions: DataFrame, path: str, checkpoint: str,
                      thresholds: Thresholds = Thresholds(), keep_days: int = KEEP_DAYS,
                      clear_after_ms: int = CLEAR_AFTER_MS,
                      trigger: dict | None = None) -> StreamingQuery:
    """Write every batch's alerts under ``path``; by default of all that is there now, then stop.

    A batch that runs again after a failure overwrites its folder.
    """
    def save(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/alerts/batch={batch}")

    alerts = combined(transactions).groupBy("card_id").transformWithState(
        CardLimits(thresholds, keep_days, clear_after_ms), ALERT, "Append", "ProcessingTime")
    with _settings(transactions.sparkSession):
        return (alerts.writeStream.foreachBatch(save).outputMode("append")
                .option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())


def all_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All rows with the number of their batch."""
    folders = finished_folders(spark, f"{path}/alerts")
    schema = f"{ALERT}, batch bigint"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/alerts").parquet(*folders)


def standing_alerts(spark: SparkSession, path: str) -> DataFrame:
    """(card_id, day, criterion) of everything that is over its limit now."""
    rows = all_alerts(spark, path).where(F.col("criterion") != LATE)
    return (rows.groupBy("card_id", "day", "criterion").agg(F.max_by("over", "batch").alias("over"))
            .where("over").drop("over"))
