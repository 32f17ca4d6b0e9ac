"""The stateful stream says in the right batch what the batch analysis says of the same rows."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import Row

from ledgerlens.config import Thresholds
from ledgerlens.operators import indicators
from ledgerlens.streaming import live_alerts
from ledgerlens.streaming.live_alerts import AMOUNT, CITIES, COUNT, LATE
from rows import NOON, SCHEMA, make

LIMITS = Thresholds(daily_count=2, cities=2, daily_amount=100.0)


def deliver(spark, tmp_path, rows):
    make(spark, rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def run(spark, tmp_path, **options):
    live = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "in"))
    live_alerts.start_live_alerts(live, str(tmp_path / "out"), str(tmp_path / "check"), LIMITS,
                                  **options).awaitTermination()
    rows = live_alerts.all_alerts(spark, str(tmp_path / "out")).collect()
    return sorted(((r.batch, r.card_id, str(r.day), r.criterion, r.over) for r in rows), key=str)


def row(card, hours, amount="$10.00", city="Lyon"):
    return {"card_id": card, "date": NOON + timedelta(hours=hours), "amount": amount,
            "merchant_city": city}


def test_the_batch_that_crosses_gives_the_alert_also_after_a_restart_within_the_day(spark, tmp_path):
    day = str(NOON.date())
    deliver(spark, tmp_path, [row(1, 0), row(1, 1), row(2, 0, "$100.00")])
    assert run(spark, tmp_path) == []
    deliver(spark, tmp_path, [row(1, 2, city="Nice"), row(2, 1, "$0.01", "")])  # a new run
    want = [(1, 1, day, COUNT, True), (1, 2, day, AMOUNT, True)]
    assert run(spark, tmp_path) == want
    deliver(spark, tmp_path, [row(1, 3, city="Paris"), row(2, 2, "$-50.00", "ONLINE")])
    deliver(spark, tmp_path, [row(1, 4, city="Brest")])  # over already: no second alert
    assert run(spark, tmp_path) == want + [(2, 1, "None", CITIES, True), (2, 2, day, AMOUNT, False),
                                           (2, 2, day, COUNT, True)]
    standing = live_alerts.standing_alerts(spark, str(tmp_path / "out")).collect()
    assert {(r.card_id, r.criterion) for r in standing} == {(1, COUNT), (1, CITIES), (2, COUNT)}


def test_late_rows_are_counted_and_closed_days_cleared(spark, tmp_path):
    days = [0, 1, 10, 0, 9, 11]
    for d in days:
        deliver(spark, tmp_path, [row(1, 24 * d), row(1, 24 * d)])
    got = run(spark, tmp_path, keep_days=2, clear_after_ms=0)
    first, ninth = str(NOON.date()), str((NOON + timedelta(days=9)).date())
    assert got == [(3, 1, first, LATE, True)]
    deliver(spark, tmp_path, [row(1, 24 * 9), row(1, 24 * 11)])
    got = run(spark, tmp_path, keep_days=2, clear_after_ms=0)
    assert got[1:] == [(6, 1, ninth, COUNT, True), (6, 1, str((NOON + timedelta(days=11)).date()),
                                                    COUNT, True)]
    late = [r for r in live_alerts.all_alerts(spark, str(tmp_path / "out")).collect()
            if r.criterion == LATE]
    assert [(r.transactions, r.cents) for r in late] == [(2, 2000)]
    state = (spark.read.format("statestore").option("stateVarName", "days")
             .load(str(tmp_path / "check")).collect())
    held = {r["user_map_key"]["day"] if "user_map_key" in r.__fields__ else r["key"][0]
            for r in state}
    assert first not in held and ninth in held


def test_equals_the_batch_analysis(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        rows.append({"card_id": 1 if i % 3 == 0 else None if i % 11 == 0 else rng.randrange(2, 25),
                     "date": None if i % 17 == 0 else NOON + timedelta(hours=rng.randrange(80)),
                     "amount": rng.choice(["$60.00", "$-45.50", "$55.10", "?", None]),
                     "merchant_city": rng.choice(["A", "B", "C", "D", "ONLINE", "", None])})
    for k in range(4):
        deliver(spark, tmp_path, rows[k::4])
    run(spark, tmp_path)
    got = {(r.card_id, r.day, r.criterion)
           for r in live_alerts.standing_alerts(spark, str(tmp_path / "out")).collect()}
    t = make(spark, rows)
    want = set()
    for r in indicators.card_days(t).collect():
        want |= {(r.card_id, r.day, COUNT)} if r.transactions > 2 else set()
        want |= {(r.card_id, r.day, AMOUNT)} if r.cents is not None and r.cents > 10000 else set()
    want |= {(r.card_id, None, CITIES) for r in indicators.card_city_counts(t).collect()
             if r.physical_cities > 2}
    assert got == want


class Kept:
    """One state variable of a card in memory; every call is counted."""

    def __init__(self, calls):
        self.calls, self.held = calls, {}

    def __getattr__(self, name):
        def call(*given):
            self.calls.append(name)
            key, value = (given if name == "updateValue" else (given or (None,))[0:1] * 2)
            if name in ("get", "getValue"):
                return self.held.get(None if name == "get" else key)
            if name == "containsKey":
                return key in self.held
            if name == "removeKey":
                return self.held.pop(key, None)
            if name == "update":
                self.held[None] = value
            else:
                assert name == "updateValue"
                self.held[key] = value
        return call


class Handle:
    def __init__(self):
        self.calls = []

    def getMapState(self, *_):
        return Kept(self.calls)

    getValueState = getMapState


def one_batch(limits, days, cities):
    got = limits.handleInputRows(
        (1,), [Row(day=NOON.date() + timedelta(d), city=c, transactions=2, cents=150)
               for d in days for c in cities], None)
    return [(r.criterion, r.over, r.transactions, r.cities) for r in got]


def test_calls_on_the_state_do_not_grow_with_days_and_cities():
    counts = []
    for n in (1, 60):
        handle = Handle()
        limits = live_alerts.CardLimits(Thresholds(2 * n, n, 1e9), 100, 0)
        limits.init(handle)
        names = [f"c{k:03}" for k in range(n)]
        assert one_batch(limits, range(n), names) == []
        handle.calls.clear()
        assert one_batch(limits, range(n), [*names, "new"]) == [
            (COUNT, True, 4 * n + 2, None)] * n + [(CITIES, True, None, n + 1)]
        counts.append(len(handle.calls))
    assert counts[0] == counts[1] <= 4


def test_cities_beyond_the_named_ones_are_counted_once():
    handle = Handle()
    cities = live_alerts.NAMED + 50
    limits = live_alerts.CardLimits(Thresholds(10 ** 9, cities, 1e9), 100, 0)
    limits.init(handle)
    names = [f"c{k:04}" for k in range(cities)]
    for _ in range(2):
        for at in range(0, cities, 70):
            assert one_batch(limits, [1], names[at:at + 70]) == []
    assert one_batch(limits, [0], ["more"]) == [(CITIES, True, None, cities + 1)]
    assert len(limits.cities.held) == 51


@pytest.mark.parametrize("name", list(live_alerts.SETTINGS))
def test_settings_are_put_back(spark, name):
    before = spark.conf.get(name, None)
    with live_alerts._settings(spark):
        assert spark.conf.get(name) == live_alerts.SETTINGS[name]
    assert spark.conf.get(name, None) == before
