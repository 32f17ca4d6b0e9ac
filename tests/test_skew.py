"""Keys with very many rows: sliced and grouped plans agree with brute force."""

import random
from datetime import timedelta

import pytest

from ledgerlens.operators import risk, sequences
from rows import NOON, make



@pytest.fixture(scope="module")
def uneven(spark):
    """One card and one empty card hold most rows; times are crowded and often equal."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        card = 1 if i % 3 == 0 else None if i % 7 == 0 else rng.randrange(2, 30)
        date = NOON + timedelta(seconds=rng.choice([0, 1, 2, 5, 3599, 3600, 3601, 7200, 90000]),
                                microseconds=rng.choice([0, 1, 999999]))
        rows.append({"card_id": card, "date": None if rng.random() < 0.05 else date,
                     "client_id": rng.randrange(5), "merchant_id": rng.randrange(8),
                     "mcc": rng.choice([None, 1, 2, 3]),
                     "errors": rng.choice([None, "", "Bad PIN", "Bad CVV", "Bad PIN"])})
    rng.shuffle(rows)
    return make(spark, rows).cache()


def in_order(df, key):
    groups = {}
    for r in df.collect():
        groups.setdefault(r[key], []).append(r)
    for rows in groups.values():
        rows.sort(key=lambda r: (r["date"] is not None, r["date"] or NOON, r["id"]))
    return groups


def second(r):
    return None if r["date"] is None else int((r["date"] - NOON) / timedelta(seconds=1))


def values(df, name):
    rows = df.collect()
    got = {r["id"]: r[name] for r in rows}
    assert len(got) == len(rows)
    return got


def test_time_since_previous(uneven):
    want = {}
    for rows in in_order(uneven, "card_id").values():
        before = None
        for r in rows:
            now = second(r)
            want[r["id"]] = None if now is None or before is None else now - before
            before = now
    assert values(sequences.time_since_previous(uneven), "seconds") == want
    assert values(sequences.time_since_previous(uneven, slices=7), "seconds") == want


def test_consecutive_errors(uneven):
    want = {}
    for rows in in_order(uneven, "card_id").values():
        run = 0
        for r in rows:
            run = run + 1 if r["errors"] else 0
            want[r["id"]] = run
    assert values(sequences.consecutive_errors(uneven), "error_run") == want
    assert values(sequences.consecutive_errors(uneven, slices=7), "error_run") == want


def test_runs_longer_than_a_slice(spark):
    df = make(spark, [{"errors": "Bad PIN" if i != 3 else None, "date": NOON + timedelta(minutes=i)}
                      for i in range(200)])
    got = values(sequences.consecutive_errors(df, slices=9), "error_run")
    assert got == {i + 1: (i + 1 if i < 3 else i - 3) for i in range(200)}


@pytest.mark.parametrize("seconds", [3600, 86400])
def test_velocity(uneven, seconds):
    want = {}
    for rows in in_order(uneven, "card_id").values():
        for r in rows:
            now = second(r)
            want[r["id"]] = None if now is None else sum(
                1 for o in rows if o["date"] is not None and now - seconds <= second(o) <= now)
    assert values(sequences.velocity(uneven, seconds), "velocity") == want


@pytest.mark.parametrize("function, other, name", [
    (sequences.first_at_merchant, "merchant_id", "is_first_at_merchant"),
    (sequences.first_in_mcc, "mcc", "is_first_in_mcc")])
def test_first(uneven, function, other, name):
    dated = {}
    for r in uneven.collect():
        if r[other] is not None:
            rank = (r["date"] is None, r["date"] or NOON, r["id"])
            pair = (r["client_id"], r[other])
            dated[pair] = min(dated.get(pair, rank), rank)
    firsts = {rank[2] for rank in dated.values()}
    assert values(function(uneven), name) == {r["id"]: r["id"] in firsts for r in uneven.collect()}


def test_first_keeps_rows_with_repeated_ids(spark):
    df = make(spark, [{"id": 1}, {"id": 1}, {"id": 2, "date": NOON}, {"id": 3, "merchant_id": None}])
    got = sequences.first_at_merchant(df).collect()
    assert sorted(r["id"] for r in got) == [1, 1, 2, 3]
    assert sum(r["is_first_at_merchant"] for r in got) == 1


def test_client_indicators(spark):
    """One client has a third of the rows, and many values of everything."""
    rng = random.Random(8)
    rows = [{"client_id": 1 if i % 3 == 0 else None if i % 10 == 1 else rng.randrange(2, 9),
             "card_id": rng.choice([None, i % 40]), "merchant_id": rng.randrange(200),
             "merchant_city": rng.choice([None, "", "ONLINE", f"city {i % 90}"]),
             "date": None if i % 13 == 0 else NOON + timedelta(hours=rng.randrange(4000)),
             "amount": rng.choice(["?", f"${i}.25"]), "errors": rng.choice([None, "Bad PIN"])}
            for i in range(900)]
    df = make(spark, rows)
    want = {}
    for r in df.collect():
        want.setdefault(r.client_id, []).append(r)
    got = {r.client_id: r for r in risk.client_indicators(df).collect()}
    assert set(got) == set(want)
    for client, own in want.items():
        r = got[client]
        sizes = [len({x for x in values if x is not None}) for values in (
            [o.card_id for o in own], [o.merchant_city for o in own],
            [o.date and o.date.date() for o in own], [o.merchant_id for o in own])]
        assert [r.cards, r.cities, r.active_days, r.merchants] == sizes
        assert r.transactions == len(own) and r.errors == sum(o.errors is not None for o in own)
        total = sum(float(o.amount[1:]) for o in own if o.amount != "?")
        assert r.total_amount == pytest.approx(total)


def test_client_indicators_with_a_missing_client(spark):
    df = make(spark, [{"client_id": None, "card_id": None, "amount": "?"}] * 5 + [{"client_id": 1}])
    got = {r["client_id"]: r for r in risk.client_indicators(df).collect()}
    assert got[None]["transactions"] == 5 and got[None]["cards"] == 0
    assert got[None]["total_amount"] is None and got[None]["active_days"] == 1
