"""Small hand-made transactions."""

from __future__ import annotations

from datetime import datetime
from itertools import count

SCHEMA = ("id bigint, date timestamp_ntz, client_id bigint, card_id bigint, amount string, "
          "merchant_id bigint, merchant_city string, merchant_state string, mcc int, errors string")
NOON = datetime(2024, 1, 3, 12)  # a Wednesday


def make(spark, rows):
    """DataFrame from dicts; whatever a row leaves out gets a plain value."""
    numbers = count(1)
    full = []
    for r in rows:
        base = {"id": next(numbers), "date": NOON, "client_id": 1, "card_id": 10, "amount": "$20.00",
                "merchant_id": 5, "merchant_city": "Lyon", "merchant_state": "RA", "mcc": 5812,
                "errors": None}
        base.update(r)
        full.append(tuple(base.values()))
    return spark.createDataFrame(full, SCHEMA)


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


def by(df, key):
    return {r[key]: r for r in as_dicts(df)}
