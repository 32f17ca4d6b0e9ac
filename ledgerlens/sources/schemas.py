"""Typed columns of the input tables. Columns not listed here stay text."""

from __future__ import annotations

from pyspark.sql import types as T

TRANSACTIONS = {
    "id": T.LongType(),
    "date": T.TimestampNTZType(),
    "client_id": T.LongType(),
    "card_id": T.LongType(),
    "amount": T.StringType(),
    "merchant_id": T.LongType(),
    "merchant_city": T.StringType(),
    "merchant_state": T.StringType(),
    "zip": T.StringType(),
    "mcc": T.IntegerType(),
    "errors": T.StringType(),
}
