"""Month by month equals the whole run, also when a month comes late."""

import random
from datetime import timedelta

import pytest

from ledgerlens.operators import by_month, sequences
from ledgerlens.sources import writers
from rows import NOON, make


def rows(n, seed):
    rng = random.Random(seed)
    return [{"id": i, "card_id": rng.choice([None, 1, 1, 1, 2, 3, 4, 5]),
             "client_id": rng.choice([None, 1, 1, 2, 3]), "merchant_id": rng.randrange(12),
             "mcc": rng.choice([None, 1, 2, 3, 4]), "errors": rng.choice([None, "", "E", "E", "E"]),
             "date": None if rng.random() < 0.04 else NOON + timedelta(
                 hours=rng.choice([0, 5, 24 * rng.randrange(150), rng.randrange(3000)]))}
            for i in range(n)]


@pytest.fixture(scope="module")
def all_rows():
    return rows(500, 3)


def late(r):
    """Rows of one month that come after the months behind it."""
    return r["date"] is not None and r["date"].month == 3 and r["id"] % 3 == 0


def landed(spark, tmp_path, some):
    path = str(tmp_path / "landed")
    writers.land_transactions(make(spark, some), path)
    return path


def as_set(df, *columns):
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert len(got) == len(set(got))
    return set(got)


def whole_sequences(spark, some):
    t = make(spark, some)
    seconds = as_set(sequences.time_since_previous(t), "id", "seconds")
    runs = dict(as_set(sequences.consecutive_errors(t), "id", "error_run"))
    return {(i, s, runs[i]) for i, s in seconds}


def test_one_plan_gives_both_features(spark, all_rows):
    for slices in (1, 7):
        features, _ = by_month.card_sequences(make(spark, all_rows), slices=slices)
        assert as_set(features, "id", "seconds", "error_run") == whole_sequences(spark, all_rows)


def test_card_sequences(spark, tmp_path, all_rows):
    path = str(tmp_path / "kept")
    first = [r for r in all_rows if not late(r)]
    facts = landed(spark, tmp_path, first)
    built = by_month.build_card_sequences(spark, facts, path)
    assert built == ["undated", "2024-01", "2024-02", "2024-03", "2024-04", "2024-05"]
    assert by_month.build_card_sequences(spark, facts, path) == []
    got = as_set(by_month.features_of(spark, path), "id", "seconds", "error_run")
    assert got == whole_sequences(spark, first)
    facts = landed(spark, tmp_path, all_rows)
    assert by_month.build_card_sequences(spark, facts, path, "2024-03") == ["2024-03", "2024-04", "2024-05"]
    got = as_set(by_month.features_of(spark, path), "id", "seconds", "error_run")
    assert got == whole_sequences(spark, all_rows)


def test_a_new_month_reads_only_itself(spark, tmp_path, all_rows):
    path = str(tmp_path / "kept")
    old = [r for r in all_rows if r["date"] is None or r["date"].month < 5]
    by_month.build_card_sequences(spark, landed(spark, tmp_path, old), path)
    facts = landed(spark, tmp_path, all_rows)
    for m in (1, 2, 3, 4):  # what is built needs its facts no more
        spark.read.parquet(facts).drop("date_month").limit(0).write.mode("overwrite").parquet(
            f"{facts}/date_month=2024-0{m}")
    assert by_month.build_card_sequences(spark, facts, path) == ["2024-05"]
    got = as_set(by_month.features_of(spark, path), "id", "seconds", "error_run")
    assert got == whole_sequences(spark, all_rows)


@pytest.mark.parametrize("other, whole", [("merchant_id", sequences.first_at_merchant),
                                          ("mcc", sequences.first_in_mcc)])
def test_first_uses(spark, tmp_path, all_rows, other, whole):
    path = str(tmp_path / "kept")
    for some, changed, built in (
            ([r for r in all_rows if not late(r)], None, 6), (all_rows, "2024-03", 4)):
        facts = landed(spark, tmp_path, some)
        assert len(by_month.build_first_uses(spark, facts, other, path, changed)) == built
        got = as_set(by_month.features_of(spark, path), "id", "is_first")
        assert got == {(r[0], r[-1]) for r in whole(make(spark, some)).collect()}
    ledger = spark.read.parquet(f"{path}/ledger").drop("month")
    assert ledger.count() == ledger.distinct().count()
