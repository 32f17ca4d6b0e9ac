"""Figures from kept sketches: within their error bounds, and from no other table."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import amounts, quality, risk, sketches
from ledgerlens.sources import driver_tables
from rows import NOON, make
from test_plans import plan


@pytest.fixture(scope="module")
def facts(spark, sf):
    return driver_tables.transactions(spark, sf).cache()


@pytest.fixture
def kept(spark, facts, tmp_path):
    path = str(tmp_path / "months")
    sketches.keep_sketches(sketches.monthly_sketches(facts), path)
    return path


def test_volumetry(spark, facts, kept):
    got = sketches.approximate_volumetry(sketches.kept_sketches(spark, kept)).first()
    exact = quality.volumetry(facts).first()
    assert got.transactions == exact.transactions
    bound = 3 * sketches.SketchSize.error(sketches.DEFAULT.precision)
    for name in sketches.KEYS:
        assert abs(got[name] - exact[name]) <= bound * exact[name] + 1


def test_only_the_kept_rows_are_read(spark, kept):
    for df in (sketches.approximate_volumetry(sketches.kept_sketches(spark, kept)),
               sketches.approximate_quantiles(sketches.kept_sketches(spark, kept), [0.5])):
        text = plan(df)
        assert text.count("Location: ") == text.count(kept) > 0
    march = plan(sketches.approximate_volumetry(
        sketches.kept_sketches(spark, kept, "2024-03", "2024-03")))
    assert "PartitionFilters: []" not in march


def test_a_span_of_months_and_a_corrected_month(spark, facts, kept):
    months = sorted(r[0] for r in facts.select(F.date_format("date", "yyyy-MM")).distinct().collect())
    first, last = months[1], months[2]
    span = facts.where(F.date_format("date", "yyyy-MM").between(first, last))
    got = sketches.approximate_volumetry(sketches.kept_sketches(spark, kept, first, last)).first()
    assert got.transactions == span.count()
    assert abs(got.clients - span.select("client_id").distinct().count()) <= 2
    half = facts.where((F.date_format("date", "yyyy-MM") == first) & (F.col("id") % 2 == 0))
    sketches.keep_sketches(sketches.monthly_sketches(half), kept)
    got = sketches.approximate_volumetry(sketches.kept_sketches(spark, kept)).first()
    lost = facts.where((F.date_format("date", "yyyy-MM") == first) & (F.col("id") % 2 != 0)).count()
    assert got.transactions == facts.count() - lost


def test_clients(spark, facts, tmp_path):
    path = str(tmp_path / "clients")
    sketches.keep_sketches(sketches.monthly_client_sketches(facts), path)
    got = {r.client_id: r for r in sketches.approximate_client_indicators(
        sketches.kept_sketches(spark, path)).collect()}
    exact = {r.client_id: r for r in risk.client_indicators(facts).collect()}
    assert set(got) == set(exact)
    for client, r in exact.items():
        for name in r.__fields__:
            if name in sketches.OF_CLIENT:
                assert abs(got[client][name] - r[name]) <= 0.05 * r[name] + 1, name
            else:
                assert got[client][name] == r[name], name


def test_quantiles(spark, facts, kept):
    wanted = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = sketches.approximate_quantiles(sketches.kept_sketches(spark, kept), wanted)
    errors = {r.probability: r.rank_error for r in sketches.rank_errors(facts, got).collect()}
    assert sorted(errors) == wanted and max(errors.values()) < 0.01
    exact = amounts.exact_amount_quantiles(facts, wanted)
    assert all(r.rank_error == 0 for r in sketches.rank_errors(facts, exact).collect())


def test_edges(spark, tmp_path):
    rows = [{"client_id": None, "amount": "?", "date": None}, {"client_id": 1, "amount": "?"},
            {"client_id": 1, "amount": "$5.00", "date": NOON + timedelta(days=40)}]
    path = str(tmp_path / "edges")
    df = make(spark, rows)
    sketches.keep_sketches(sketches.monthly_sketches(df), path)
    kept = sketches.kept_sketches(spark, path)
    got = sketches.approximate_volumetry(kept).first()
    assert (got.transactions, got.clients) == (3, 2)
    assert [r.amount for r in sketches.approximate_quantiles(kept, [0.5]).collect()] == [5.0]
    nothing = sketches.monthly_sketches(df.limit(0))
    assert tuple(sketches.approximate_volumetry(nothing).first()) == (0, 0, 0, 0)
    assert [r.amount for r in sketches.approximate_quantiles(nothing, [0.5]).collect()] == [None]
