"""Hand-made rows for every rule that real tables do not exercise."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.config import LevelCutoffs, Thresholds
from ledgerlens.labels import FRENCH
from ledgerlens.operators import (
    amounts, compare, enrich, errors, features, indicators, quality, risk, suspicion, temporal,
)
from rows import NOON, as_dicts, by, make


def amounts_of(spark, *texts):
    return make(spark, [{"amount": t} for t in texts])


def test_money_text(spark):
    df = amounts.transactions_clean(amounts_of(spark, "$-77.00", "$14.57", "abc", None))
    assert [r["amount_clean"] for r in as_dicts(df)] == [
        Decimal("-77.00"), Decimal("14.57"), None, None]


def test_money_of_any_width_is_read_exactly_or_kept_apart(spark):
    texts = {"$12345678901.00": None, "$999999999999.99": None, "$-999999999999.99": None,
             "$1.5": None, "$1.500": None, "$15e-1": None, "7": None, " 8.25 ": None,
             "$1000000000000.00": "too large", "$1e30": "too large",
             "$1.005": "not whole cents", "$0.001": "not whole cents", "$15e-4": "not whole cents",
             "$1.00000000000000000001": "not whole cents",
             "abc": "not a number", "": "not a number", "$": "not a number", "NaN": "not a number",
             "Infinity": "not a number", "1,000.00": "not a number"}
    df = amounts_of(spark, *texts, None)
    clean = {r.amount: r.amount_clean for r in amounts.transactions_clean(df).collect()}
    assert {t for t, v in clean.items() if v is None} == {t for t, p in texts.items() if p} | {None}
    assert clean["$12345678901.00"] == Decimal("12345678901.00")
    assert clean["$1.500"] == clean["$15e-1"] == Decimal("1.50")
    got = {r.amount: r.reason for r in quality.unreadable_amounts(df).collect()}
    assert got == {t: p for t, p in texts.items() if p}
    summary = as_dicts(quality.quality_summary(df))[0]
    assert summary["unreadable_amounts"] == len(got) and summary["transactions"] == len(texts) + 1
    assert {r.reason: r.transactions for r in quality.unreadable_summary(df).collect()} == {
        p: list(texts.values()).count(p) for p in texts.values() if p}


def test_a_sum_that_no_long_holds_is_an_error_and_no_wrong_figure(spark):
    df = spark.range(100_000).select(F.lit("$999999999999.99").alias("amount"))
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        amounts.amount_statistics(df).collect()


def test_quantiles_of_amounts_far_apart(spark):
    values = [-999999999999.99, -5.0, -0.01, 0.0, 0.01, 9999.99, 10000.0, 10**10, 10**10 + 0.01,
              999999999999.98, 999999999999.99]
    df = amounts_of(spark, *[f"${v:.2f}" for v in values], None, "x")
    for i, p in enumerate([(k + 0.5) / len(values) for k in range(len(values))]):
        got = as_dicts(amounts.exact_amount_quantiles(df, [p]))
        assert [g["amount"] for g in got] == [pytest.approx(values[i], abs=1e-3)]
    assert amounts.exact_amount_quantiles(df.limit(0), [0.5]).count() == 0


def test_band_edges_and_order(spark):
    df = amounts_of(spark, "$9.99", "$10", "$49.99", "$50", "$199.99", "$200")
    got = [(r["band"], r["transactions"]) for r in as_dicts(amounts.amount_bands(df))]
    assert got == [("< 10", 1), ("10 - 50", 2), ("50 - 200", 2), (">= 200", 1)]


def test_null_amount_falls_in_last_band_unless_named(spark):
    df = amounts_of(spark, None, "$1.00")
    assert by(amounts.amount_bands(df), "band")[">= 200"]["transactions"] == 1
    named = by(amounts.amount_bands(df, unknown="unknown"), "band")
    assert set(named) == {"< 10", "unknown"}
    assert as_dicts(amounts.amount_statistics(df))[0]["amounts"] == 1
    assert quality.non_positive_amounts(df).count() == 0


def test_french_labels(spark):
    df = amounts_of(spark, "$5.00", "$300")
    assert [r["band"] for r in as_dicts(amounts.amount_bands(df, FRENCH))] == ["< 10 €", ">= 200 €"]
    assert as_dicts(temporal.transactions_by_weekday(df, FRENCH))[0]["weekday_name"] == "Mercredi"


def test_zero_is_non_positive(spark):
    df = amounts_of(spark, "$0.00", "$0.01", "$-0.01")
    assert as_dicts(quality.non_positive_summary(df))[0] == {
        "non_positive": 2, "non_positive_pct": 66.67}


def test_empty_error_text_is_no_error(spark):
    df = make(spark, [{"errors": None}, {"errors": ""}, {"errors": "Bad PIN"}])
    assert as_dicts(quality.with_errors_summary(df))[0]["with_errors"] == 1
    assert quality.transactions_with_errors(df).count() == 1
    share = as_dicts(errors.error_type_share(df))
    assert share == [{"errors": "Bad PIN", "occurrences": 1, "pct": 100.0, "error_rows": 1,
                      "total_rows": 3}]


def test_missing_values_by_type(spark):
    df = spark.createDataFrame([(None, None, None), ("", float("nan"), 1), (" ", 1.0, 2)],
                               "s string, d double, i int")
    got = by(quality.missing_value_profile(df), "column_name")
    assert [got[c]["missing"] for c in "sdi"] == [2, 2, 1]
    assert got["s"]["missing_pct"] == 66.67 and got["d"]["type"] == "double"


def test_null_counts_as_one_distinct_value(spark):
    df = make(spark, [{"client_id": 1}, {"client_id": 1}, {"client_id": None}])
    assert as_dicts(quality.volumetry(df))[0]["clients"] == 2


def test_two_meanings_of_city(spark):
    df = make(spark, [{"merchant_city": c} for c in ("A", "A", "ONLINE", "", None)])
    assert as_dicts(indicators.card_city_counts(df))[0]["physical_cities"] == 1
    assert as_dicts(indicators.card_indicators(df))[0]["cities"] == 3


def test_category_join_keeps_rows_and_merges_names(spark):
    mcc = spark.createDataFrame([("5812", "Food"), ("3722", "Rail"), ("4112", "Rail")],
                                "mcc string, merchant_category string")
    df = make(spark, [{"mcc": m} for m in (5812, 9999, None, 3722, 4112)])
    joined = enrich.transactions_with_category(df, mcc)
    assert [r["merchant_category"] for r in as_dicts(joined.orderBy("id"))] == [
        "Food", None, None, "Rail", "Rail"]
    assert as_dicts(enrich.top_categories_by_volume(df, mcc)) == [
        {"merchant_category": "Rail", "transactions": 2},
        {"merchant_category": "Food", "transactions": 1}]


def test_thresholds_are_strict(spark):
    rows = ([{"card_id": 1}] * 10 + [{"card_id": 2}] * 11
            + [{"card_id": 3, "merchant_city": c} for c in "ABC"]
            + [{"card_id": 4, "merchant_city": c} for c in "ABCD"]
            + [{"card_id": 5, "amount": "$1000.00"}, {"card_id": 6, "amount": "$1000.01"}])
    df = make(spark, rows)
    cards = lambda d: sorted(r["card_id"] for r in as_dicts(d))
    assert cards(suspicion.suspects_by_daily_count(df)) == [2]
    assert cards(suspicion.suspects_by_cities(df)) == [4]
    assert cards(suspicion.suspects_by_daily_amount(df)) == [6]
    assert cards(suspicion.suspicious_cards(df)) == [2, 4, 6]
    chosen = by(suspicion.suspicious_cards(df), "card_id")
    assert chosen[2]["over_daily_count"] and not chosen[2]["over_cities"]


def test_reason_uses_means_and_counts_online(spark):
    busy = [{"card_id": 1}] * 11 + [
        {"card_id": 1, "date": NOON + timedelta(days=d)} for d in range(1, 30)]
    spender = [{"card_id": 2, "merchant_city": c, "amount": "$400"} for c in ("A", "B", "C", "ONLINE")]
    spender += [{"card_id": 2, "merchant_city": "A", "date": NOON + timedelta(days=d),
                 "amount": "$1.00"} for d in (1, 2)]
    got = by(suspicion.suspect_details(make(spark, busy + spender)), "card_id")
    assert got[1]["reason"] == "" and got[1]["over_daily_count"]
    assert got[2]["reason"] == "Many cities" and not got[2]["over_cities"]
    assert got[2]["over_daily_amount"]


def test_null_day_is_a_day_of_its_own_but_not_active(spark):
    df = make(spark, [{"date": None}] * 11)
    assert suspicion.suspects_by_daily_count(df).count() == 1
    got = as_dicts(suspicion.suspect_details(df))[0]
    assert got["active_days"] == 0 and got["transactions_per_day"] is None


def scored(spark, rows, **kw):
    return by(risk.client_risk(make(spark, rows), **kw), "client_id")


def test_client_without_valid_amount_gets_the_full_amount_part(spark):
    got = scored(spark, [{"client_id": 1, "amount": "x"}, {"client_id": 2}])
    assert got[1]["amount_score"] == 20.0 and got[1]["total_amount"] is None
    assert got[2]["amount_score"] == 10.0


def test_refunds_give_a_negative_part(spark):
    got = scored(spark, [{"client_id": 1, "amount": "$-10.00"}, {"client_id": 2, "amount": "$90"}])
    assert got[1]["amount_score"] == pytest.approx(-2.5)


def test_score_parts_stay_below_their_caps(spark):
    rows = [{"client_id": 1, "errors": "Bad PIN", "date": NOON.replace(hour=1)}] * 5
    rows += [{"client_id": c, "merchant_id": c} for c in range(2, 9)]
    for r in scored(spark, rows).values():
        for part, cap in zip(risk.PARTS, (20, 20, 20, 20, 10, 10)):
            assert r[f"{part}_score"] <= cap


def test_level_edges(spark):
    df = spark.createDataFrame([(60.0,), (59.99,), (40.0,), (20.0,), (19.99,), (None,)], "s double")
    got = [r[0] for r in df.select(risk.risk_level(F.col("s"), LevelCutoffs())).collect()]
    assert got == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "VERY_LOW", "VERY_LOW"]


def test_unclassified_client_is_normal(spark):
    df = make(spark, [{"client_id": 1}, {"client_id": 2}, {"client_id": None}])
    classes = spark.createDataFrame([(1, True)], "client_id bigint, is_suspect boolean")
    rows = as_dicts(compare.classified_transactions(df, classes).orderBy("id"))
    assert [r["is_suspect"] for r in rows] == [True, False, False]
    got = by(compare.group_general_stats(df, classes), "group")
    assert got["NORMAL"]["transactions"] == 2 and got["NORMAL"]["clients"] == 1


def test_night_and_weekend(spark):
    hours = [NOON.replace(hour=h) for h in (0, 5, 6, 23)]
    days = [datetime(2024, 1, d, 12) for d in (7, 8, 6)]  # Sunday, Monday, Saturday
    got = as_dicts(compare.behaviour_flags(make(spark, [{"date": d} for d in hours + days]))
                   .orderBy("id"))
    assert [r["is_night"] for r in got[:4]] == [1, 1, 0, 0]
    assert [r["is_weekend"] for r in got[4:]] == [1, 0, 1]


def test_null_date_has_no_calendar(spark):
    got = as_dicts(temporal.temporal_columns(make(spark, [{"date": None}])))[0]
    assert (got["hour"], got["weekday"], got["weekday_name"], got["month"]) == (None,) * 4
    assert as_dicts(compare.behaviour_flags(make(spark, [{"date": None}])))[0]["is_night"] == 0
    by_day = as_dicts(temporal.transactions_by_weekday(make(spark, [{"date": None}, {}])))
    assert [r["weekday_name"] for r in by_day] == [None, "Wednesday"]


def test_deviation_of_one_amount_is_null(spark):
    classes = spark.createDataFrame([(1, True)], "client_id bigint, is_suspect boolean")
    df = make(spark, [{"client_id": 1}])
    assert as_dicts(compare.group_general_stats(df, classes))[0]["std_amount"] is None
    assert as_dicts(features.client_amount_profile(df))[0]["std_amount"] is None


def test_deviation_adds_up_over_clients(spark):
    values = [(1, 10.0), (1, 30.0), (2, 500.0), (2, 7.5), (3, 12.25)]
    df = make(spark, [{"client_id": c, "amount": f"${v}"} for c, v in values])
    classes = spark.createDataFrame([(1, True), (2, True), (3, True)],
                                    "client_id bigint, is_suspect boolean")
    direct = spark.createDataFrame(values, "c int, v double").agg(F.stddev_samp("v")).first()[0]
    got = as_dicts(compare.group_general_stats(df, classes))[0]
    assert got["std_amount"] == round(direct, 2)


def test_pivot_fills_gaps_with_zero(spark):
    classes = spark.createDataFrame([(1, True), (2, False)], "client_id bigint, is_suspect boolean")
    df = make(spark, [{"client_id": 1}, {"client_id": 2}, {"client_id": 2, "amount": "$600"}])
    assert as_dicts(compare.group_amount_bands(df, classes)) == [
        {"band": "10-50", "NORMAL": 1, "SUSPECT": 1}, {"band": ">= 500", "NORMAL": 1, "SUSPECT": 0}]


def test_all_errors_is_exact(spark):
    rows = [{"card_id": 1, "errors": "Bad PIN"}] * 2 + [{"card_id": 2, "errors": "Bad PIN"}] * 3
    rows += [{"card_id": 2}]
    assert as_dicts(errors.cards_all_errors(make(spark, rows)))[0]["cards"] == 1


def test_combined_errors(spark):
    df = make(spark, [{"errors": "Bad PIN,Bad CVV"}, {"errors": "Bad PIN"}, {"errors": ""}])
    assert by(errors.error_type_share(df), "errors")["Bad PIN,Bad CVV"]["pct"] == 50.0
    assert as_dicts(features.error_causes(df)) == [
        {"cause": "Bad PIN", "occurrences": 2}, {"cause": "Bad CVV", "occurrences": 1}]
    levels = [r["error_suspicion"] for r in
              as_dicts(features.error_suspicion_level(df).orderBy("id"))]
    assert levels == ["MODERATE", "HIGH", None]


def test_category_risk(spark):
    want = {"Money Transfer": "VERY_HIGH", "Airlines": "MODERATE", "Books": None, None: None,
            "Ironwork": "HIGH", "Steelworks": "HIGH"}
    df = spark.createDataFrame([(k,) for k in want], "merchant_category string")
    assert {k: r["mcc_risk_level"] for k, r in by(
        features.mcc_risk_level(df), "merchant_category").items()} == want
    metal = (3000, 3001, 3005, 3066, 3359, 3387, 3389, 3390, 3393, 3405)
    codes = make(spark, [{"mcc": c} for c in (*metal, 4829, 1, None)])
    got = {k: r["mcc_risk_level"] for k, r in by(features.mcc_risk_level(codes, key="mcc"),
                                                "mcc").items()}
    assert got == dict.fromkeys(metal, "HIGH") | {4829: "VERY_HIGH", 1: None, None: None}


def test_typed_cards_and_attributes(spark):
    cards = spark.createDataFrame(
        [(10, "$24295", "YES", "No", "12/2022", "09/2002"), (11, "$0", "?", "YES", "x", None)],
        "card_id bigint, credit_limit string, has_chip string, card_on_dark_web string, "
        "expires string, acct_open_date string")
    typed = by(features.typed_cards(cards), "card_id")
    assert typed[10]["credit_limit"] == Decimal("24295.00") and typed[10]["has_chip"] is True
    assert typed[10]["card_on_dark_web"] is False and str(typed[10]["expires"]) == "2022-12-01"
    assert typed[11]["has_chip"] is None and typed[11]["expires"] is None
    spent = make(spark, [{"card_id": 10, "amount": "$242.95"}, {"card_id": 10, "amount": "$242.95"},
                         {"card_id": 10, "date": datetime(2023, 12, 31)}])
    got = by(features.card_attributes(features.typed_cards(cards), spent, "2024-01-15"), "card_id")
    assert got[10]["utilisation_pct"] == 2.0 and got[10]["card_age_years"] == 21
    assert got[11]["utilisation_pct"] is None and got[11]["card_age_years"] is None


def test_labelled_metrics(spark):
    flags = spark.createDataFrame([(1, True), (2, True), (3, False), (4, False)],
                                  "id int, flagged boolean")
    labels = spark.createDataFrame([(1, True), (2, False), (3, True)], "id int, is_fraud boolean")
    assert as_dicts(features.labelled_metrics(flags, labels)) == [
        {"labelled": 3, "true_positives": 1, "precision": 0.5, "recall": 0.5}]


def test_empty_input(spark):
    df = make(spark, [{}]).filter("id < 0")
    assert as_dicts(quality.volumetry(df))[0] == {
        "transactions": 0, "clients": 0, "cards": 0, "merchants": 0}
    assert as_dicts(quality.quality_summary(df))[0]["non_positive_pct"] is None
    assert as_dicts(amounts.amount_median(df))[0]["median_amount"] is None
    assert as_dicts(amounts.amount_statistics(df))[0]["mean_amount"] is None
    for result in (amounts.amount_bands(df), errors.error_type_share(df),
                   suspicion.suspicious_cards(df, Thresholds()), risk.client_risk(df)):
        assert result.count() == 0
    assert {r["missing_pct"] for r in as_dicts(quality.missing_value_profile(df))} == {0.0}


def test_approximate_quantiles_are_close_in_rank(spark):
    df = amounts_of(spark, *[f"${i}.00" for i in range(1, 2001)])
    exact = as_dicts(amounts.amount_quartiles(df))[0]
    assert exact == {"q1": 500.0, "q2": 1000.0, "q3": 1500.0}
    rough = as_dicts(amounts.amount_quartiles(df, exact=False))[0]
    assert all(abs(rough[q] - exact[q]) <= 20 for q in exact)


def test_quantiles_over_many_slices(spark):
    df = amounts_of(spark, "$-25000.00", "$-3.00", "$7.00", "$40000.00", "$90000.01")
    assert as_dicts(amounts.amount_quartiles(df))[0] == {"q1": -3.0, "q2": 7.0, "q3": 40000.0}
