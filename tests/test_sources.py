"""Readers and writers on small files."""

import json
from decimal import Decimal

import pytest

from ledgerlens.operators import compare, features, risk, suspicion
from ledgerlens.plans.catalogue import CUTOFFS, THRESHOLDS
from ledgerlens.sources import driver_tables, readers, writers
from rows import as_dicts, by, make

CSV = """id,date,client_id,card_id,amount,extra,merchant_id,merchant_city,merchant_state,zip,mcc,errors
1,2010-01-01 00:01:00,1556,2972,$-77.00,a,59935,Beulah,ND,58523.0,5499,
2,2010-01-01 00:02:00,561,4575,$14.57,b,67570,ONLINE,,,5311,"Bad PIN,Bad CVV"
x,not a date,561,4575,oops,c,67570,Vista,CA,92084.0,?,
"""


def test_transactions_from_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(CSV)
    df = readers.read_transactions(spark, str(path))
    types = dict(df.dtypes)
    assert types["id"] == "bigint" and types["date"] == "timestamp_ntz" and types["mcc"] == "int"
    assert types["zip"] == "string" and types["extra"] == "string"
    rows = as_dicts(df)
    assert rows[0]["amount"] == "$-77.00" and rows[0]["errors"] is None
    assert rows[1]["errors"] == "Bad PIN,Bad CVV" and rows[1]["zip"] is None
    assert rows[2]["id"] is None and rows[2]["date"] is None and rows[2]["mcc"] is None


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("mcc,id,amount\n5812,7,$1.00\n")
    assert as_dicts(readers.read_transactions(spark, str(path))) == [
        {"mcc": 5812, "id": 7, "amount": "$1.00"}]


def test_corrupt_lines_are_kept(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,amount\n1,$1.00\n2,$2.00,surplus\n")
    rows = as_dicts(readers.read_transactions(spark, str(path), keep_corrupt=True))
    assert [r["_corrupt_record"] for r in rows] == [None, "2,$2.00,surplus"]
    assert [r["id"] for r in rows] == [1, 2]


def test_cards_and_users_from_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text("id,credit_limit,has_chip\n1,$24295,YES\n")
    (tmp_path / "u.csv").write_text("id,total_debt\n1,$127613\n")
    assert as_dicts(readers.read_cards(spark, str(tmp_path / "c.csv")))[0]["credit_limit"] == "$24295"
    assert as_dicts(readers.read_users(spark, str(tmp_path / "u.csv")))[0]["total_debt"] == "$127613"


def test_mcc_from_one_json_object(spark, tmp_path):
    path = tmp_path / "mcc.json"
    path.write_text(json.dumps({"5812": "Eating Places", "3722": "It's Rail", "4112": None}, indent=2))
    got = by(readers.read_mcc(spark, str(path)), "mcc")
    assert {k: v["merchant_category"] for k, v in got.items()} == {
        "5812": "Eating Places", "3722": "It's Rail", "4112": None}


def test_landed_transactions_read_back_equal(spark, sf, tmp_path):
    path = str(tmp_path / "landed")
    df = driver_tables.transactions(spark, sf)
    writers.land_transactions(df, path)
    back = readers.read_typed_transactions(spark, path)
    assert (tmp_path / "landed" / "date_month=2024-01").exists()
    assert back.select(df.columns).exceptAll(df).count() == 0
    assert back.count() == df.count()
    january = back.filter("date_month = '2024-01'")
    assert "PartitionFilters: [isnotnull(date_month" in plan(january)


def plan(df):
    query = df._jdf.queryExecution()
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        query, "extended")


def test_saved_tables_read_back_equal(spark, sf, tmp_path):
    t = driver_tables.transactions(spark, sf)
    scores = risk.client_risk(t, cutoffs=CUTOFFS)
    tables = {
        "risk_scores": risk.risk_scores_output(scores),
        "suspicious_cards": suspicion.suspicious_cards_output(t, THRESHOLDS),
        "risk_summary": risk.risk_summary_output(scores),
    }
    for name, table in tables.items():
        path = str(tmp_path / name)
        writers.write_table(table.limit(1), path)
        writers.write_table(table, path, files=1)  # overwrites
        back = spark.read.parquet(path)
        assert back.dtypes == table.dtypes
        assert back.exceptAll(table).count() == 0 and table.exceptAll(back).count() == 0
        assert len(list((tmp_path / name).glob("*.parquet"))) == 1
        writers.write_table(table, path)
        assert spark.read.parquet(path).count() == table.count()


def test_saved_scores_serve_as_classes(spark, sf, tmp_path):
    t = driver_tables.transactions(spark, sf)
    scores = risk.client_risk(t, cutoffs=CUTOFFS)
    writers.write_table(risk.risk_scores_output(scores), str(tmp_path / "s"))
    saved = compare.client_classes(spark.read.parquet(str(tmp_path / "s")))
    assert as_dicts(compare.group_error_rate(t, saved)) == as_dicts(
        compare.group_error_rate(t, compare.client_classes(scores)))


def test_describe_given_cards(spark):
    df = make(spark, [{"card_id": 1, "amount": "$1.50"}, {"card_id": 2}])
    cards = spark.createDataFrame([(1,)], "card_id bigint")
    assert as_dicts(suspicion.describe_cards(df, cards)) == [
        {"card_id": 1, "client_id": 1, "transactions": 1, "total_amount": 1.5, "cities": 1}]
    assert Decimal("1.50") == df.selectExpr("cast(1.5 as decimal(12,2))").first()[0]


def test_labels(spark, tmp_path):
    lines = ['{"1": "Yes", "2": "no"}', '{"3": "TRUE", "x": "No", "4": "maybe", "5": null}',
             '{"2": "Yes", "1": " yes "}', "", "no json"]
    (tmp_path / "lines.json").write_text("\n".join(lines))
    (tmp_path / "whole.json").write_text('{\n "1": "Yes",\n "2": "No"\n}')
    got = {(r.id, r.is_fraud) for r in readers.read_labels(spark, str(tmp_path / "lines.json")).collect()}
    assert got == {(1, True), (2, False), (2, True), (3, True), (None, False), (4, None), (5, None)}
    whole = readers.read_labels(spark, str(tmp_path / "whole.json")).collect()
    assert {(r.id, r.is_fraud) for r in whole} == {(1, True), (2, False)}
    labels = readers.read_labels(spark, str(tmp_path / "lines.json")).where("id is not null")
    t = make(spark, [{"id": 1}, {"id": 2}, {"id": 4}, {"id": 9}, {"id": 9}])
    assert as_dicts(features.label_coverage(t, labels)) == [
        {"labelled_transactions": 1, "labels_without_transaction": 1,
         "transactions_without_label": 1, "contradictory_labels": 1, "unreadable_labels": 2}]
    assert {(r.id, r.is_fraud) for r in features.usable_labels(labels).collect()} == {
        (1, True), (3, True)}


def test_tables_are_published_together(spark, tmp_path):
    path = str(tmp_path / "out")

    def tables(n):
        return {"a": spark.range(n), "b": spark.range(n).selectExpr("id + 1 AS x")}

    def sizes(version=None):
        return [writers.published(spark, path, name, version).count() for name in ("a", "b")]

    with pytest.raises(FileNotFoundError):
        writers.published(spark, path, "a")
    assert writers.publish(tables(3), path) == 1
    broken = tables(5)
    broken["b"] = spark.range(5).selectExpr("raise_error('stopped') AS x")
    with pytest.raises(Exception, match="stopped"):
        writers.publish(broken, path)
    assert sizes() == [3, 3]  # the first table of version 2 is written, nobody reads it
    assert writers.publish(tables(7), path) == 3
    assert sizes() == [7, 7] and sizes(1) == [3, 3]
    writers.drop_versions(spark, path, keep=1)
    assert sizes() == [7, 7]
    assert sorted(p.name for p in (tmp_path / "out" / "versions").iterdir()) == ["3"]
    with pytest.raises(FileNotFoundError):
        sizes(1)
