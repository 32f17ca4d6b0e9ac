"""Physical plans: what is scanned, joined and shuffled, and how often."""

import re

import pytest

from ledgerlens.config import Thresholds
from ledgerlens.operators import compare, enrich, indicators, quality, risk, suspicion
from ledgerlens.plans.staging import stage, staging_folder
from ledgerlens.sources import buckets, driver_tables, writers


@pytest.fixture(scope="module")
def facts(spark, sf, tmp_path_factory):
    """Transactions as they are kept after loading."""
    path = str(tmp_path_factory.mktemp("facts") / "t")
    writers.write_table(driver_tables.transactions(spark, sf), path)
    return spark.read.parquet(path)


def plan(df):
    text = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "formatted")
    return text


def count(df, node):
    return len(re.findall(rf"^\(\d+\) {re.escape(node)}", plan(df), re.M))


def test_dimension_is_broadcast_by_size(spark, sf, facts):
    mcc = driver_tables.mcc_codes(spark, sf)
    joined = enrich.transactions_with_category(facts, mcc)
    assert count(joined, "BroadcastHashJoin") == 1 and count(joined, "Exchange") == 0


def test_large_dimension_is_shuffled(spark, sf, facts):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.transactions_with_category(facts, driver_tables.mcc_codes(spark, sf))
        assert count(joined, "SortMergeJoin") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_categories_are_joined_after_the_first_aggregate(spark, sf, facts):
    text = plan(enrich.top_categories_by_volume(facts, driver_tables.mcc_codes(spark, sf)))
    tree = text.split("\n\n")[0]
    assert tree.index("BroadcastHashJoin") < tree.index("HashAggregate", tree.index("Broadcast"))
    assert "TakeOrderedAndProject" in tree


@pytest.mark.parametrize("function", [
    quality.volumetry, quality.missing_value_profile, quality.quality_summary,
    indicators.card_indicators, risk.client_indicators])
def test_one_scan(facts, function):
    assert count(function(facts), "Scan parquet") == 1


def test_distinct_counts_have_one_plan_without_value_sets(facts):
    text = plan(risk.client_indicators(facts))
    assert "collect_set" not in text and count(risk.client_indicators(facts), "Exchange") == 2
    # rows are combined before both shuffles; the first goes by client and value, not by client
    assert "hashpartitioning(client_id" in text and "spark_grouping_id" in text


def test_suspects_come_from_one_scan_and_no_join(facts):
    details = suspicion.suspect_details(facts, Thresholds(5, 20, 300.0))
    assert count(details, "Scan parquet") == 1 and count(details, "Exchange") == 2
    assert "Join" not in plan(details)


def test_only_needed_columns_are_read(facts):
    text = plan(quality.volumetry(facts))
    assert "ReadSchema: struct<client_id:bigint,card_id:bigint,merchant_id:bigint>" in text


def test_filters_reach_the_scan(facts):
    assert "PushedFilters: [IsNull(mcc)]" in plan(quality.transactions_without_mcc(facts))
    assert "Not(EqualTo(errors,))" in plan(quality.error_type_counts(facts))
    cities = plan(indicators.card_city_counts(facts))
    assert "Not(EqualTo(merchant_city,ONLINE))" in cities


def test_classes_join_after_the_reduction_to_clients(facts):
    classes = stage(facts.selectExpr("client_id", "true AS is_suspect").distinct(), "classes")
    for function in (compare.group_general_stats, compare.group_purchase_behaviour,
                     compare.group_geography, compare.group_amount_bands, compare.group_top_mcc):
        tree = plan(function(facts, classes)).split("\n\n")[0]
        join = tree.index("BroadcastHashJoin")
        assert "HashAggregate" in tree[join:], function.__name__
        assert tree.count("Scan parquet") == 2


def test_scores_read_the_facts_once(spark, facts):
    scores = risk.client_risk(facts)
    text = plan(scores)
    assert "client_indicators-" in text
    assert "amount:string" not in text  # the facts themselves are not part of the plan any more


def test_staging_uses_the_folder_of_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert staging_folder(spark) == folder
    assert stage(spark.range(3), "three").inputFiles()[0].startswith(f"file://{folder}/three-")


def test_no_python_in_any_plan(spark, sf):
    from ledgerlens.plans.catalogue import queries
    for name in ("suspect_details", "client_risk_score", "group_top_mcc", "velocity_24h",
                 "consecutive_errors"):
        assert "Python" not in plan(queries()[name](spark, sf)), name


@pytest.mark.parametrize("again", [False, True])
def test_large_classes_join_without_moving_the_facts(spark, facts, tmp_path, again):
    classes = facts.selectExpr("client_id", "client_id % 3 = 0 AS is_suspect").distinct()
    for df, name, land in ((facts, "facts", buckets.land_by_client),
                           (classes, "classes", buckets.keep_by_client)):
        land(df, str(tmp_path / name), 4, 5)
    if again:  # another session knows the folders only
        for name in ("facts", "classes"):
            spark.sql(f"DROP TABLE {buckets._table(str(tmp_path / name))}")
    landed, kept = (buckets.read_by_client(spark, str(tmp_path / n)) for n in ("facts", "classes"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = compare.classified_by_client(landed, kept)
        assert count(joined, "SortMergeJoin") == 1 and count(joined, "Exchange") == 0
        want = compare.classified_transactions(facts, classes).select(joined.columns)
        assert joined.exceptAll(want).count() == 0 and want.exceptAll(joined).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_busy_client_lies_in_many_buckets(spark, tmp_path):
    facts = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS client_id")
    buckets.land_by_client(facts, str(tmp_path / "t"), 32, 16)
    rows = buckets.read_by_client(spark, str(tmp_path / "t"))
    assert rows.count() == 3000
    parts = rows.where("client_id = 1").selectExpr("input_file_name() AS f").groupBy("f").count()
    assert parts.count() >= 8 and parts.agg({"count": "max"}).first()[0] < 400
