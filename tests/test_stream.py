"""The stream agrees with the batch, also over several files and after a restart."""

from datetime import timedelta

from ledgerlens.config import Thresholds
from ledgerlens.operators import indicators
from ledgerlens.sources import driver_tables
from ledgerlens.streaming import daily_activity
from rows import NOON, SCHEMA, as_dicts, make


def feed(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def run(spark, tmp_path):
    query = daily_activity.start_daily_activity(
        feed(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination()
    return daily_activity.current_activity(spark, str(tmp_path / "out"))


def key(rows):
    return sorted((r["card_id"], r["day"], r["transactions"], r["cents"]) for r in rows)


def test_equals_batch_over_batches_and_restart(spark, tmp_path):
    rows = [{"id": i, "card_id": i % 3, "amount": f"${i}.10" if i % 5 else None,
             "date": NOON + timedelta(hours=i % 40)} for i in range(60)]
    parts = [rows[:20], rows[20:40], rows[40:]]
    for part in parts[:2]:
        make(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run(spark, tmp_path)
    daily_activity.compact(spark, str(tmp_path / "out"))
    make(spark, parts[2]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = run(spark, tmp_path)
    assert key(as_dicts(got)) == key(as_dicts(indicators.card_days(make(spark, rows))))


def test_late_rows_count(spark, tmp_path):
    for hours in (0, 240, 241, 1):  # the last file comes long after its day
        make(spark, [{"date": NOON + timedelta(hours=hours)}]).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
    got = as_dicts(run(spark, tmp_path))
    assert sorted(r["transactions"] for r in got) == [2, 2]


def test_compaction_keeps_sums_and_the_newest_batch(spark, tmp_path):
    for hours in (0, 1, 30, 2):
        make(spark, [{"date": NOON + timedelta(hours=hours)}]).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
    before = key(as_dicts(run(spark, tmp_path)))
    out = tmp_path / "out"
    for _ in range(2):
        daily_activity.compact(spark, str(out))
        assert key(as_dicts(daily_activity.current_activity(spark, str(out)))) == before
    assert [p.name for p in (out / "batches").iterdir()] == ["batch=3"]
    assert [p.name for p in (out / "compacted").iterdir()] == ["upto=2"]


def test_four_files_give_all_events(spark, tmp_path, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "in"))
    live = driver_tables.map_events(spark.readStream.schema(driver_tables.SCHEMAS["events"]).option(
        "maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    daily_activity.start_daily_activity(
        live, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = daily_activity.current_activity(spark, str(tmp_path / "out"))
    assert got.agg({"transactions": "sum"}).first()[0] == events.count()


def test_alerts_are_strict(spark):
    activity = spark.createDataFrame(
        [(1, 10, 100000), (2, 11, 0), (3, 1, 100001), (4, 11, None)],
        "card_id bigint, transactions bigint, cents bigint").selectExpr(
            "card_id", "date'2024-01-01' AS day", "transactions", "cents")
    got = {r["card_id"]: r for r in as_dicts(daily_activity.alerts(activity, Thresholds()))}
    assert set(got) == {2, 3, 4}
    assert got[3]["over_daily_amount"] and not got[3]["over_daily_count"]
    assert not got[4]["over_daily_amount"]
