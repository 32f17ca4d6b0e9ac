"""Named queries over a folder with the shared test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.config import LevelCutoffs, Thresholds
from ledgerlens.operators import (
    amounts, by_month, compare, enrich, errors, features, indicators, quality, risk, sequences, sketches,
    suspicion, temporal,
)
from ledgerlens.plans.staging import new_folder, stage
from ledgerlens.sources import buckets, driver_tables, readers, writers
from ledgerlens.streaming import daily_activity, live_alerts

Query = Callable[[SparkSession, str], DataFrame]

# The shared tables hold no card above the default thresholds and no client below the default
# cut-offs, so the named queries pass their own.
THRESHOLDS = Thresholds(daily_count=5, cities=20, daily_amount=300.0)
CUTOFFS = LevelCutoffs(high=60.0, medium=55.0, low=50.0)
AS_OF = "2024-06-30"
CATEGORY_LEVELS = {
    "VERY_HIGH": [f"ECONOMY Brand#{i}" for i in range(1, 6)],
    "MODERATE": [f"LARGE Brand#{i}" for i in range(1, 26)],
    "LOW": [f"SMALL Brand#{i}" for i in range(1, 26)],
}


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text, so that any engine's result compares equal."""
    def convert(field: T.StructField) -> F.Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.alias(field.name)
    return df.select([convert(f) for f in df.schema.fields])


def _on_transactions(function, **parameters) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(function(driver_tables.transactions(spark, folder), **parameters))
    return run


def _without_places(function, **parameters) -> Query:
    """For analyses that use neither city nor state."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(function(driver_tables.transactions(spark, folder, places=False),
                                 **parameters))
    return run


def _with_codes(function, **parameters) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(function(driver_tables.transactions(spark, folder, places=False),
                                 driver_tables.mcc_codes(spark, folder), **parameters))
    return run


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    return risk.client_risk(driver_tables.transactions(spark, folder), cutoffs=CUTOFFS)


def _on_scores(function, **parameters) -> Query:
    return lambda spark, folder: portable(function(_scores(spark, folder), **parameters))


def _classes(spark: SparkSession, folder: str) -> DataFrame:
    return compare.client_classes(_scores(spark, folder))


def _on_classes(function, places: bool = False) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(function(driver_tables.transactions(spark, folder, places),
                                 _classes(spark, folder)))
    return run


def _classified_by_client(spark: SparkSession, folder: str) -> DataFrame:
    """Facts and classes laid out by client, joined bucket with bucket as large classes would be."""
    path = new_folder(spark, "by-client")
    buckets.land_by_client(driver_tables.transactions(spark, folder), f"{path}/facts", 8)
    buckets.keep_by_client(_classes(spark, folder), f"{path}/classes", 8)
    facts, classes = (buckets.read_by_client(spark, f"{path}/{t}") for t in ("facts", "classes"))
    return portable(compare.classified_by_client(facts, classes.hint("merge")).select(
        "id", "client_id", "amount_clean", "has_error", "is_online", "is_night", "is_weekend",
        "is_suspect"))


def _temporal_columns(spark: SparkSession, folder: str) -> DataFrame:
    return portable(temporal.temporal_columns(driver_tables.transactions(spark, folder))
                    .select("id", "date", "hour", "weekday", "weekday_name", "month"))


def _mcc_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as a JSON object of one code, read as the category file is."""
    entry = F.create_map("mcc", "merchant_category")
    objects = driver_tables.mcc_codes(spark, folder).select(F.to_json(entry).alias("value"))
    return readers.codes_from_json(objects)


def _with_bad_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions of which some amounts are spoilt: a third decimal, another currency, a width
    that no amount has."""
    amount, bare = F.col("amount"), F.substring("amount", 2, 40)
    return driver_tables.transactions(spark, folder, places=False).withColumn(
        "amount", F.when(F.col("id") % 50 == 7, F.concat(amount, F.lit("5")))
        .when(F.col("id") % 50 == 8, F.concat(F.lit("EUR "), bare))
        .when(F.col("id") % 50 == 9, F.concat(F.lit("$1234567890123"), F.abs(bare.cast("double"))
                                              .cast("decimal(12,2)").cast("string")))
        .when(F.col("id") % 50 == 10, F.concat(amount, F.lit("0"))).otherwise(amount))


def _population_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = risk.population_stats(
        risk.client_indicators(driver_tables.transactions(spark, folder)))
    return stats.withColumns({n: F.round(n, 6) for n in ("std_transactions", "std_mean_amount")})


def _client_amount_profile(spark: SparkSession, folder: str) -> DataFrame:
    return features.client_amount_profile(driver_tables.transactions(spark, folder)).withColumn(
        "std_amount", F.round("std_amount", 6))


def _mcc_risk_level(spark: SparkSession, folder: str) -> DataFrame:
    categorised = enrich.transactions_with_category(
        driver_tables.transactions(spark, folder), driver_tables.mcc_codes(spark, folder))
    levels = features.risk_table(spark, CATEGORY_LEVELS, "merchant_category", "string")
    return features.mcc_risk_level(categorised, levels).select(
        "id", "merchant_category", "mcc_risk_level")


def _labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels after a trip through their file."""
    path = new_folder(spark, "fraud-labels")
    driver_tables.fraud_labels(spark, folder).write.text(path)
    return readers.read_labels(spark, path)


def _labelled_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """How well the high-amount flag finds transactions that a label file calls fraud."""
    t = driver_tables.transactions(spark, folder, places=False)
    flagged = features.amount_flags(t).select("id", F.col("is_high_amount").alias("flagged"))
    return features.labelled_metrics(flagged, features.usable_labels(_labels(spark, folder)))


def _label_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return features.label_coverage(driver_tables.transactions(spark, folder, places=False),
                                   _labels(spark, folder))


def _published_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """The three saved tables published together twice, the second time whole; rows and a sum of
    each as a reader of the newest version sees them."""
    t = driver_tables.transactions(spark, folder)
    scores = stage(risk.client_risk(t, cutoffs=CUTOFFS), "scores")
    tables = {"risk_scores": risk.risk_scores_output(scores),
              "suspicious_cards": suspicion.suspicious_cards_output(t, THRESHOLDS),
              "risk_summary": risk.risk_summary_output(scores)}
    path = new_folder(spark, "published")
    writers.publish({name: df.limit(1) for name, df in tables.items()}, path)
    writers.publish(tables, path)
    writers.drop_versions(spark, path, keep=1)
    summed = {"risk_scores": "transactions", "suspicious_cards": "transactions",
              "risk_summary": "clients"}
    rows = [writers.published(spark, path, name).agg(
        F.lit(name).alias("table_name"), F.count("*").alias("table_rows"),
        F.sum(column).alias("total")) for name, column in summed.items()]
    return rows[0].union(rows[1]).union(rows[2])


def _arriving(spark: SparkSession, folder: str, path: str):
    """Events that arrive in two deliveries, half the files there are a batch; yields the stream of
    each.

    The events are dealt by hash, so every delivery holds rows of all days, long past ones included.
    A larger table is written to more files, which make larger batches, not more of them.
    """
    schema = driver_tables.SCHEMAS["events"]
    events = spark.read.schema(schema).parquet(f"{folder}/events.parquet")
    part = F.pmod(F.xxhash64(*events.columns), F.lit(4))
    for parts in ((0, 1, 2), (3,)):
        for p in parts:
            events.where(part == p).write.mode("append").parquet(f"{path}/arrived")
        files = len(spark.read.schema(schema).parquet(f"{path}/arrived").inputFiles())
        yield (spark.readStream.schema(schema).option("maxFilesPerTrigger", max(2, -(-files // 2)))
               .parquet(f"{path}/arrived"))


def _streaming_card_velocity(spark: SparkSession, folder: str) -> DataFrame:
    """Card days above a threshold, summed batch by batch over two runs of a stream."""
    path = new_folder(spark, "daily-activity")
    for arriving in _arriving(spark, folder, path):
        daily_activity.start_daily_activity(driver_tables.map_events(arriving), path,
                                            f"{path}/progress").awaitTermination()
        daily_activity.compact(spark, path)
    return portable(daily_activity.alerts(
        daily_activity.current_activity(spark, path), THRESHOLDS))


def _live_card_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """What stands over a limit after two runs of the stateful stream. The deliveries mix the days
    of a year, so days stay open that long."""
    path = new_folder(spark, "live-alerts")
    for arriving in _arriving(spark, folder, path):
        live_alerts.start_live_alerts(
            driver_tables.map_located_events(arriving, spark, folder), path, f"{path}/progress",
            THRESHOLDS, keep_days=1000).awaitTermination()
    return portable(live_alerts.standing_alerts(spark, path))


def _kept(spark: SparkSession, months: DataFrame) -> DataFrame:
    """Sketches of each month after a trip through their table."""
    path = new_folder(spark, "sketches")
    sketches.keep_sketches(months, path)
    return sketches.kept_sketches(spark, path)


def _approximate_volumetry(spark: SparkSession, folder: str) -> DataFrame:
    """Counts from kept sketches beside the exact ones: all are within three standard errors."""
    t = driver_tables.transactions(spark, folder, places=False)
    estimates = sketches.approximate_volumetry(_kept(spark, sketches.monthly_sketches(t)))
    bound = 3 * sketches.SketchSize.error(sketches.DEFAULT.precision)

    def long(df: DataFrame, value: str) -> DataFrame:
        return df.unpivot([], ["transactions", *sketches.KEYS], "measure", value)

    both = long(estimates, "estimate").join(long(quality.volumetry(t), "exact"), "measure")
    return both.select("measure", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= F.when(
        F.col("measure") == "transactions", 0).otherwise(bound * F.col("exact") + 1)).alias(
            "within_error"))


def _approximate_client_indicators(spark: SparkSession, folder: str) -> DataFrame:
    """Exact sums from kept sketches, and whether the distinct counts are within three errors."""
    t = driver_tables.transactions(spark, folder)
    estimates = sketches.approximate_client_indicators(
        _kept(spark, sketches.monthly_client_sketches(t)))
    exact = risk.client_indicators(t).select(
        "client_id", *[F.col(n).alias(f"exact_{n}") for n in sketches.OF_CLIENT])
    bound = 3 * sketches.SketchSize.error(sketches.DEFAULT.client_precision)
    return estimates.join(exact, "client_id").select(
        "client_id", "transactions", "total_amount", "mean_amount", "max_amount", "errors", "night",
        "online", *[(F.abs(F.col(n) - F.col(f"exact_{n}")) <= bound * F.col(f"exact_{n}") + 1)
                    .alias(f"{n}_within_error") for n in sketches.OF_CLIENT])


def _approximate_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles from kept sketches: their ranks are off by less than 0.01 of the amounts."""
    t = driver_tables.transactions(spark, folder, places=False)
    found = sketches.approximate_quantiles(_kept(spark, sketches.monthly_sketches(t)),
                                           [0.25, 0.5, 0.75])
    return sketches.rank_errors(t, stage(found, "quantiles")).select(
        "probability", (F.col("rank_error") < 0.01).alias("within_error"))


def _month_by_month(build, *columns: str) -> Query:
    """Facts landed in two deliveries, the second of which brings half of one month late; the
    features are built after each, the second time from that month on."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = new_folder(spark, "by-month")
        t = stage(driver_tables.transactions(spark, folder, places=False), "facts")
        month = F.date_format("date", "yyyy-MM")
        months = t.where("date is not null").agg(F.max(month).alias("last"))
        last = months.first()["last"]
        late = (month == F.lit(last)) & (F.col("id") % 2 == 0)
        writers.land_transactions(t.where(~F.coalesce(late, F.lit(False))), f"{path}/landed")
        build(spark, f"{path}/landed", f"{path}/kept")
        writers.land_transactions(t, f"{path}/landed")
        build(spark, f"{path}/landed", f"{path}/kept", changed=last)
        return by_month.features_of(spark, f"{path}/kept").select(*columns)
    return run


def _first_uses(other: str, name: str) -> Query:
    def build(spark: SparkSession, landed: str, path: str, changed: str | None = None):
        return by_month.build_first_uses(spark, landed, other, path, changed)

    query = _month_by_month(build, "id", "client_id", other, "is_first")
    return lambda spark, folder: query(spark, folder).withColumnRenamed("is_first", name)


def _saved(query: Query, name: str) -> Query:
    """The query's rows after a trip through its sink: written, overwritten once, read back."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        path = new_folder(spark, name)
        rows = stage(query(spark, folder), name)
        writers.write_table(rows.limit(1), path)
        writers.write_table(rows, path)
        return spark.read.parquet(path)
    return run


def _columns(function, *names: str, **parameters) -> Query:
    def pick(t: DataFrame) -> DataFrame:
        return function(t, **parameters).select(*names)
    return _on_transactions(pick)


def queries() -> dict[str, Query]:
    limits = {"thresholds": THRESHOLDS}
    return {
        # loading and shaping
        "transactions_clean": _on_transactions(amounts.transactions_clean),
        "mcc_dimension": _mcc_dimension,
        # volume and quality
        "volumetry": _without_places(quality.volumetry),
        "missing_value_profile": _on_transactions(quality.missing_value_profile),
        "non_positive_amounts": _without_places(quality.non_positive_amounts),
        "non_positive_summary": _without_places(quality.non_positive_summary),
        "transactions_without_mcc": _on_transactions(quality.transactions_without_mcc),
        "without_mcc_summary": _without_places(quality.without_mcc_summary),
        "transactions_with_errors": _on_transactions(quality.transactions_with_errors),
        "with_errors_summary": _without_places(quality.with_errors_summary),
        "error_type_counts": _without_places(quality.error_type_counts),
        "error_type_counts_top": _without_places(quality.error_type_counts, top=20),
        "quality_summary": _without_places(quality.quality_summary),
        "unreadable_amounts": lambda spark, folder: quality.unreadable_amounts(
            _with_bad_amounts(spark, folder)),
        "unreadable_summary": lambda spark, folder: quality.unreadable_summary(
            _with_bad_amounts(spark, folder)),
        # amounts
        "amount_statistics": _without_places(amounts.amount_statistics),
        "amount_median": _without_places(amounts.amount_median),
        "amount_quartiles": _without_places(amounts.amount_quartiles),
        "amount_bands": _without_places(amounts.amount_bands),
        # time
        "temporal_columns": _temporal_columns,
        "transactions_by_hour": _without_places(temporal.transactions_by_hour),
        "transactions_by_weekday": _without_places(temporal.transactions_by_weekday),
        "transactions_by_month": _without_places(temporal.transactions_by_month),
        # merchant categories
        "transactions_with_category": _with_codes(
            lambda t, m: enrich.transactions_with_category(t, m).select(
                "id", "mcc", "merchant_category", "amount")),
        "top_categories_by_volume": _with_codes(enrich.top_categories_by_volume),
        "category_amounts": _with_codes(enrich.category_amounts),
        # errors
        "error_type_share": _without_places(errors.error_type_share),
        "error_type_share_top": _without_places(errors.error_type_share, top=20),
        "card_error_rate": _without_places(errors.card_error_rate),
        "card_error_rate_top": _without_places(errors.card_error_rate, top=20),
        "cards_all_errors": _without_places(errors.cards_all_errors),
        "client_error_rate": _without_places(errors.client_error_rate),
        "client_error_rate_top": _without_places(errors.client_error_rate, top=20),
        "client_error_rate_bands": _without_places(errors.client_error_rate_bands),
        # card indicators: whole tables, and the reports of the highest rows
        "card_day_counts": _without_places(indicators.card_day_counts),
        "card_day_counts_top": _without_places(indicators.card_day_counts, top=15),
        "card_day_amounts": _without_places(indicators.card_day_amounts),
        "card_day_amounts_top": _without_places(indicators.card_day_amounts, top=15),
        "card_city_counts": _on_transactions(indicators.card_city_counts),
        "card_city_counts_top": _on_transactions(indicators.card_city_counts, top=15),
        "card_error_ratio": _without_places(indicators.card_error_ratio),
        "card_error_ratio_top": _without_places(indicators.card_error_ratio, top=15),
        "card_indicators": _on_transactions(indicators.card_indicators),
        "card_indicators_top": _on_transactions(indicators.card_indicators, top=20),
        # suspicious cards
        "suspects_by_daily_count": _without_places(suspicion.suspects_by_daily_count, **limits),
        "suspects_by_cities": _on_transactions(suspicion.suspects_by_cities, **limits),
        "suspects_by_daily_amount": _without_places(suspicion.suspects_by_daily_amount, **limits),
        "suspicious_cards": _on_transactions(suspicion.suspicious_cards, **limits),
        "suspect_counts": _on_transactions(suspicion.suspect_counts, **limits),
        "suspect_details": _on_transactions(suspicion.suspect_details, **limits),
        "suspect_details_top": _on_transactions(suspicion.suspect_details, top=30, **limits),
        # client risk
        "client_indicators": _on_transactions(risk.client_indicators),
        "client_population_stats": _population_stats,
        "client_risk_score": _on_scores(lambda s: s.select(
            "client_id", *[f"{p}_score" for p in risk.PARTS], "risk_score")),
        "client_risk_level": _on_scores(lambda s: s.select(
            "client_id", "risk_score", "risk_level")),
        "risk_level_summary": _on_scores(risk.risk_level_summary),
        "high_risk_clients": _on_scores(risk.high_risk_clients),
        "high_risk_clients_top": _on_scores(risk.high_risk_clients, top=20),
        "score_components": _on_scores(risk.score_components),
        "score_components_top": _on_scores(risk.score_components, top=10),
        # saved tables
        "risk_scores_output": _saved(_on_scores(risk.risk_scores_output), "risk_scores"),
        "suspicious_cards_output": _saved(
            _on_transactions(suspicion.suspicious_cards_output, **limits), "suspicious_cards"),
        "risk_summary_output": _saved(_on_scores(risk.risk_summary_output), "risk_summary"),
        "published_outputs": _published_outputs,
        # normal against suspect clients
        "client_classes": _on_scores(compare.client_classes),
        "behaviour_flags": _columns(compare.behaviour_flags, "id", "has_error", "is_online",
                                    "is_night", "is_weekend"),
        "classified_transactions": _on_classes(
            lambda t, c: compare.classified_transactions(t, stage(c, "client_classes")).select(
                "id", "client_id", "amount_clean", "has_error", "is_online", "is_night",
                "is_weekend", "is_suspect"), places=True),
        "classified_transactions_by_client": _classified_by_client,
        "group_general_stats": _on_classes(compare.group_general_stats),
        "group_purchase_behaviour": _on_classes(compare.group_purchase_behaviour, places=True),
        "group_temporal_behaviour": _on_classes(compare.group_temporal_behaviour),
        "group_error_rate": _on_classes(compare.group_error_rate),
        "group_geography": _on_classes(compare.group_geography, places=True),
        "group_amount_bands": _on_classes(compare.group_amount_bands),
        "group_top_mcc": _on_classes(compare.group_top_mcc),
        "group_shares": _on_scores(lambda s: compare.group_shares(compare.client_classes(s))),
        # indicators for later models
        "typed_cards": lambda spark, folder: portable(
            features.typed_cards(driver_tables.cards(spark, folder))),
        "typed_users": lambda spark, folder: portable(
            features.typed_users(driver_tables.users(spark, folder))),
        "amount_flags": _columns(features.amount_flags, "id", "amount_clean", "is_high_amount",
                                 "is_very_high_amount", "is_negative_amount"),
        "night_flag": _columns(features.night_flag, "id", "hour_of_day", "day_of_week",
                               "is_night"),
        "online_flag": _columns(features.online_flag, "id", "is_online"),
        "mcc_risk_level": _mcc_risk_level,
        "mcc_risk_by_code": _without_places(lambda t: features.mcc_risk_level(t, key="mcc").select(
            "id", "mcc", "mcc_risk_level")),
        "error_suspicion_level": _columns(features.error_suspicion_level, "id", "errors",
                                          "error_suspicion"),
        "client_amount_profile": _client_amount_profile,
        "client_rates": _without_places(features.client_rates),
        "client_mcc_profile": _without_places(features.client_mcc_profile),
        "error_causes": _without_places(features.error_causes),
        "card_error_rate_feature": _without_places(features.card_error_rate_feature),
        "card_attributes": lambda spark, folder: portable(features.card_attributes(
            features.typed_cards(driver_tables.cards(spark, folder)),
            driver_tables.transactions(spark, folder), AS_OF)),
        "card_utilisation": lambda spark, folder: portable(features.card_utilisation(
            features.typed_cards(driver_tables.cards(spark, folder)),
            driver_tables.transactions(spark, folder, places=False))),
        "amount_vs_client_mean": _without_places(features.amount_vs_client_mean),
        "time_since_previous": _without_places(sequences.time_since_previous),
        "first_at_merchant": _without_places(sequences.first_at_merchant),
        "first_in_mcc": _without_places(sequences.first_in_mcc),
        "consecutive_errors": _without_places(sequences.consecutive_errors),
        "card_sequences_by_month": _month_by_month(
            by_month.build_card_sequences, "id", "card_id", "seconds", "error_run"),
        "first_at_merchant_by_month": _first_uses("merchant_id", "is_first_at_merchant"),
        "first_in_mcc_by_month": _first_uses("mcc", "is_first_in_mcc"),
        "velocity_1h": _without_places(sequences.velocity, seconds=3600),
        "velocity_24h": _without_places(sequences.velocity, seconds=86400),
        "hour_share": _without_places(temporal.hour_share),
        "transactions_per_key": _without_places(quality.transactions_per_key),
        "labelled_metrics": _labelled_metrics,
        "label_coverage": _label_coverage,
        "streaming_card_velocity": _streaming_card_velocity,
        "live_card_alerts": _live_card_alerts,
        # figures from kept sketches
        "approximate_volumetry": _approximate_volumetry,
        "approximate_client_indicators": _approximate_client_indicators,
        "approximate_quantiles": _approximate_quantiles,
    }
