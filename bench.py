"""Time the named queries and print one JSON line.

BENCH_SF_DIR   folder with the tables (default: the sf0.1 test tables)
BENCH_CPUS     threads of the local session (default 8)
BENCH_QUERIES  comma separated names (default: the headline queries)
BENCH_RUNS     measured runs per query, of which the median counts (default 2)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from ledgerlens.plans.catalogue import queries

HEADLINE = [
    "volumetry", "missing_value_profile", "quality_summary", "error_type_share",
    "amount_statistics", "amount_quartiles", "amount_bands", "transactions_by_hour",
    "top_categories_by_volume", "category_amounts", "card_error_rate", "client_error_rate_bands",
    "card_day_counts", "card_day_amounts", "card_city_counts", "card_indicators",
    "suspicious_cards", "suspect_details", "client_indicators", "client_risk_score",
    "risk_level_summary", "classified_transactions", "group_general_stats",
    "group_purchase_behaviour", "group_geography", "group_amount_bands", "group_top_mcc",
    "amount_vs_client_mean", "time_since_previous", "first_at_merchant", "consecutive_errors",
    "velocity_24h",
]


def session(cpus: str) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    catalogue = queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        catalogue[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)  # warm the code cache
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 4)
    scale = os.path.basename(os.path.normpath(folder)).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
