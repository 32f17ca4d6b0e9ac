"""The shared test tables seen as transactions, merchant categories, cards and users.

Every row of the source table is used. See FIXTURES.md for the mapping in words. Schemas are given,
so opening a table runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


MONEY_TEXT = "concat('$', cast(cast({} as decimal(12,2)) as string))"

TRANSACTION = {
    "id": "event_id",
    "date": "ts + make_ym_interval(0, cast(user_id % 12 as int))",
    "client_id": "user_id",
    "card_id": "user_id * 10 + CASE WHEN event_id % 10 < 7 THEN 0 WHEN event_id % 10 < 9 THEN 1 "
               "ELSE 2 END",
    "amount": MONEY_TEXT.format("CASE WHEN event_id % 20 = 0 THEN -value "
                                "WHEN event_id % 101 = 0 THEN 0 ELSE value END"),
    "merchant_id": "merchant",
    "mcc": "CASE WHEN k % 20 = 19 THEN NULL WHEN k < 90 THEN 3000 + k ELSE 2900 + k END",
    "errors": "CASE WHEN event_type = 'error' AND (event_id % 5 = 0 OR user_id % 7 = 0) THEN "
              "CASE WHEN k < 62 THEN 'Insufficient Balance' WHEN k < 77 THEN 'Bad PIN' "
              "WHEN k < 89 THEN 'Technical Glitch' WHEN k < 93 THEN 'Bad PIN,Insufficient Balance' "
              "WHEN k < 97 THEN 'Bad CVV' ELSE '' END END",
}

PLACE = {
    "merchant_city": "CASE WHEN event_type = 'click' THEN 'ONLINE' WHEN event_id % 97 = 0 THEN '' "
                     "ELSE n_name END",
    "merchant_state": "CASE WHEN event_type <> 'click' AND event_id % 97 <> 0 THEN r_name END",
}


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def map_events(events: DataFrame) -> DataFrame:
    """Events as transactions without places; also used on a stream of events."""
    return _select(events.selectExpr("*", "cast(get_json_object(props, '$.k') as int) AS k",
                                     "(event_id * 7 + user_id) % 500 AS merchant"), TRANSACTION)


def transactions(spark: SparkSession, folder: str, places: bool = True) -> DataFrame:
    """Events as transactions. Analyses that use no city or state can leave the places out, since
    Spark cannot know that joining them changes no row."""
    events = read(spark, folder, "events")
    return map_located_events(events, spark, folder) if places else map_events(events)


def map_located_events(events: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Events as transactions with places; also used on a stream of events."""
    countries = (read(spark, folder, "nation")
                 .join(read(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey"),
                       "n_regionkey", "left")
                 .selectExpr("n_nationkey AS country", "n_name", "r_name"))
    located = events.selectExpr(
        "*", "cast(get_json_object(props, '$.k') as int) AS k",
        "(event_id * 7 + user_id) % 500 AS merchant",
        "cast((event_id * 7 + user_id) % 25 as int) AS country").join(countries, "country", "left")
    return _select(located, TRANSACTION | PLACE)


def mcc_codes(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").selectExpr(
        "cast(3000 + p_partkey as string) AS mcc",
        "concat_ws(' ', p_type, p_brand) AS merchant_category")


def cards(spark: SparkSession, folder: str) -> DataFrame:
    """One card per customer, every field as text."""
    month = "lpad(cast(c_custkey % 12 + 1 as string), 2, '0')"
    return _select(read(spark, folder, "customer"), {
        "card_id": "c_custkey * 10",
        "credit_limit": MONEY_TEXT.format("abs(c_acctbal)"),
        "has_chip": "if(c_custkey % 4 <> 0, 'YES', 'NO')",
        "card_on_dark_web": "if(c_custkey % 50 = 0, 'YES', 'NO')",
        "expires": f"concat({month}, '/', cast(2024 + c_custkey % 6 as string))",
        "acct_open_date": f"concat({month}, '/', cast(1995 + c_custkey % 25 as string))",
    })


def users(spark: SparkSession, folder: str) -> DataFrame:
    """One user per customer, money as text."""
    return _select(read(spark, folder, "customer"), {
        "client_id": "c_custkey",
        "per_capita_income": MONEY_TEXT.format("abs(c_acctbal) * 3"),
        "yearly_income": MONEY_TEXT.format("abs(c_acctbal) * 6"),
        "total_debt": MONEY_TEXT.format("abs(c_acctbal) * 2"),
    })


def fraud_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a label file: one JSON object for each order, whose number is taken as the id of a
    transaction. Some orders have no label, some one that can't be read, some both labels."""
    label = F.expr("CASE WHEN o_orderkey % 41 = 0 THEN 'unknown' WHEN o_orderstatus = 'F' THEN 'Yes' "
                   "ELSE 'No' END")
    orders = read(spark, folder, "orders").where("o_orderkey % 10 <> 3")
    both = F.when(F.col("o_orderkey") % 43 == 0, F.array(F.lit("Yes"), F.lit("No"))).otherwise(
        F.array(label))
    return (orders.select("o_orderkey", F.explode(both).alias("label"))
            .select(F.to_json(F.create_map(F.col("o_orderkey").cast("string"), "label"))
                    .alias("value")))
