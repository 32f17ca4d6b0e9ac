"""The named queries as SQL over the raw tables, for an independent engine.

Sums run over whole cents and ratios are rounded as ratios of integers, as in the Spark queries.
"""

from __future__ import annotations

from ledgerlens.operators.risk import PARTS
from ledgerlens.plans.catalogue import AS_OF, CATEGORY_LEVELS, CUTOFFS, THRESHOLDS

TX = """
raw AS (
  SELECT e.*, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         (event_id * 7 + user_id) % 500 AS m
  FROM events e
), mapped AS (
  SELECT event_id AS id,
         ts + to_months(CAST(user_id % 12 AS INTEGER)) AS date,
         user_id AS client_id,
         user_id * 10 + CASE WHEN event_id % 10 < 7 THEN 0 WHEN event_id % 10 < 9 THEN 1 ELSE 2 END
           AS card_id,
         '$' || CAST(CAST(CASE WHEN event_id % 20 = 0 THEN -value
                               WHEN event_id % 101 = 0 THEN 0 ELSE value END
                          AS DECIMAL(12,2)) AS VARCHAR) AS amount,
         m AS merchant_id,
         CASE WHEN event_type = 'click' THEN 'ONLINE' WHEN event_id % 97 = 0 THEN ''
              ELSE n_name END AS merchant_city,
         CASE WHEN event_type = 'click' OR event_id % 97 = 0 THEN NULL ELSE r_name END
           AS merchant_state,
         CASE WHEN k % 20 = 19 THEN NULL WHEN k < 90 THEN 3000 + k ELSE 2900 + k END AS mcc,
         CASE WHEN event_type <> 'error' THEN NULL
              WHEN event_id % 5 <> 0 AND user_id % 7 <> 0 THEN NULL
              WHEN k < 62 THEN 'Insufficient Balance' WHEN k < 77 THEN 'Bad PIN'
              WHEN k < 89 THEN 'Technical Glitch' WHEN k < 93 THEN 'Bad PIN,Insufficient Balance'
              WHEN k < 97 THEN 'Bad CVV' ELSE '' END AS errors
  FROM raw LEFT JOIN nation ON n_nationkey = m % 25
           LEFT JOIN region ON r_regionkey = n_regionkey
), tx AS (
  SELECT *, TRY_CAST(replace(amount, '$', '') AS DECIMAL(12,2)) AS amount_clean,
         CAST(TRY_CAST(replace(amount, '$', '') AS DECIMAL(12,2)) * 100 AS BIGINT) AS c,
         errors IS NOT NULL AND errors <> '' AS failed,
         coalesce(merchant_city = 'ONLINE', FALSE) AS online,
         CAST(date AS DATE) AS day, CAST(hour(date) AS INTEGER) AS hour,
         CAST(dayofweek(date) + 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month,
         hour(date) < 6 AS night
  FROM mapped
)"""

# Risk level by category code.
CODE_LEVELS = {
    "VERY_HIGH": [4829],
    "HIGH": [3000, 3001, 3005, 3006, 3007, 3008, 3009, 3066, 3359, 3387, 3389, 3390, 3393, 3405],
    "MODERATE": [4411, 4511, 4121],
    "LOW": [5411, 5541],
}

CODES = """
codes AS (
  SELECT CAST(3000 + p_partkey AS VARCHAR) AS code, p_type || ' ' || p_brand AS merchant_category
  FROM part
)"""


def _int(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _pct(part: str, whole: str, decimals: int = 2) -> str:
    scale = 10**decimals
    return f"round({_int(part)} * {100 * scale} / nullif({_int(whole)}, 0)) / {scale}"


def _ratio(part: str, whole: str, decimals: int = 2) -> str:
    scale = 10**decimals
    return f"round({_int(part)} * {scale} / nullif({_int(whole)}, 0)) / {scale}"


def _mean(cents: str = "sum(c)", count: str = "count(c)") -> str:
    return f"round({_int(cents)} / nullif({_int(count)}, 0)) / 100"


def _dollars(cents: str) -> str:
    return f"{_int(cents)} / 100"


def _half_up(value: str, decimals: int) -> str:
    """Round a double half up on its printed digits."""
    return (f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(30,17)), {decimals}) AS DOUBLE)")


def _tx(select: str, *more: str) -> str:
    return "WITH " + ",".join((TX,) + more) + "\n" + select


LABELS = """
labelled AS (
  SELECT o_orderkey AS id, o_orderstatus = 'F' AS fraud FROM orders WHERE o_orderkey % 10 <> 3
), usable AS (
  SELECT * FROM labelled WHERE id % 43 <> 0 AND id % 41 <> 0
)"""

UNREADABLE = """
unreadable AS (
  SELECT id, client_id, card_id,
         CASE id % 50 WHEN 7 THEN amount || '5' WHEN 8 THEN 'EUR ' || substr(amount, 2)
              ELSE '$1234567890123' || replace(substr(amount, 2), '-', '') END AS amount,
         CASE id % 50 WHEN 7 THEN 'not whole cents' WHEN 8 THEN 'not a number' ELSE 'too large' END
           AS reason
  FROM tx WHERE id % 50 IN (7, 8, 9)
)"""

INDICATORS = f"""
indicators AS (
  SELECT client_id, count(*) AS transactions, {_dollars('sum(c)')} AS total_amount,
         {_mean()} AS mean_amount, max(c) / 100 AS max_amount,
         count(DISTINCT card_id) AS cards, count(DISTINCT merchant_city) AS cities,
         count(DISTINCT day) AS active_days, count(*) FILTER (failed) AS errors,
         count(*) FILTER (night) AS night, count(*) FILTER (online) AS online,
         count(DISTINCT merchant_id) AS merchants
  FROM tx GROUP BY client_id
), stats AS (
  SELECT count(*) AS clients, {_int('sum(transactions)')} / count(*) AS avg_transactions,
         round(stddev_samp(transactions), 6) AS std_transactions,
         {_int('sum(CAST(round(mean_amount * 100) AS BIGINT))')} / count(mean_amount) / 100
           AS avg_mean_amount,
         round(stddev_samp(mean_amount), 6) AS std_mean_amount,
         {_int('sum(cities)')} / count(*) AS avg_cities,
         {_int('sum(errors)')} / count(*) AS avg_errors
  FROM indicators
)"""

SCORES = INDICATORS + f""", parts AS (
  SELECT i.*, least(20.0::DOUBLE, transactions / avg_transactions * 10) AS volume_score,
         least(20.0::DOUBLE, mean_amount / avg_mean_amount * 10) AS amount_score,
         least(20.0::DOUBLE, cities / avg_cities * 10) AS geography_score,
         least(20.0::DOUBLE, errors / transactions * 100) AS error_score,
         least(10.0::DOUBLE, night / transactions * 50) AS night_score,
         least(10.0::DOUBLE, merchants / transactions * 20) AS diversity_score
  FROM indicators i CROSS JOIN stats
), totals AS (
  SELECT *, {_half_up('volume_score + amount_score + geography_score + error_score + night_score'
                      ' + diversity_score', 2)} AS risk_score
  FROM parts
), scores AS (
  SELECT *, CASE WHEN risk_score >= {CUTOFFS.high} THEN 'HIGH'
                 WHEN risk_score >= {CUTOFFS.medium} THEN 'MEDIUM'
                 WHEN risk_score >= {CUTOFFS.low} THEN 'LOW' ELSE 'VERY_LOW' END AS risk_level
  FROM totals
), classes AS (
  SELECT client_id, risk_level IN ('HIGH', 'MEDIUM') AS is_suspect FROM scores
), classed AS (
  SELECT tx.*, coalesce(is_suspect, FALSE) AS is_suspect,
         CASE WHEN coalesce(is_suspect, FALSE) THEN 'SUSPECT' ELSE 'NORMAL' END AS "group"
  FROM tx LEFT JOIN classes USING (client_id)
)"""

CARD_DAYS = """
card_days AS (
  SELECT card_id, day, count(*) AS n, CAST(sum(c) AS BIGINT) AS c FROM tx GROUP BY card_id, day
)"""

PHYSICAL = "merchant_city IS NOT NULL AND merchant_city NOT IN ('', 'ONLINE')"

SUSPECTS = CARD_DAYS + f""", by_count AS (
  SELECT DISTINCT card_id FROM card_days WHERE n > {THRESHOLDS.daily_count}
), by_cities AS (
  SELECT card_id FROM tx WHERE {PHYSICAL} GROUP BY card_id
  HAVING count(DISTINCT merchant_city) > {THRESHOLDS.cities}
), by_amount AS (
  SELECT DISTINCT card_id FROM card_days WHERE c > {THRESHOLDS.daily_amount * 100}
), suspects AS (
  SELECT card_id, card_id IN (SELECT card_id FROM by_count) AS over_daily_count,
         card_id IN (SELECT card_id FROM by_cities) AS over_cities,
         card_id IN (SELECT card_id FROM by_amount) AS over_daily_amount
  FROM (SELECT card_id FROM by_count UNION SELECT card_id FROM by_cities
        UNION SELECT card_id FROM by_amount)
)"""

DETAILS = SUSPECTS + f""", cards AS (
  SELECT card_id, count(*) AS transactions, {_int('sum(c)')} AS cents,
         count(DISTINCT day) AS active_days, count(DISTINCT merchant_city) AS cities,
         max(c) / 100 AS max_amount, min(client_id) AS client_id
  FROM tx GROUP BY card_id
), details AS (
  SELECT card_id, transactions, cents / 100 AS total_amount, active_days, cities, max_amount,
         {_ratio('transactions', 'active_days')} AS transactions_per_day,
         concat_ws(', ',
           CASE WHEN {_ratio('transactions', 'active_days')} > {THRESHOLDS.daily_count}
                THEN 'Too many tx/day' END,
           CASE WHEN cities > {THRESHOLDS.cities} THEN 'Many cities' END,
           CASE WHEN cents / active_days > {THRESHOLDS.daily_amount * 100} THEN 'High amount' END
         ) AS reason, over_daily_count, over_cities, over_daily_amount
  FROM cards JOIN suspects USING (card_id)
)"""

MISSING = {
    "id": ("long", "id IS NULL"), "date": ("timestamp_ntz", "date IS NULL"),
    "client_id": ("long", "client_id IS NULL"), "card_id": ("long", "card_id IS NULL"),
    "amount": ("string", "amount IS NULL OR amount = ''"),
    "merchant_id": ("long", "merchant_id IS NULL"),
    "merchant_city": ("string", "merchant_city IS NULL OR merchant_city = ''"),
    "merchant_state": ("string", "merchant_state IS NULL OR merchant_state = ''"),
    "mcc": ("integer", "mcc IS NULL"), "errors": ("string", "errors IS NULL OR errors = ''"),
}

DATE = "strftime(date, '%Y-%m-%d %H:%M:%S.%f') AS date"
AMOUNT = "CAST(amount_clean AS DOUBLE) AS amount_clean"
DAY = "strftime(day, '%Y-%m-%d') AS day"
RAW = f"id, {DATE}, client_id, card_id, amount, merchant_id, merchant_city, merchant_state, mcc, errors"
WEEKDAY = ("['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][dow]"
           " AS weekday_name")
RATES = (f"count(*) AS transactions, count(*) FILTER (failed) AS errors, "
         f"{_pct('count(*) FILTER (failed)', 'count(*)')} AS error_pct")
SECOND = "CAST(floor(epoch(date)) AS BIGINT)"


def _share(condition: str, name: str) -> str:
    part = f"count(*) FILTER ({condition})"
    return f"{part} AS {name}, {_pct(part, 'count(*)')} AS {name}_pct"


def _distinct_with_null(name: str) -> str:
    return f"count(DISTINCT {name}) + max(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END)"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _first(other: str, name: str) -> str:
    return _tx(f"""
SELECT id, client_id, {other}, coalesce(
         {other} IS NOT NULL AND row_number() OVER (PARTITION BY client_id, {other}
                                                    ORDER BY date, id) = 1, FALSE) AS {name}
FROM tx""")


def _velocity(seconds: int) -> str:
    return _tx(f"""
SELECT id, card_id, count(*) OVER (PARTITION BY card_id ORDER BY {SECOND}
         RANGE BETWEEN {seconds} PRECEDING AND CURRENT ROW) AS velocity
FROM tx""")


REPORTS = ("error_type_counts", "error_type_share", "card_error_rate", "client_error_rate",
           "high_risk_clients", "score_components")


def oracle_sql() -> dict[str, str]:
    non_positive = "amount_clean <= 0"
    no_mcc = "mcc IS NULL"
    group_bands = ("CASE WHEN amount_clean < 10 THEN '< 10' WHEN amount_clean < 50 THEN '10-50' "
                   "WHEN amount_clean < 200 THEN '50-200' WHEN amount_clean < 500 THEN '200-500' "
                   "ELSE '>= 500' END")
    category = """
SELECT merchant_category, count(*) AS transactions, {extra}
FROM tx JOIN codes ON CAST(mcc AS VARCHAR) = code GROUP BY merchant_category
ORDER BY {order} DESC, merchant_category LIMIT {n}"""
    out = {
        "transactions_clean": _tx(f"SELECT {RAW}, {AMOUNT} FROM tx"),
        "mcc_dimension": f"WITH {CODES} SELECT code AS mcc, merchant_category FROM codes",
        "volumetry": _tx(f"""
SELECT count(*) AS transactions, {_distinct_with_null('client_id')} AS clients,
       {_distinct_with_null('card_id')} AS cards, {_distinct_with_null('merchant_id')} AS merchants
FROM tx"""),
        "transactions_per_key": _tx(f"""
SELECT {_ratio('count(*)', 'count(DISTINCT client_id)')} AS per_client,
       {_ratio('count(DISTINCT card_id)', 'count(DISTINCT client_id)')} AS cards_per_client,
       {_ratio('count(*)', 'count(DISTINCT card_id)')} AS per_card,
       {_ratio('count(*)', 'count(DISTINCT merchant_id)')} AS per_merchant
FROM tx"""),
        "missing_value_profile": _tx(" UNION ALL ".join(
            f"SELECT '{name}' AS column_name, '{kind}' AS type, count(*) FILTER ({rule}) AS missing, "
            f"{_pct(f'count(*) FILTER ({rule})', 'count(*)')} AS missing_pct FROM tx"
            for name, (kind, rule) in MISSING.items())),
        "non_positive_amounts": _tx(
            f"SELECT id, amount, {AMOUNT}, client_id, card_id FROM tx WHERE {non_positive}"),
        "non_positive_summary": _tx(f"SELECT {_share(non_positive, 'non_positive')} FROM tx"),
        "transactions_without_mcc": _tx(f"SELECT {RAW} FROM tx WHERE {no_mcc}"),
        "without_mcc_summary": _tx(f"SELECT {_share(no_mcc, 'without_mcc')} FROM tx"),
        "transactions_with_errors": _tx(f"SELECT {RAW} FROM tx WHERE failed"),
        "with_errors_summary": _tx(f"SELECT {_share('failed', 'with_errors')} FROM tx"),
        "error_type_counts": _tx("""
SELECT errors, count(*) AS occurrences FROM tx WHERE failed
GROUP BY errors ORDER BY occurrences DESC, errors LIMIT 20"""),
        "quality_summary": _tx(f"""
SELECT count(*) AS transactions, {_share(non_positive, 'non_positive')},
       {_share('amount IS NOT NULL AND amount_clean IS NULL', 'unreadable_amounts')},
       {_share(no_mcc, 'without_mcc')}, {_share('failed', 'with_errors')}
FROM tx"""),
        "amount_statistics": _tx(f"""
SELECT {_int('sum(c)')} / (count(c) * 100) AS mean_amount, min(c) / 100 AS min_amount,
       max(c) / 100 AS max_amount, count(c) AS amounts
FROM tx"""),
        "amount_median": _tx(
            "SELECT quantile_disc(c, 0.5) / 100 AS median_amount FROM tx"),
        "amount_quartiles": _tx("""
SELECT quantile_disc(c, 0.25) / 100 AS q1, quantile_disc(c, 0.5) / 100 AS q2,
       quantile_disc(c, 0.75) / 100 AS q3
FROM tx"""),
        "amount_bands": _tx(f"""
SELECT CASE WHEN amount_clean < 10 THEN '< 10' WHEN amount_clean < 50 THEN '10 - 50'
            WHEN amount_clean < 200 THEN '50 - 200' ELSE '>= 200' END AS band,
       count(*) AS transactions, {_mean()} AS mean_amount, {_dollars('sum(c)')} AS total_amount,
       {_pct('count(*)', '(SELECT count(*) FROM tx)')} AS pct
FROM tx GROUP BY band"""),
        "temporal_columns": _tx(
            f"SELECT id, {DATE}, hour, dow AS weekday, {WEEKDAY}, month FROM tx"),
        "transactions_by_hour": _tx(
            "SELECT hour, count(*) AS transactions FROM tx GROUP BY hour"),
        "transactions_by_weekday": _tx(
            f"SELECT {WEEKDAY}, count(*) AS transactions FROM tx GROUP BY dow"),
        "transactions_by_month": _tx(
            "SELECT month, count(*) AS transactions FROM tx GROUP BY month"),
        "hour_share": _tx(f"""
SELECT hour, transactions, {_pct('transactions', 'sum(transactions) OVER ()')} AS pct,
       {_ratio('max(transactions) OVER ()', 'min(transactions) OVER ()')} AS peak_to_trough
FROM (SELECT hour, count(*) AS transactions FROM tx GROUP BY hour)"""),
        "transactions_with_category": _tx("""
SELECT id, mcc, merchant_category, amount
FROM tx LEFT JOIN codes ON CAST(mcc AS VARCHAR) = code""", CODES),
        "top_categories_by_volume": _tx(f"""
SELECT merchant_category, transactions FROM
({category.format(extra='1 AS one', order='transactions', n=10)})""", CODES),
        "category_amounts": _tx(category.format(
            extra=f"{_mean()} AS mean_amount, {_dollars('sum(c)')} AS total_amount",
            order="mean_amount", n=15), CODES),
        "error_type_share": _tx(f"""
SELECT errors, count(*) AS occurrences,
       {_pct('count(*)', '(SELECT count(*) FROM tx WHERE failed)')} AS pct,
       (SELECT count(*) FROM tx WHERE failed) AS error_rows, (SELECT count(*) FROM tx) AS total_rows
FROM tx WHERE failed GROUP BY errors ORDER BY occurrences DESC, errors LIMIT 20"""),
        "card_error_rate": _tx(f"""
SELECT card_id, {RATES} FROM tx GROUP BY card_id ORDER BY errors DESC, card_id LIMIT 20"""),
        "cards_all_errors": _tx(f"""
SELECT count(*) AS cards FROM (SELECT card_id FROM tx GROUP BY card_id HAVING bool_and(failed))"""),
        "client_error_rate": _tx(f"""
SELECT client_id, {RATES} FROM tx GROUP BY client_id ORDER BY errors DESC, client_id LIMIT 20"""),
        "client_error_rate_bands": _tx(f"""
SELECT CASE WHEN error_pct = 0 THEN '0%' WHEN error_pct < 5 THEN '0-5%'
            WHEN error_pct < 10 THEN '5-10%' WHEN error_pct < 25 THEN '10-25%'
            ELSE '>= 25%' END AS band, count(*) AS clients
FROM (SELECT client_id, {RATES} FROM tx GROUP BY client_id) GROUP BY band"""),
        "card_day_counts": _tx(
            f"SELECT card_id, {DAY}, count(*) AS transactions FROM tx GROUP BY card_id, tx.day"),
        "card_day_counts_top": _tx(f"""
SELECT card_id, {DAY}, count(*) AS transactions FROM tx GROUP BY card_id, tx.day
ORDER BY transactions DESC, card_id, tx.day LIMIT 15"""),
        "card_day_amounts": _tx(f"""
SELECT card_id, {DAY}, {_dollars('sum(c)')} AS total_amount FROM tx GROUP BY card_id, tx.day"""),
        "card_day_amounts_top": _tx(f"""
SELECT card_id, {DAY}, {_dollars('sum(c)')} AS total_amount FROM tx GROUP BY card_id, tx.day
ORDER BY sum(c) DESC NULLS LAST, card_id, tx.day LIMIT 15"""),
        "card_city_counts": _tx(f"""
SELECT card_id, count(DISTINCT merchant_city) AS physical_cities
FROM tx WHERE {PHYSICAL} GROUP BY card_id"""),
        "card_city_counts_top": _tx(f"""
SELECT card_id, count(DISTINCT merchant_city) AS physical_cities
FROM tx WHERE {PHYSICAL} GROUP BY card_id ORDER BY physical_cities DESC, card_id LIMIT 15"""),
        "card_error_ratio": _tx(f"SELECT card_id, {RATES} FROM tx GROUP BY card_id"),
        "card_error_ratio_top": _tx(f"""
SELECT card_id, {RATES} FROM tx GROUP BY card_id ORDER BY error_pct DESC, card_id LIMIT 15"""),
        **{name: _tx(f"""
SELECT card_id, count(*) AS transactions, {_dollars('sum(c)')} AS total_amount,
       {_mean()} AS mean_amount, count(DISTINCT day) AS active_days,
       count(DISTINCT merchant_city) AS cities, count(*) FILTER (failed) AS errors,
       {_pct('count(*) FILTER (failed)', 'count(*)')} AS error_pct
FROM tx GROUP BY card_id {tail}""") for name, tail in (
            ("card_indicators", ""),
            ("card_indicators_top", "ORDER BY transactions DESC, card_id LIMIT 20"))},
        "suspects_by_daily_count": _tx("SELECT card_id FROM by_count", SUSPECTS),
        "suspects_by_cities": _tx("SELECT card_id FROM by_cities", SUSPECTS),
        "suspects_by_daily_amount": _tx("SELECT card_id FROM by_amount", SUSPECTS),
        "suspicious_cards": _tx("SELECT * FROM suspects", SUSPECTS),
        "suspect_counts": _tx("""
SELECT (SELECT count(*) FROM by_count) AS by_daily_count,
       (SELECT count(*) FROM by_cities) AS by_cities,
       (SELECT count(*) FROM by_amount) AS by_daily_amount,
       (SELECT count(*) FROM suspects) AS suspicious_cards""", SUSPECTS),
        "suspect_details": _tx("SELECT * FROM details", DETAILS),
        "suspect_details_top": _tx(
            "SELECT * FROM details ORDER BY transactions DESC, card_id LIMIT 30", DETAILS),
        "client_indicators": _tx("SELECT * FROM indicators", INDICATORS),
        "client_population_stats": _tx("SELECT * FROM stats", INDICATORS),
        "client_risk_score": _tx("SELECT client_id, " + ", ".join(f"{p}_score" for p in PARTS)
                                 + ", risk_score FROM scores", SCORES),
        "client_risk_level": _tx("SELECT client_id, risk_score, risk_level FROM scores", SCORES),
        "risk_level_summary": _tx(f"""
SELECT risk_level, count(*) AS clients,
       {_mean('sum(round(risk_score * 100))', 'count(*)')} AS mean_score,
       {_mean('sum(round(total_amount * 100))', 'count(total_amount)')} AS mean_total_amount
FROM scores GROUP BY risk_level""", SCORES),
        "high_risk_clients": _tx("""
SELECT client_id, risk_score, risk_level, transactions, total_amount, cards, cities, errors, night
FROM scores WHERE risk_level = 'HIGH' ORDER BY risk_score DESC, client_id LIMIT 20""", SCORES),
        "score_components": _tx("SELECT client_id, risk_score, " + ", ".join(
            f"{_half_up(f'{p}_score', 1)} AS {p}_score" for p in PARTS)
            + " FROM scores ORDER BY risk_score DESC, client_id LIMIT 10", SCORES),
        "risk_scores_output": _tx("""
SELECT client_id, risk_score, risk_level, transactions, total_amount, mean_amount, cards, cities,
       errors
FROM scores""", SCORES),
        "suspicious_cards_output": _tx("""
SELECT card_id, client_id, transactions, cents / 100 AS total_amount, cities
FROM cards JOIN suspects USING (card_id)""", DETAILS),
        "risk_summary_output": _tx(f"""
SELECT risk_level, count(*) AS clients,
       {_dollars('sum(round(total_amount * 100))')} AS total_amount,
       {_mean('sum(round(risk_score * 100))', 'count(*)')} AS mean_score,
       {_int('sum(errors)')} AS errors
FROM scores GROUP BY risk_level""", SCORES),
        "client_classes": _tx("SELECT * FROM classes", SCORES),
        "behaviour_flags": _tx("""
SELECT id, CAST(failed AS INTEGER) AS has_error, CAST(online AS INTEGER) AS is_online,
       CAST(night AS INTEGER) AS is_night, CAST(dow IN (1, 7) AS INTEGER) AS is_weekend
FROM tx"""),
        "classified_transactions": _tx(f"""
SELECT id, client_id, {AMOUNT}, CAST(failed AS INTEGER) AS has_error,
       CAST(online AS INTEGER) AS is_online, CAST(night AS INTEGER) AS is_night,
       CAST(dow IN (1, 7) AS INTEGER) AS is_weekend, is_suspect
FROM classed""", SCORES),
        "group_general_stats": _tx(f"""
SELECT "group", count(DISTINCT client_id) AS clients, count(*) AS transactions,
       {_mean()} AS mean_amount, round(stddev_samp(c)) / 100 AS std_amount,
       min(c) / 100 AS min_amount, max(c) / 100 AS max_amount
FROM classed GROUP BY "group\"""", SCORES),
        "group_purchase_behaviour": _tx(f"""
SELECT "group", {_mean()} AS mean_amount,
       {_mean('sum(c)', 'count(DISTINCT client_id)')} AS amount_per_client,
       {_ratio('count(*)', 'count(DISTINCT client_id)')} AS transactions_per_client,
       {_pct('count(*) FILTER (online)', 'count(*)')} AS online_pct,
       count(DISTINCT mcc) AS distinct_mcc
FROM classed GROUP BY "group\"""", SCORES),
        "group_temporal_behaviour": _tx(f"""
SELECT "group", {_pct('count(*) FILTER (night)', 'count(*)')} AS night_pct,
       {_pct('count(*) FILTER (dow IN (1, 7))', 'count(*)')} AS weekend_pct,
       {_ratio('sum(hour)', 'count(hour)', 1)} AS mean_hour
FROM classed GROUP BY "group\"""", SCORES),
        "group_error_rate": _tx(f"""
SELECT "group", {_pct('count(*) FILTER (failed)', 'count(*)')} AS error_pct,
       count(*) FILTER (failed) AS errors, count(*) AS transactions
FROM classed GROUP BY "group\"""", SCORES),
        "group_geography": _tx(f"""
SELECT "group", count(DISTINCT merchant_city) AS cities, count(DISTINCT merchant_state) AS states,
       {_ratio('count(DISTINCT merchant_city)', 'count(DISTINCT client_id)')} AS cities_per_client
FROM classed GROUP BY "group\"""", SCORES),
        "group_amount_bands": _tx(f"""
SELECT {group_bands} AS band, count(*) FILTER (NOT is_suspect) AS NORMAL,
       count(*) FILTER (is_suspect) AS SUSPECT
FROM classed GROUP BY band""", SCORES),
        "group_top_mcc": _tx("""
SELECT "group", mcc, transactions, rank FROM (
  SELECT "group", mcc, count(*) AS transactions,
         row_number() OVER (PARTITION BY "group" ORDER BY count(*) DESC, mcc) AS rank
  FROM classed WHERE mcc IS NOT NULL GROUP BY "group", mcc)
WHERE rank <= 10""", SCORES),
        "group_shares": _tx(f"""
SELECT CASE WHEN is_suspect THEN 'SUSPECT' ELSE 'NORMAL' END AS "group", count(*) AS clients,
       {_pct('count(*)', '(SELECT count(*) FROM classes)', 1)} AS pct
FROM classes GROUP BY is_suspect""", SCORES),
        "typed_cards": """
SELECT c_custkey * 10 AS card_id,
       CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS DOUBLE) AS credit_limit,
       c_custkey % 4 <> 0 AS has_chip, c_custkey % 50 = 0 AS card_on_dark_web,
       strftime(make_date(2024 + c_custkey % 6, c_custkey % 12 + 1, 1), '%Y-%m-%d') AS expires,
       strftime(make_date(1995 + c_custkey % 25, c_custkey % 12 + 1, 1), '%Y-%m-%d')
         AS acct_open_date
FROM customer""",
        "typed_users": """
SELECT c_custkey AS client_id,
       CAST(CAST(abs(c_acctbal) * 3 AS DECIMAL(12,2)) AS DOUBLE) AS per_capita_income,
       CAST(CAST(abs(c_acctbal) * 6 AS DECIMAL(12,2)) AS DOUBLE) AS yearly_income,
       CAST(CAST(abs(c_acctbal) * 2 AS DECIMAL(12,2)) AS DOUBLE) AS total_debt
FROM customer""",
        "amount_flags": _tx(f"""
SELECT id, {AMOUNT}, amount_clean > 200 AS is_high_amount, amount_clean > 500 AS is_very_high_amount,
       amount_clean < 0 AS is_negative_amount
FROM tx"""),
        "night_flag": _tx("""
SELECT id, hour AS hour_of_day, dow AS day_of_week, hour BETWEEN 1 AND 5 AS is_night FROM tx"""),
        "online_flag": _tx("SELECT id, online AS is_online FROM tx"),
        "mcc_risk_level": _tx("SELECT id, merchant_category, CASE " + " ".join(
            f"WHEN merchant_category IN {_in(names)} THEN '{level}'"
            for level, names in CATEGORY_LEVELS.items())
            + " END AS mcc_risk_level FROM tx LEFT JOIN codes ON CAST(mcc AS VARCHAR) = code", CODES),
        "mcc_risk_by_code": _tx("SELECT id, mcc, CASE " + " ".join(
            f"WHEN mcc IN ({', '.join(map(str, codes))}) THEN '{level}'"
            for level, codes in CODE_LEVELS.items()) + " END AS mcc_risk_level FROM tx"),
        "error_suspicion_level": _tx("""
SELECT id, errors, CASE WHEN errors LIKE '%,%' THEN 'MODERATE'
       WHEN errors IN ('Bad PIN', 'Bad Card Number', 'Bad CVV', 'Bad Expiration') THEN 'HIGH'
       WHEN errors = 'Bad Zipcode' THEN 'MODERATE'
       WHEN errors IN ('Insufficient Balance', 'Technical Glitch') THEN 'LOW' END AS error_suspicion
FROM tx"""),
        "client_amount_profile": _tx(f"""
SELECT client_id, {_mean()} AS mean_amount, round(stddev_samp(c) / 100, 6) AS std_amount,
       count(*) AS transactions
FROM tx GROUP BY client_id"""),
        "client_rates": _tx(f"""
SELECT client_id, {_pct('count(*) FILTER (failed)', 'count(*)')} AS error_pct,
       {_pct('count(*) FILTER (hour BETWEEN 1 AND 5)', 'count(*)')} AS night_pct,
       {_pct('count(*) FILTER (amount_clean > 200)', 'count(*)')} AS high_amount_pct
FROM tx GROUP BY client_id"""),
        "client_mcc_profile": _tx("""
SELECT client_id, count(*) AS distinct_mcc,
       first(mcc ORDER BY n DESC, mcc) AS favourite_mcc
FROM (SELECT client_id, mcc, count(*) AS n FROM tx WHERE mcc IS NOT NULL GROUP BY client_id, mcc)
GROUP BY client_id"""),
        "error_causes": _tx("""
SELECT cause, count(*) AS occurrences
FROM (SELECT trim(unnest(string_split(errors, ','))) AS cause FROM tx WHERE failed)
WHERE cause <> '' GROUP BY cause"""),
        "card_error_rate_feature": _tx(f"""
SELECT card_id, {_pct('count(*) FILTER (failed)', 'count(*)')} AS error_pct
FROM tx GROUP BY card_id"""),
        "card_attributes": _tx(f"""
SELECT c_custkey * 10 AS card_id, c_custkey % 50 = 0 AS card_on_dark_web,
       c_custkey % 4 <> 0 AS has_chip,
       CAST(date_diff('month', make_date(1995 + c_custkey % 25, c_custkey % 12 + 1, 1),
                      DATE '{AS_OF}') // 12 AS INTEGER) AS card_age_years,
       CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS DOUBLE) AS credit_limit,
       {_pct('coalesce(spent, 0)', 'CAST(abs(c_acctbal) AS DECIMAL(12,2)) * 100')}
         AS utilisation_pct
FROM customer LEFT JOIN (
  SELECT card_id, sum(c) AS spent FROM tx
  WHERE date_trunc('month', date) = date_trunc('month', DATE '{AS_OF}') GROUP BY card_id
) ON card_id = c_custkey * 10"""),
        "card_utilisation": _tx(f"""
SELECT card_id, strftime(date, '%Y-%m') AS month, CAST(sum(c) AS BIGINT) / 100 AS spent,
       {_pct('coalesce(CAST(sum(c) AS BIGINT), 0)',
             'any_value(CAST(abs(c_acctbal) AS DECIMAL(12,2)) * 100)')} AS utilisation_pct
FROM tx JOIN customer ON card_id = c_custkey * 10
GROUP BY card_id, strftime(date, '%Y-%m')"""),
        "amount_vs_client_mean": _tx("""
SELECT id, client_id, CAST(amount_clean AS DOUBLE) AS amount, mean_c / 100 AS client_mean,
       (c - mean_c) / 100 AS difference, round(c / nullif(mean_c, 0), 6) AS ratio
FROM (SELECT *, CAST(round(CAST(sum(c) OVER w AS BIGINT) / count(c) OVER w) AS BIGINT) AS mean_c
      FROM tx WINDOW w AS (PARTITION BY client_id))"""),
        "time_since_previous": _tx(f"""
SELECT id, card_id, {SECOND} - lag({SECOND}) OVER (PARTITION BY card_id ORDER BY date, id) AS seconds
FROM tx"""),
        "first_at_merchant": _first("merchant_id", "is_first_at_merchant"),
        "first_in_mcc": _first("mcc", "is_first_in_mcc"),
        "consecutive_errors": _tx("""
SELECT id, card_id, CASE WHEN failed THEN
         row_number() OVER (PARTITION BY card_id, island, failed ORDER BY date, id) ELSE 0 END
         AS error_run
FROM (SELECT *, count(*) FILTER (NOT failed) OVER (PARTITION BY card_id ORDER BY date, id) AS island
      FROM tx)"""),
        "card_sequences_by_month": _tx(f"""
SELECT id, card_id, {SECOND} - lag({SECOND}) OVER (PARTITION BY card_id ORDER BY date, id) AS seconds,
       CASE WHEN failed THEN
         row_number() OVER (PARTITION BY card_id, island, failed ORDER BY date, id) ELSE 0 END
         AS error_run
FROM (SELECT *, count(*) FILTER (NOT failed) OVER (PARTITION BY card_id ORDER BY date, id) AS island
      FROM tx)"""),
        "first_at_merchant_by_month": _first("merchant_id", "is_first_at_merchant"),
        "first_in_mcc_by_month": _first("mcc", "is_first_in_mcc"),
        "velocity_1h": _velocity(3600),
        "velocity_24h": _velocity(86400),
        "labelled_metrics": _tx("""
SELECT count(*) AS labelled, count(*) FILTER (amount_clean > 200 AND fraud) AS true_positives,
       count(*) FILTER (amount_clean > 200 AND fraud) / count(*) FILTER (amount_clean > 200)
         AS precision,
       count(*) FILTER (amount_clean > 200 AND fraud) / count(*) FILTER (fraud) AS recall
FROM tx JOIN usable ON usable.id = tx.id""", LABELS),
        "label_coverage": _tx("""
SELECT (SELECT count(*) FROM usable WHERE id IN (SELECT id FROM tx)) AS labelled_transactions,
       (SELECT count(*) FROM usable WHERE id NOT IN (SELECT id FROM tx))
         AS labels_without_transaction,
       (SELECT count(*) FROM tx WHERE id NOT IN (SELECT id FROM labelled))
         AS transactions_without_label,
       (SELECT count(*) FROM labelled WHERE id % 43 = 0) AS contradictory_labels,
       (SELECT count(*) FROM labelled WHERE id % 43 <> 0 AND id % 41 = 0) AS unreadable_labels""",
                              LABELS),
        "published_outputs": _tx("""
SELECT 'risk_scores' AS table_name, count(*) AS table_rows,
       CAST(sum(transactions) AS BIGINT) AS total FROM scores UNION ALL
SELECT 'suspicious_cards', count(*), CAST(sum(transactions) AS BIGINT) FROM details UNION ALL
SELECT 'risk_summary', count(DISTINCT risk_level), count(*) FROM scores""", SCORES, DETAILS),
        "streaming_card_velocity": _tx(f"""
SELECT card_id, {DAY}, n AS transactions, c / 100 AS total_amount,
       n > {THRESHOLDS.daily_count} AS over_daily_count,
       c > {THRESHOLDS.daily_amount * 100} AS over_daily_amount
FROM card_days
WHERE n > {THRESHOLDS.daily_count} OR c > {THRESHOLDS.daily_amount * 100}""", CARD_DAYS),
        "approximate_volumetry": _tx("""
SELECT 'transactions' AS measure, count(*) AS exact, TRUE AS within_error FROM tx UNION ALL
SELECT 'clients', count(DISTINCT client_id), TRUE FROM tx UNION ALL
SELECT 'cards', count(DISTINCT card_id), TRUE FROM tx UNION ALL
SELECT 'merchants', count(DISTINCT merchant_id), TRUE FROM tx"""),
        "approximate_client_indicators": _tx("""
SELECT client_id, transactions, total_amount, mean_amount, max_amount, errors, night, online,
       TRUE AS cards_within_error, TRUE AS cities_within_error, TRUE AS active_days_within_error,
       TRUE AS merchants_within_error
FROM indicators""", INDICATORS),
        "approximate_quantiles": (
            "SELECT unnest([0.25, 0.5, 0.75])::DOUBLE AS probability, TRUE AS within_error"),
        "unreadable_amounts": _tx("SELECT * FROM unreadable", UNREADABLE),
        "unreadable_summary": _tx(
            "SELECT reason, count(*) AS transactions FROM unreadable GROUP BY reason", UNREADABLE),
        "live_card_alerts": _tx(f"""
SELECT card_id, {DAY}, 'daily_count' AS criterion FROM card_days WHERE n > {THRESHOLDS.daily_count}
UNION ALL
SELECT card_id, {DAY}, 'daily_amount' FROM card_days WHERE c > {THRESHOLDS.daily_amount * 100}
UNION ALL
SELECT card_id, NULL, 'cities' FROM tx WHERE merchant_city NOT IN ('', 'ONLINE')
GROUP BY card_id HAVING count(DISTINCT merchant_city) > {THRESHOLDS.cities}""", CARD_DAYS),
    }
    out["classified_transactions_by_client"] = out["classified_transactions"]
    for name in REPORTS:  # the report of the highest rows, and the whole table
        out[f"{name}_top"] = out[name]
        out[name] = out[name].rpartition(" LIMIT ")[0]
    return out
