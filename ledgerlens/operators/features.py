"""Indicators for single transactions, clients and cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.flags import has_error, is_night, is_online
from ledgerlens.functions.money import cents, dollars, parse_money, with_amount
from ledgerlens.functions.ratios import mean_amount, mean_cents, percent
from ledgerlens.operators.errors import error_rates
from ledgerlens.plans.staging import stage

HIGH_AMOUNT = 200
VERY_HIGH_AMOUNT = 500

# Risk level of merchant categories.
CATEGORY_RISK = {
    "VERY_HIGH": ["Money Transfer"],
    "HIGH": ["Steelworks", "Steel Products Manufacturing", "Miscellaneous Metal Fabrication",
             "Miscellaneous Fabricated Metal Products", "Coated and Laminated Products",
             "Steel Drums and Barrels", "Fabricated Structural Metal Products",
             "Miscellaneous Metals", "Non-Ferrous Metal Foundries",
             "Electroplating, Plating, Polishing Services", "Non-Precious Metal Services",
             "Miscellaneous Metalwork", "Heat Treating Metal Services", "Ironwork"],
    "MODERATE": ["Cruise Lines", "Airlines", "Taxicabs and Limousines"],
    "LOW": ["Grocery Stores, Supermarkets", "Service Stations"],
}

# The same by category code.
CODE_RISK = {
    "VERY_HIGH": [4829],
    "HIGH": [3000, 3001, 3005, 3006, 3007, 3008, 3009, 3066, 3359, 3387, 3389, 3390, 3393, 3405],
    "MODERATE": [4411, 4511, 4121],
    "LOW": [5411, 5541],
}

# How strongly an error cause points to fraud.
ERROR_SUSPICION = {
    "HIGH": ["Bad PIN", "Bad Card Number", "Bad CVV", "Bad Expiration"],
    "MODERATE": ["Bad Zipcode"],
    "LOW": ["Insufficient Balance", "Technical Glitch"],
}


def _level(value: Column, levels: dict[str, list[str]]) -> Column:
    """Name of the level that lists ``value``; null when none does."""
    return F.coalesce(*[F.when(value.isin(*members), level) for level, members in levels.items()])


def typed_cards(cards: DataFrame, date_format: str = "MM/yyyy") -> DataFrame:
    """Credit limit as decimal, yes/no as boolean, dates as dates; bad values become null."""
    def yes_no(name: str) -> Column:
        text = F.upper(F.trim(F.col(name)))
        return F.when(text == "YES", True).when(text == "NO", False)

    def as_date(name: str) -> Column:
        return F.try_to_date(F.col(name), date_format)

    return cards.withColumns({
        "credit_limit": parse_money(F.col("credit_limit")),
        "has_chip": yes_no("has_chip"),
        "card_on_dark_web": yes_no("card_on_dark_web"),
        "expires": as_date("expires"),
        "acct_open_date": as_date("acct_open_date"),
    })


def typed_users(users: DataFrame) -> DataFrame:
    return users.withColumns({name: parse_money(F.col(name)) for name in
                              ("per_capita_income", "yearly_income", "total_debt")})


def amount_flags(transactions: DataFrame) -> DataFrame:
    """High, very high and negative amounts; false where there is no valid amount."""
    amount = F.col("amount_clean")
    return with_amount(transactions).withColumns({
        "is_high_amount": F.coalesce(amount > HIGH_AMOUNT, F.lit(False)),
        "is_very_high_amount": F.coalesce(amount > VERY_HIGH_AMOUNT, F.lit(False)),
        "is_negative_amount": F.coalesce(amount < 0, F.lit(False)),
    })


def night_flag(transactions: DataFrame, first_hour: int = 1, last_hour: int = 5) -> DataFrame:
    """Hour, weekday (1 is Sunday) and whether the hour lies in the night."""
    return transactions.withColumns({
        "hour_of_day": F.hour("date"),
        "day_of_week": F.dayofweek("date"),
        "is_night": is_night(F.col("date"), first_hour, last_hour),
    })


def online_flag(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn("is_online", is_online())


def risk_table(spark: SparkSession, levels: dict[str, list], key: str, kind: str) -> DataFrame:
    """Rules as rows (``key``, mcc_risk_level)."""
    rows = [(member, level) for level, members in levels.items() for member in members]
    return spark.createDataFrame(rows, f"{key} {kind}, mcc_risk_level string")


def mcc_risk_level(categorised: DataFrame, levels: DataFrame | None = None,
                   key: str = "merchant_category") -> DataFrame:
    """Risk level by the table ``levels`` (``key``, mcc_risk_level, one row a key); null where it has
    none. By default the rules above, by ``merchant_category`` or by ``mcc``. Spark chooses the join
    by the table's size."""
    if levels is None:
        rules, kind = (CODE_RISK, "int") if key == "mcc" else (CATEGORY_RISK, "string")
        levels = risk_table(categorised.sparkSession, rules, key, kind)
    return categorised.join(levels, key, "left")


def error_suspicion_level(transactions: DataFrame,
                          levels: dict[str, list[str]] | None = None) -> DataFrame:
    """Suspicion of the error text. Several causes at once are moderate; no error gives null."""
    level = (F.when(F.contains(F.col("errors"), F.lit(",")), "MODERATE")
             .otherwise(_level(F.col("errors"), levels or ERROR_SUSPICION)))
    return transactions.withColumn("error_suspicion", level)


def error_causes(transactions: DataFrame) -> DataFrame:
    """Rows per single cause, combined error texts split."""
    return (transactions.filter(F.col("errors") != "")
            .select(F.explode(F.split("errors", ",")).alias("part"))
            .select(F.trim("part").alias("cause")).filter(F.col("cause") != "")
            .groupBy("cause").agg(F.count("*").alias("occurrences"))
            .orderBy(F.desc("occurrences"), "cause"))


def client_amount_profile(transactions: DataFrame) -> DataFrame:
    """Mean, sample deviation and number of transactions per client."""
    c = cents(F.col("amount_clean"))
    return with_amount(transactions).groupBy("client_id").agg(
        mean_amount(F.sum(c), F.count(c)).alias("mean_amount"),
        dollars(F.stddev_samp(c)).alias("std_amount"),
        F.count("*").alias("transactions"))


def client_rates(transactions: DataFrame) -> DataFrame:
    """Percent of failed, night and high-amount transactions per client."""
    n = F.count("*")
    return with_amount(transactions).groupBy("client_id").agg(
        percent(F.count_if(has_error()), n).alias("error_pct"),
        percent(F.count_if(is_night(first_hour=1)), n).alias("night_pct"),
        percent(F.count_if(F.col("amount_clean") > HIGH_AMOUNT), n).alias("high_amount_pct"))


def client_mcc_profile(transactions: DataFrame) -> DataFrame:
    """Distinct codes and the most used code per client, the lowest code among equals.

    Reduced to (client, code) first; the favourite is then a plain aggregate over few rows.
    """
    per_code = (transactions.filter(F.col("mcc").isNotNull())
                .groupBy("client_id", "mcc").agg(F.count("*").alias("n")))
    return per_code.groupBy("client_id").agg(
        F.count("*").alias("distinct_mcc"),
        F.max_by("mcc", F.struct(F.col("n"), -F.col("mcc"))).alias("favourite_mcc"))


def card_error_rate_feature(transactions: DataFrame) -> DataFrame:
    return error_rates(transactions, "card_id").select("card_id", "error_pct")


def card_attributes(cards: DataFrame, transactions: DataFrame, as_of: str,
                    card_key: str = "card_id") -> DataFrame:
    """Dark web, chip, age in years, credit limit and utilisation of typed cards.

    Utilisation is the spending of the month of ``as_of`` as a percentage of the limit. The month is
    compared with the raw date, so the scan skips other months.
    """
    day = F.to_date(F.lit(as_of))
    month = F.trunc(day, "month")
    spent = (with_amount(transactions)
             .filter((F.col("date") >= month) & (F.col("date") < F.add_months(month, 1)))
             .groupBy(F.col("card_id").alias(card_key))
             .agg(F.sum(cents(F.col("amount_clean"))).alias("spent")))
    limit = cents(F.col("credit_limit"))
    return cards.join(spent, card_key, "left").select(
        card_key, "card_on_dark_web", "has_chip",
        F.floor(F.months_between(day, F.col("acct_open_date")) / 12).cast("int")
        .alias("card_age_years"),
        F.col("credit_limit").cast("double").alias("credit_limit"),
        percent(F.coalesce("spent", F.lit(0)), limit).alias("utilisation_pct"))


def card_utilisation(cards: DataFrame, transactions: DataFrame, card_key: str = "card_id",
                     month: str | None = None) -> DataFrame:
    """Spending of each card and month as a percentage of the typed card's limit.

    Every month with transactions is there; ``month`` (its first day) keeps one. Landed facts have
    the column ``date_month``, and the filter then picks folders before it reads them.
    """
    facts = with_amount(transactions)
    if month is not None:
        day = F.lit(month).cast("date")
        facts = facts.filter((F.col("date") >= day) & (F.col("date") < F.add_months(day, 1)))
        if "date_month" in facts.columns:
            facts = facts.filter(F.col("date_month") == month[:7])
    spent = facts.groupBy(F.col("card_id").alias(card_key),
                          F.date_format("date", "yyyy-MM").alias("month")).agg(
        F.sum(cents(F.col("amount_clean"))).alias("spent"))
    return spent.join(cards.select(card_key, "credit_limit"), card_key).select(
        card_key, "month", dollars(F.col("spent")).alias("spent"),
        percent(F.coalesce("spent", F.lit(0)), cents(F.col("credit_limit")))
        .alias("utilisation_pct"))


def amount_vs_client_mean(transactions: DataFrame) -> DataFrame:
    """Distance and ratio of each amount to the client's mean.

    The means are joined, not computed in a window per client, which would gather all rows of a
    client in one task. They are staged first: with a table on that side Spark broadcasts it if it is
    small, and otherwise shuffles both sides and can split a busy client at run time.
    """
    c = cents(F.col("amount_clean"))
    facts = with_amount(transactions).select("id", "client_id", "amount_clean")
    means = stage(facts.groupBy("client_id").agg(
        mean_cents(F.sum(c), F.count(c)).alias("mean_c")), "client_means")
    return facts.join(means, "client_id", "left").select(
        "id", "client_id", F.col("amount_clean").cast("double").alias("amount"),
        dollars(F.col("mean_c")).alias("client_mean"),
        dollars(c - F.col("mean_c")).alias("difference"),
        F.round(F.try_divide(c, F.col("mean_c")), 6).alias("ratio"))


def labelled_metrics(flags: DataFrame, labels: DataFrame, key: str = "id", flag: str = "flagged",
                     label: str = "is_fraud") -> DataFrame:
    """Precision and recall of a boolean flag against boolean labels for the same keys."""
    both = F.count_if(F.col(flag) & F.col(label))
    return flags.join(labels, key).agg(
        F.count("*").alias("labelled"), both.alias("true_positives"),
        F.try_divide(both, F.count_if(flag)).alias("precision"),
        F.try_divide(both, F.count_if(label)).alias("recall"))


def label_coverage(transactions: DataFrame, labels: DataFrame, key: str = "id",
                   label: str = "is_fraud") -> DataFrame:
    """One row: how labels and transactions meet, counted by ids.

    Ids with an unreadable label count as such only; an id with both labels is contradictory and
    counts in no other figure of the labels. Rows without an id are left out.
    """
    said = (labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("low"), F.max(label).alias("high"))
            .withColumns({"unreadable": F.col("low").isNull(), "two": F.col("low") != F.col("high"),
                          "labelled": F.lit(True)}))
    ids = transactions.where(F.col(key).isNotNull()).select(key).distinct().withColumn(
        "known", F.lit(True))
    two, unreadable = F.coalesce("two", F.lit(False)), F.coalesce("unreadable", F.lit(False))
    usable = F.col("labelled").isNotNull() & ~two & ~unreadable
    return said.join(ids, key, "full").agg(
        F.count_if(usable & F.col("known").isNotNull()).alias("labelled_transactions"),
        F.count_if(usable & F.col("known").isNull()).alias("labels_without_transaction"),
        F.count_if(F.col("known").isNotNull() & F.col("labelled").isNull()).alias(
            "transactions_without_label"),
        F.count_if(two).alias("contradictory_labels"),
        F.count_if(unreadable).alias("unreadable_labels"))


def usable_labels(labels: DataFrame, key: str = "id", label: str = "is_fraud") -> DataFrame:
    """One row an id, of ids with readable labels that all agree."""
    return (labels.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.min(label).alias(label), F.max(label).alias("other"))
            .where(F.col(label) == F.col("other")).drop("other"))
