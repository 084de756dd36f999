"""Registered queries on row rules and values: name -> (Spark query, the same as SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemill.functions import (
    cast_declared,
    clean_value,
    coerce_numeric,
    local_iso,
    null_if_token,
    strip_thousands,
)
from sievemill.functions.values import NUMBER_SHAPE
from sievemill.operators import quality
from sievemill.operators.amounts import amount_features, preview
from sievemill.registry import build_registry
from sievemill.session import fill_cores

REASON = quality.REASON


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark, sf):
    """Customers, whose segment MACHINERY is taken for a null token."""
    return table(spark, sf, "customer").withColumn("c_mktsegment", null_if_token("c_mktsegment", ["MACHINERY"]))


CUSTOMERS = """(SELECT c_custkey, c_name, c_nationkey, c_acctbal,
    CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS c_mktsegment FROM customer)"""

CUSTOMER_RULES = {
    "c_mktsegment": {"non_null": True},
    "c_acctbal": {"min_value": 0, "max_value": 9000},
    "c_nationkey": {"allowed_values": [0, 1, 2, 3, 5, 8, 13, 21]},
}
CUSTOMER_REASON = """nullif(concat_ws('; ',
    CASE WHEN c_mktsegment IS NULL THEN 'Column ''c_mktsegment'': is null' END,
    CASE WHEN c_acctbal < 0 THEN 'Column ''c_acctbal'': is less than 0' END,
    CASE WHEN c_acctbal > 9000 THEN 'Column ''c_acctbal'': is greater than 9000' END,
    CASE WHEN c_nationkey NOT IN (0, 1, 2, 3, 5, 8, 13, 21)
         THEN 'Column ''c_nationkey'': is not one of 0, 1, 2, 3, 5, 8, 13, 21' END), '')"""
CHECKED_CUSTOMERS = f"(SELECT *, {CUSTOMER_REASON} AS quarantine_reason FROM {CUSTOMERS})"


def reasons_only(df: DataFrame, rules: dict, *keys: str) -> DataFrame:
    return quality.with_reasons(df, rules).select(*keys, REASON)


def price_text(order):
    return F.col(order).cast("decimal(18,2)").cast("string")


PRICE_TEXT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"


# --- flagship -------------------------------------------------------------------------------------------------------


def quality_summary(spark, sf):
    checked = quality.with_reasons(customers(spark, sf), CUSTOMER_RULES)
    return checked.groupBy("c_mktsegment", REASON).agg(F.count(F.lit(1)).alias("rows_total"))


QUALITY_SUMMARY = f"""SELECT c_mktsegment, quarantine_reason, count(*) AS rows_total FROM {CHECKED_CUSTOMERS}
    GROUP BY c_mktsegment, quarantine_reason"""


# --- single rules ---------------------------------------------------------------------------------------------------


def non_null(spark, sf):
    return reasons_only(customers(spark, sf), {"c_mktsegment": {"non_null": True}}, "c_custkey")


def min_value(spark, sf):
    return reasons_only(table(spark, sf, "customer"), {"c_acctbal": {"min_value": 0}}, "c_custkey")


def max_value(spark, sf):
    return reasons_only(table(spark, sf, "orders"), {"o_totalprice": {"max_value": 400000}}, "o_orderkey")


def pattern_match(spark, sf):
    return reasons_only(table(spark, sf, "part"), {"p_brand": {"pattern_match": "^Brand#1[0-9]$"}}, "p_partkey")


def allowed_values(spark, sf):
    rules = {"p_type": {"allowed_values": ["STANDARD", "PROMO", "LARGE"]}}
    return reasons_only(table(spark, sf, "part"), rules, "p_partkey")


def price_or_word(spark, sf):
    """Orders with a price as text, where open orders in progress carry a word instead."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(price_text("o_totalprice")).alias("price"),
    )


def non_numeric(spark, sf):
    return reasons_only(price_or_word(spark, sf), {"price": {"min_value": 100000}}, "o_orderkey", "price")


NON_NUMERIC = f"""SELECT o_orderkey, price, CASE
      WHEN NOT regexp_matches(price, '{NUMBER_SHAPE}') THEN 'Column ''price'': failed numeric conversion for range check'
      WHEN TRY_CAST(price AS DOUBLE) < 100000 THEN 'Column ''price'': is less than 100000' END AS quarantine_reason
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE {PRICE_TEXT} END AS price FROM orders)"""


# --- rule sets and splits -------------------------------------------------------------------------------------------


def multi_reason(spark, sf):
    return reasons_only(customers(spark, sf), CUSTOMER_RULES, "c_custkey")


def split_valid(spark, sf):
    return quality.split_rows(customers(spark, sf), CUSTOMER_RULES, "customer.csv")[0]


def split_quarantine(spark, sf):
    source = F.concat(F.lit("customer_"), F.col("c_nationkey").cast("string"), F.lit(".csv"))
    return quality.split_rows(customers(spark, sf), CUSTOMER_RULES, source)[1]


def no_rules(spark, sf):
    return quality.counts_by(quality.with_reasons(table(spark, sf, "orders"), {}), "o_orderpriority")


def missing_column_rule(spark, sf):
    rules = {"s_phone": {"non_null": True}, "s_acctbal": {"min_value": 0}}
    return reasons_only(table(spark, sf, "supplier"), rules, "s_suppkey")


def daily_rows(lines: DataFrame) -> DataFrame:
    """Line items as daily market rows in text form: open unreturned ones lack a date, returned ones a positive volume."""
    quantity = F.col("l_quantity").cast("int")
    undated = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.when(~undated, F.date_format("l_shipdate", "yyyy/M/d")).alias("trading_date"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.date_format("l_shipdate", "yyyyMM").alias("expiry_month"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("close"),
        F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).cast("string").alias("volume"),
    )


DAILY_ROWS = """(SELECT l_orderkey, l_linenumber,
      CASE WHEN NOT (l_returnflag = 'N' AND l_linestatus = 'O')
           THEN year(l_shipdate) || '/' || month(l_shipdate) || '/' || day(l_shipdate) END AS trading_date,
      CAST(l_partkey AS VARCHAR) AS product_id, strftime(l_shipdate, '%Y%m') AS expiry_month,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS close,
      CAST(CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS VARCHAR)
        AS volume FROM lineitem)"""
DAILY_REASON = """nullif(concat_ws('; ',
      CASE WHEN trading_date IS NULL THEN 'Column ''trading_date'': is null' END,
      CASE WHEN TRY_CAST(volume AS DOUBLE) < 0 THEN 'Column ''volume'': is less than 0' END), '')"""


def ruleset_daily(spark, sf):
    lines = fill_cores(table(spark, sf, "lineitem"), "l_orderkey")
    return reasons_only(
        daily_rows(lines), build_registry().rules["default_daily"], "l_orderkey", "l_linenumber", "product_id", "close"
    )


def partition_invariant(spark, sf):
    data = customers(spark, sf)
    valid, bad = quality.split_rows(data, CUSTOMER_RULES, "customer.csv")

    def flagged(df, *flags):
        return df.select("c_nationkey", *[F.lit(f).alias(n) for n, f in zip(("i", "v", "q"), flags)])

    parts = flagged(data, 1, 0, 0).unionByName(flagged(valid, 0, 1, 0)).unionByName(flagged(bad, 0, 0, 1))
    counts = parts.groupBy("c_nationkey").agg(
        F.sum("i").alias("rows_in"), F.sum("v").alias("rows_valid"), F.sum("q").alias("rows_quarantined")
    )
    return counts.withColumn("is_partition", F.col("rows_in") == F.col("rows_valid") + F.col("rows_quarantined"))


def counts_by_file(spark, sf):
    checked = quality.with_reasons(table(spark, sf, "orders"), {"o_totalprice": {"min_value": 50000, "max_value": 400000}})
    return quality.counts_by(checked, "o_orderpriority")


# --- values ---------------------------------------------------------------------------------------------------------


def numbers_from_text(spark, sf):
    """Prices in several spellings, by order status: padded, with separators, with a suffix."""
    price, status = price_text("o_totalprice"), F.col("o_orderstatus")
    text = (
        F.when(status == "P", F.concat(price, F.lit("d")))
        .when((status == "F") & (F.col("o_orderpriority") == "1-URGENT"), F.format_number("o_totalprice", 2))
        .when(status == "F", F.concat(F.lit("  +"), price, F.lit(" ")))
        .otherwise(F.concat(price, F.lit("e1")))
    )
    return table(spark, sf, "orders").select("o_orderkey", coerce_numeric(text).alias("amount"))


NUMBERS_FROM_TEXT = f"""SELECT o_orderkey,
      CASE WHEN regexp_matches(t, '{NUMBER_SHAPE}') THEN TRY_CAST(trim(t) AS DOUBLE) END AS amount
    FROM (SELECT o_orderkey, CASE
        WHEN o_orderstatus = 'P' THEN {PRICE_TEXT} || 'd'
        WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN format('{{:,.2f}}', o_totalprice)
        WHEN o_orderstatus = 'F' THEN '  +' || {PRICE_TEXT} || ' '
        ELSE {PRICE_TEXT} || 'e1' END AS t FROM orders)"""


def thousands(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", strip_thousands(F.format_number("o_totalprice", 2)).alias("amount_text")
    )


def null_tokens(spark, sf):
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.lit(" -- "))
        .when(priority == "2-HIGH", F.lit("\t "))
        .when(priority == "3-MEDIUM", F.lit("nan"))
        .when(priority == "5-LOW", F.lit("　None"))
        .otherwise(F.concat(F.lit(" "), priority, F.lit("　")))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", clean_value(text, ["null_tokens", "thousands"]).alias("cleaned")
    )


def declared_types(spark, sf):
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    date_text = (
        F.when(status == "O", F.date_format(day, "yyyy/M/d"))
        .when(status == "F", F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "dd.MM.yyyy"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        cast_declared(date_text, "DATE").alias("as_date"),
        cast_declared(price_text("o_totalprice"), "DOUBLE").alias("as_double"),
        cast_declared(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")), "BIGINT").alias("as_bigint"),
        cast_declared(F.concat(F.col("o_custkey").cast("string"), F.lit(".5")), "BIGINT").alias("not_bigint"),
        cast_declared("o_orderpriority", "VARCHAR").alias("as_text"),
    )


DECLARED_TYPES = """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS as_date,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS as_double, o_custkey AS as_bigint,
      CAST(NULL AS BIGINT) AS not_bigint, o_orderpriority AS as_text FROM orders"""


def event_times(spark, sf):
    return table(spark, sf, "events").select("event_id", local_iso("ts").alias("local_time"))


EVENT_TIMES = """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(ts, '%f') END || '+08:00' AS local_time FROM events"""


def features(spark, sf):
    return amount_features(table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("amount")))


FEATURES = """(SELECT c_custkey, c_acctbal AS amount, abs(c_acctbal) AS absolute_amount,
      CASE WHEN c_acctbal >= 0 THEN 'credit' ELSE 'debit' END AS transaction_type FROM customer)"""


def feature_preview(spark, sf):
    return preview(features(spark, sf), ["c_custkey"], 5)


QUERIES = {
    "dq_summary": (quality_summary, QUALITY_SUMMARY),
    "dq_non_null": (
        non_null,
        f"""SELECT c_custkey, CASE WHEN c_mktsegment IS NULL THEN 'Column ''c_mktsegment'': is null' END AS quarantine_reason
            FROM {CUSTOMERS}""",
    ),
    "dq_min_value": (
        min_value,
        """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'Column ''c_acctbal'': is less than 0' END AS quarantine_reason
           FROM customer""",
    ),
    "dq_max_value": (
        max_value,
        """SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'Column ''o_totalprice'': is greater than 400000' END
           AS quarantine_reason FROM orders""",
    ),
    "dq_pattern_match": (
        pattern_match,
        """SELECT p_partkey, CASE WHEN NOT regexp_matches(p_brand, '^Brand#1[0-9]$')
           THEN 'Column ''p_brand'': does not match pattern ^Brand#1[0-9]$' END AS quarantine_reason FROM part""",
    ),
    "dq_allowed_values": (
        allowed_values,
        """SELECT p_partkey, CASE WHEN p_type NOT IN ('STANDARD', 'PROMO', 'LARGE')
           THEN 'Column ''p_type'': is not one of STANDARD, PROMO, LARGE' END AS quarantine_reason FROM part""",
    ),
    "dq_non_numeric": (non_numeric, NON_NUMERIC),
    "dq_multi_reason": (multi_reason, f"SELECT c_custkey, quarantine_reason FROM {CHECKED_CUSTOMERS}"),
    "dq_split_valid": (
        split_valid,
        f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM {CHECKED_CUSTOMERS}
            WHERE quarantine_reason IS NULL""",
    ),
    "dq_split_quarantine": (
        split_quarantine,
        f"""SELECT *, 'customer_' || c_nationkey || '.csv' AS source_file FROM {CHECKED_CUSTOMERS}
            WHERE quarantine_reason IS NOT NULL""",
    ),
    "dq_no_rules": (
        no_rules,
        """SELECT o_orderpriority, count(*) AS rows_total, count(*) AS rows_valid, CAST(0 AS BIGINT) AS rows_quarantined
           FROM orders GROUP BY o_orderpriority""",
    ),
    "dq_missing_column_rule": (
        missing_column_rule,
        """SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'Column ''s_acctbal'': is less than 0' END AS quarantine_reason
           FROM supplier""",
    ),
    "dq_ruleset_daily": (
        ruleset_daily,
        f"SELECT l_orderkey, l_linenumber, product_id, close, {DAILY_REASON} AS quarantine_reason FROM {DAILY_ROWS}",
    ),
    "dq_partition_invariant": (
        partition_invariant,
        f"""SELECT c_nationkey, count(*) AS rows_in, count(*) FILTER (quarantine_reason IS NULL) AS rows_valid,
            count(*) FILTER (quarantine_reason IS NOT NULL) AS rows_quarantined, true AS is_partition
            FROM {CHECKED_CUSTOMERS} GROUP BY c_nationkey""",
    ),
    "dq_counts_by_file": (
        counts_by_file,
        """SELECT o_orderpriority, count(*) AS rows_total,
           count(*) FILTER (o_totalprice BETWEEN 50000 AND 400000) AS rows_valid,
           count(*) FILTER (o_totalprice NOT BETWEEN 50000 AND 400000) AS rows_quarantined
           FROM orders GROUP BY o_orderpriority""",
    ),
    "coerce_numeric": (numbers_from_text, NUMBERS_FROM_TEXT),
    "clean_thousands": (thousands, f"SELECT o_orderkey, {PRICE_TEXT} AS amount_text FROM orders"),
    "clean_null_tokens": (
        null_tokens,
        """SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN o_orderpriority END AS cleaned
           FROM orders""",
    ),
    "cast_declared_types": (declared_types, DECLARED_TYPES),
    "ts_to_local_iso": (event_times, EVENT_TIMES),
    "xf_amount_features": (features, f"SELECT * FROM {FEATURES}"),
    "xf_preview": (feature_preview, f"SELECT * FROM {FEATURES} ORDER BY c_custkey LIMIT 5"),
}
