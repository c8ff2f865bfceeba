"""Views over the test tables that stand for the panel's inputs (see FIXTURES.md), in Spark and as SQL for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(bank_name, card_type, month, outstanding, txn_vol, n_rows); the last, partial month is left out."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rows = (
        line.select("l_orderkey", "l_linestatus", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"), F.col("l_quantity").cast("decimal(18,2)").alias("quantity"))
        .join(orders.select("o_orderkey", "o_custkey", F.trunc("o_orderdate", "MM").alias("month")), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(nation.select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows at any scale
    )
    return (
        rows.filter("month <= date'2001-07-01'")
        .groupBy(F.col("n_name").alias("bank_name"), F.when(F.col("l_linestatus") == "F", "cc").otherwise("dc").alias("card_type"), "month")
        .agg(F.sum("price").cast("double").alias("outstanding"), F.sum("quantity").cast("double").alias("txn_vol"), F.count(F.lit(1)).alias("n_rows"))
    )


PANEL = """panel AS (
  SELECT n_name AS bank_name, CASE WHEN l_linestatus = 'F' THEN 'cc' ELSE 'dc' END AS card_type, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS outstanding, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS txn_vol, count(*) AS n_rows
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE date_trunc('month', o_orderdate) <= DATE '2001-07-01' GROUP BY 1, 2, 3)"""


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(card_type, month, total): the panel's sum, plus a tenth for what no entity reports."""
    return panel(spark, sf_dir).groupBy("card_type", "month").agg((F.sum(F.col("outstanding").cast("decimal(18,2)")) * F.lit(1.1).cast("decimal(3,1)")).cast("double").alias("total"))


TOTALS = "totals AS (SELECT card_type, month, CAST(sum(CAST(outstanding AS DECIMAL(18,2))) * CAST(1.1 AS DECIMAL(3,1)) AS DOUBLE) AS total FROM panel GROUP BY 1, 2)"


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(month, m1, m2): mean order price and share of urgent orders."""
    orders = table(spark, sf_dir, "orders").withColumn("month", F.trunc("o_orderdate", "MM")).filter("month <= date'2001-07-01'")
    return orders.groupBy("month").agg(
        (F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("m1"),
        (F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1)) / F.count(F.lit(1))).alias("m2"),
    )


MACRO = """macro AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS m1,
         count(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 END) / count(*) AS m2
  FROM orders WHERE date_trunc('month', o_orderdate) <= DATE '2001-07-01' GROUP BY 1)"""


def rate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(effective_ts, rate): sparse change events."""
    return table(spark, sf_dir, "events").filter("event_type = 'signup'").select(F.col("ts").cast("timestamp").alias("effective_ts"), F.col("value").alias("rate"))


RATES = "rates AS (SELECT CAST(ts AS TIMESTAMP) AS effective_ts, value AS rate FROM events WHERE event_type = 'signup')"


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, bank, source, v): three overlapping sources for each key."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    name = F.when(F.col("l_returnflag") == "A", "consolidated").when(F.col("l_returnflag") == "R", "monthly_xlsx").otherwise("monthly_xls")
    return (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows at any scale
        .groupBy(F.trunc("o_orderdate", "MM").alias("date"), F.col("n_name").alias("bank"), name.alias("source"))
        .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("v"))
    )


SOURCES = """sources AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, n_name AS bank,
         CASE l_returnflag WHEN 'A' THEN 'consolidated' WHEN 'R' THEN 'monthly_xlsx' ELSE 'monthly_xls' END AS source, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS v
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, 3)"""


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, signal_type, bank_name, impact_direction, impact_magnitude, discovered_at): findings, from events."""
    kind = F.element_at(F.create_map(*(F.lit(x) for p in SIGNAL_TYPES.items() for x in p)), F.col("event_type"))
    third = F.pmod(F.floor("value"), F.lit(3))
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("long").alias("id"),
        kind.alias("signal_type"),
        F.concat(F.lit("bank_"), F.pmod("user_id", F.lit(5)).cast("string")).alias("bank_name"),
        F.when(third == 0, "positive").when(third == 1, "negative").otherwise("neutral").alias("impact_direction"),
        F.when(F.pmod("event_id", F.lit(3)) == 0, "high").when(F.pmod("event_id", F.lit(3)) == 1, "medium").otherwise("low").alias("impact_magnitude"),
        F.col("ts").cast("timestamp").alias("discovered_at"),
    )


SIGNAL_TYPES = {"purchase": "new_card_launch", "error": "card_discontinuation", "signup": "partnership", "view": "macro_policy", "click": "growth_target"}
SIGNALS = """signals AS (
  SELECT CAST(event_id AS BIGINT) AS id,
         CASE event_type WHEN 'purchase' THEN 'new_card_launch' WHEN 'error' THEN 'card_discontinuation' WHEN 'signup' THEN 'partnership' WHEN 'view' THEN 'macro_policy' WHEN 'click' THEN 'growth_target' END AS signal_type,
         'bank_' || CAST(user_id % 5 AS VARCHAR) AS bank_name,
         CASE CAST(floor(value) AS BIGINT) % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS impact_direction,
         CASE event_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS impact_magnitude, CAST(ts AS TIMESTAMP) AS discovered_at FROM events)"""


# The signal types, the column each feeds and how; magnitudes and directions as numbers.
SIGNAL_RULES = [
    ("new_card_launch", "new_products", "count", 1.0),
    ("card_discontinuation", "discontinued", "count", -1.0),
    ("regulatory_change", "rbi_regulatory", "direction", 1.0),
    ("partnership", "partnerships", "count", 1.0),
    ("growth_target", "bank_bullish", "flag", 1.0),
    ("infrastructure_change", "infra_change", "direction", 1.0),
    ("macro_policy", "macro_signal", "direction", 1.0),
    ("market_event", "market_event", "direction", 1.0),
]
MAGNITUDES = {"high": 3.0, "medium": 2.0, "low": 1.0}
DIRECTIONS = {"positive": 1.0, "negative": -1.0, "neutral": 0.0}
