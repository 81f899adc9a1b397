"""The test tables in the roles of the warehouse relations, and the same mappings as SQL.

lineitem plays the shots, orders the matches, events the web events and hourly readings.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicemill.functions.columns import derive_flags
from slicemill.plans.registry import table

NARROW = (dt.date(1998, 6, 14), dt.date(1998, 6, 24))
WIDE = (dt.date(1996, 1, 1), dt.date(2001, 1, 1))
FIRST_YEAR, LAST_YEAR = 1996, 2003
LOWEST = dt.date(1900, 1, 1)

FACT_SQL = """
fact AS (
  SELECT CAST(l_shipdate AS DATE) AS match_date,
         CASE WHEN l_linestatus = 'F' THEN 'main' ELSE 'partner' END AS source_system,
         l_orderkey AS match_id, l_suppkey AS team_id, l_partkey AS player_id,
         least(l_linenumber, 5) AS period,
         CASE WHEN l_tax >= 0.07 THEN 'Penalty' ELSE 'Open Play' END AS shot_type,
         CASE l_returnflag WHEN 'R' THEN 'Goal' WHEN 'A' THEN 'Saved' ELSE 'Blocked' END AS outcome,
         CAST(l_discount AS DECIMAL(12,10)) AS xg,
         least(l_linenumber, 5) = 5 AS is_shootout, l_tax >= 0.07 AS is_penalty,
         l_returnflag IN ('R', 'A') AS is_on_target, l_returnflag = 'R' AS is_goal
  FROM lineitem)"""


def shot_fact(lineitem: DataFrame) -> DataFrame:
    """lineitem as a flat shot fact with its flags."""
    typed = lineitem.select(
        F.to_date("l_shipdate").alias("match_date"),
        F.when(F.col("l_linestatus") == "F", "main").otherwise("partner").alias("source_system"),
        F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("team_id"),
        F.col("l_partkey").alias("player_id"), F.least("l_linenumber", F.lit(5)).alias("period"),
        F.when(F.col("l_tax") >= 0.07, "Penalty").otherwise("Open Play").alias("shot_type"),
        F.when(F.col("l_returnflag") == "R", "Goal").when(F.col("l_returnflag") == "A", "Saved")
        .otherwise("Blocked").alias("outcome"),
        F.col("l_discount").cast("decimal(12,10)").alias("xg"))
    return derive_flags(typed)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shot_fact(table(spark, sf_dir, "lineitem"))


def fact_slice(spark: SparkSession, sf_dir: str, start: dt.date, end: dt.date) -> DataFrame:
    """The fact of a slice, with the slice also on the stored column so that the scan can skip."""
    stored = F.col("l_shipdate")
    rows = table(spark, sf_dir, "lineitem").where((stored >= F.lit(start)) & (stored < F.lit(end)))
    return shot_fact(rows)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a plain order day."""
    return table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))


def exact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with exact price and day, as a business table."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.to_date("o_orderdate").alias("day"), "o_orderpriority")


EXACT_ORDERS_SQL = """
eo AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
              CAST(o_orderdate AS DATE) AS day, o_orderpriority FROM orders)"""


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with exact value, day, hour and the key inside the JSON properties."""
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.to_date("ts").alias("event_date"), F.hour("ts").alias("hour_of_day"), "user_id",
        "event_type", F.col("value").cast("decimal(12,2)").alias("value"), "props")


EVENTS_SQL = """
ev AS (SELECT event_id, ts, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS BIGINT) AS hour_of_day, user_id,
              event_type, CAST(value AS DECIMAL(12,2)) AS value, props FROM events)"""
