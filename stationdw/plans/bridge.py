"""Mapping of the driver's TPC-H-like tables onto the climate model.

The driver tables hold no climate data, so the operators run on this mapping:

* **station**: a nation (``n_nationkey`` as id, ``n_name`` as name, ``n_regionkey`` in the
  latitude role), reached through ``orders -> customer -> nation``.
* **daily reading** of a station: the orders of its customers on one day; minimum and maximum
  order total (DECIMAL(12,2)) play the daily minimum / maximum temperature in tenths of a
  degree, and the running count of the month's orders plays month-to-date precipitation in
  hundredths of an inch.
* **raw message stream**: every event becomes one JSON message (``user_id`` as station id,
  ``USER <id>`` as name, except that an ``error`` event carries no name and is malformed,
  ``value`` as elevation and for the temperatures, ``props.k`` for latitude and month-to-date,
  the event day as ``norm_date``); arrival order is ``event_id``.

Scale notes: orders (the only large input) is pruned to three columns and joined to customer
on ``custkey`` (sort-merge with AQE skew splitting, or a runtime broadcast when customer is
small), then aggregated to one row per nation-day with partial aggregation before the shuffle,
so the month-to-date window and everything after it works on a small table. The nation table
(a fixed 25-row table) is joined after the aggregation behind a bounded size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationdw.sources.messages import to_raw_messages
from stationdw.sources.tables import read_table

PRICE = T.DecimalType(12, 2)
COUNT_DEC = T.DecimalType(20, 2)


def orders_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging-shaped daily readings (one row per nation and order day)."""
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    price = F.col("o_totalprice").cast(PRICE)
    per_day = (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
               .groupBy(F.col("c_nationkey"), F.to_date("o_orderdate").alias("norm_date"))
               .agg(F.min(price).alias("dly_tmin_normal"),
                    F.max(price).alias("dly_tmax_normal"),
                    F.count(F.lit(1)).alias("_orders")))
    month = Window.partitionBy("c_nationkey", F.year("norm_date"), F.month("norm_date")) \
        .orderBy("norm_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    with_mtd = per_day.withColumn("mtd_prcp_normal",
                                  F.sum("_orders").over(month).cast(COUNT_DEC))
    named = with_mtd.join(nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
    return named.select(
        F.col("c_nationkey").cast("string").alias("station_id"),
        F.col("n_name").alias("station_name"),
        F.lit(None).cast(T.DecimalType(8, 2)).alias("elevation"),
        F.col("n_regionkey").cast(T.DecimalType(10, 6)).alias("latitude"),
        F.lit(None).cast(T.DecimalType(10, 6)).alias("longitude"),
        "norm_date", "dly_tmin_normal", "dly_tmax_normal", "mtd_prcp_normal",
    )


def event_readings(spark: SparkSession, sf_dir: str, events: DataFrame | None = None
                   ) -> DataFrame:
    """Message-shaped rows of the events table, with ``_arrival`` = event_id."""
    if events is None:
        events = read_table(spark, sf_dir, "events",
                            ["event_id", "ts", "user_id", "event_type", "value", "props"])
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.col("user_id").cast("string").alias("station_id"),
        F.when(F.col("event_type") != F.lit("error"),
               F.concat(F.lit("USER "), F.col("user_id").cast("string"))).alias("station_name"),
        F.col("value").alias("elevation"),
        k.cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.date_format("ts", "yyyyMMdd").alias("norm_date"),
        F.floor("value").cast("int").alias("dly_tmin_normal"),
        F.ceil("value").cast("int").alias("dly_tmax_normal"),
        k.cast("int").alias("mtd_prcp_normal"),
        F.col("event_id").alias("_arrival"),
    )


def event_messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None
                   ) -> DataFrame:
    """The events table as a raw JSON message topic: ``value`` text and ``_arrival``."""
    return to_raw_messages(event_readings(spark, sf_dir, events))
