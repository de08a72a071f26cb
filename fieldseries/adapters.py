"""The given tables seen as sensor data: readings, deployment windows, ports, logs.

events are readings (a series an event type, a device a user), orders are deployments (a device a
customer, a type a priority), lineitem joined to orders are readings of those devices.  Each
adapter is a projection; no row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def instant(name: str):
    """A parquet time as an instant of the UTC session."""
    return F.col(name).cast("timestamp")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    part = F.col("event_id") % 3
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series"),
        F.col("user_id").cast("string").alias("device_serial"),
        (k % 6 + 1).cast("int").alias("port"),
        F.col("event_type").alias("sensor"),
        F.lit("reading").alias("measurement"),
        instant("ts").alias("datetime"),
        "value",
        F.concat(F.lit("f"), part).alias("source_file"),
        (F.lit("2024-02-01").cast("timestamp") + F.make_dt_interval(days=part.cast("int"))).alias("fetched_utc"),
        F.col("event_id").alias("row_seq"),
    )


def order_deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("device_serial"),
        F.concat(F.lit("st"), F.col("o_orderkey") % 100).alias("station_id"),
        F.lower("o_orderpriority").alias("station_type"),
        F.col("o_orderkey").alias("unique_id"),
        instant("o_orderdate").alias("deploy_datetime"),
        F.when(F.col("o_orderstatus") == "F", "removed").otherwise("online").alias("status"),
        F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 400).cast("int")).alias("last_visit"),
    )


def item_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The times of item readings, and of lines without an order."""
    return table(spark, sf_dir, "lineitem").select(instant("l_shipdate").alias("datetime"))


def item_readings(spark: SparkSession, sf_dir: str, more: dict[str, Column] | None = None) -> DataFrame:
    """lineitem with the customer of its order as the device; row_seq is not unique, as lines repeat.

    more: columns that are made of a line before it meets its order, which moves them instead of what they are made of.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("device_serial"))
    i = table(spark, sf_dir, "lineitem").withColumns(more or {})
    return i.join(o, i["l_orderkey"] == o["o_orderkey"]).select("device_serial", F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("port"), instant("l_shipdate").alias("datetime"), F.col("l_quantity").alias("value"), "l_suppkey", "l_partkey", *(more or ()))
