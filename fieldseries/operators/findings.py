"""What needs attention in a network: findings (station_id, device_serial, severity, issue, kind), and the roster."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .topk import first_of, severity_order
from .windows import active_ports, active_rows

#: Readings that a hand-read logger holds.
CAPACITY = 21_600
BROKEN = ("defunct", "nonresponsive")
COLUMNS = ["station_id", "device_serial", "severity", "issue", "kind"]


def _days(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / 86_400_000_000


def _found(df: DataFrame, severity: Column | str, issue: Column | str, kind: str) -> DataFrame:
    text = lambda c: F.lit(c) if isinstance(c, str) else c
    return df.select(F.col("station_id").cast("string").alias("station_id"), F.col("device_serial").cast("string").alias("device_serial"), text(severity).alias("severity"), text(issue).alias("issue"), F.lit(kind).alias("kind"))


def _whole(x: Column) -> Column:
    return F.rint(x).cast("bigint").cast("string")


def silent(deployments: DataFrame, devices: DataFrame, now: Column, tie: str = "unique_id") -> DataFrame:
    """Devices of the source (device_serial, last_measurement) without a reading for over a day, or a week (high)."""
    place = first_of(active_rows(deployments).filter("device_serial is not null"), ["device_serial"], [F.col(tie)]).select("device_serial", "station_id")
    d = devices.filter("last_measurement is not null").join(place, "device_serial", "left").withColumns({"station_id": F.coalesce("station_id", F.lit("(not in metadata)")), "_d": _days(now, F.col("last_measurement"))})
    long = F.col("_d") > 7
    return _found(d.filter("_d > 1"), F.when(long, "high").otherwise("medium"), F.concat(F.lit("silent for "), F.when(long, F.concat(_whole(F.col("_d")), F.lit(" days"))).otherwise(F.concat(_whole(F.col("_d") * 24), F.lit(" hours")))), "reporting")


def unknown_reporters(deployments: DataFrame, devices: DataFrame) -> DataFrame:
    d = devices.select("device_serial").distinct().join(deployments.select("device_serial").distinct(), "device_serial", "left_anti")
    return _found(d.withColumn("station_id", F.lit("(none)")), "medium", "reports but is in no table", "not established")


def low_battery(deployments: DataFrame, now: Column) -> DataFrame:
    d = active_rows(deployments).filter("battery < 25").withColumn("_d", _days(now, F.col("last_download")))
    age = F.when(F.col("_d") >= 1, F.concat(F.lit(", "), _whole(F.col("_d")), F.lit(" days old"))).otherwise("")
    return _found(d, F.when(F.col("battery") < 15, "high").otherwise("medium"), F.concat(F.lit("battery at "), F.col("battery").cast("string"), F.lit("%"), age), "battery")


def memory_forecast(deployments: DataFrame, observed: DataFrame, now: Column) -> DataFrame:
    """Hand-read loggers that are full within 60 days (high within 14).

    A logger fills CAPACITY readings after its last offload, else its start, at the observed interval (device_serial,
    minutes), else the declared one; without either it is left out.
    """
    d = active_rows(deployments).filter(~F.lower("device_serial").startswith("z")).join(observed.select("device_serial", F.col("minutes").alias("_seen")), "device_serial", "left")
    minutes, since = F.coalesce(F.when(F.col("_seen") > 0, F.col("_seen")), F.col("interval_min").cast("double")), F.coalesce("last_download", "deploy_datetime")
    d = d.filter((minutes > 0) & since.isNotNull()).withColumn("_left", _days(since, now) + CAPACITY * minutes / 1440)
    left = F.when(F.col("_left") < 0, F.concat(F.lit("full, "), _whole(-F.col("_left")), F.lit(" days lost"))).otherwise(F.concat(F.lit("full in "), _whole(F.col("_left")), F.lit(" days")))
    differs = (F.col("_seen") > 0) & (F.abs(F.col("_seen") - F.col("interval_min")) > 0.001)
    never = F.when(F.col("last_download").isNull(), F.when(F.coalesce(F.col("_seen") > 0, F.lit(False)), ", no offload yet").otherwise(", no offload yet, interval not verified")).otherwise("")
    note = F.when(differs, ", logs at another interval than declared").otherwise(never)
    return _found(d.filter("_left <= 60"), F.when(F.col("_left") <= 14, "high").otherwise("medium"), F.concat(left, note), "memory")


def _working(deployments: DataFrame) -> DataFrame:
    return active_rows(deployments).filter(~F.lower("status").isin(*BROKEN))


def subscriptions(deployments: DataFrame, now: Column) -> DataFrame:
    d = _working(deployments).withColumn("_d", _days(F.col("expiry_date").cast("timestamp"), now))
    over = F.col("_d") < 0
    return _found(d.filter("_d < 60"), F.when(over, "high").otherwise("medium"), F.when(over, F.concat(F.lit("expired "), _whole(-F.col("_d")), F.lit(" days ago"))).otherwise(F.concat(F.lit("expires in "), _whole(F.col("_d")), F.lit(" days"))), "subscription")


def without_ports(deployments: DataFrame, ports: DataFrame, tie: str = "unique_id") -> DataFrame:
    cloud = first_of(active_rows(deployments).filter(F.col("device_serial").startswith("z6")), ["device_serial"], [F.col(tie)])
    return _found(cloud.join(active_ports(ports).select(F.col("sn").alias("device_serial")).distinct(), "device_serial", "left_anti"), "high", "no open port", "ports")


def known_broken(deployments: DataFrame) -> DataFrame:
    seen = F.when(F.col("last_visit").isNotNull(), F.concat(F.lit(", seen "), F.col("last_visit").cast("string"))).otherwise("")
    return _found(active_rows(deployments).filter(F.lower("status").isin(*BROKEN)), "medium", F.concat(F.lower("status"), seen), "known broken")


def stale_reviews(deployments: DataFrame, now: Column) -> DataFrame:
    d = _working(deployments).withColumn("_d", _days(now, F.col("last_reviewed")))
    return _found(d.filter("_d is null or _d > 180"), "low", F.when(F.col("_d").isNull(), "never reviewed").otherwise(F.concat(F.lit("reviewed "), _whole(F.col("_d") / 30.4), F.lit(" months ago"))), "metadata review")


def unsurveyed_pairs(deployments: DataFrame) -> DataFrame:
    d = _working(deployments).filter(F.lower("device_role").isin("secondary", "tertiary") & (F.lower("station_type") == "hydro"))
    missing = F.concat_ws(" and ", F.when(F.col("elev").isNull(), "elevation"), F.when(F.col("reach_length_m").isNull(), "reach length"))
    return _found(d.filter("elev is null or reach_length_m is null"), "low", F.concat(F.lit("not surveyed: "), missing), "survey")


def source_unavailable(spark: SparkSession) -> DataFrame:
    """The one finding that stands for all that could not be looked at: absence is said, never passed over."""
    return spark.range(1).select(F.lit(None).cast("string").alias("station_id"), F.lit(None).cast("string").alias("device_serial"), F.lit("high").alias("severity"), F.lit("device list not available: reporting and new devices not checked").alias("issue"), F.lit("error").alias("kind"))


def network_findings(deployments: DataFrame, ports: DataFrame, devices: DataFrame | None, observed: DataFrame, now: str, tie: str = "unique_id") -> DataFrame:
    """All findings in a report's order, with its ranks.  devices: what the source lists, None where it is not available.

    `now` is a literal, so that a report can be repeated.
    """
    at = F.lit(now).cast("timestamp")
    listed = [silent(deployments, devices, at, tie), unknown_reporters(deployments, devices)] if devices is not None else [source_unavailable(deployments.sparkSession)]
    parts = [*listed, low_battery(deployments, at), memory_forecast(deployments, observed, at), subscriptions(deployments, at), without_ports(deployments, ports, tie), known_broken(deployments), stale_reviews(deployments, at), unsurveyed_pairs(deployments)]
    return severity_order(reduce(DataFrame.unionByName, parts))


def network_roster(deployments: DataFrame, devices: DataFrame, log: DataFrame) -> DataFrame:
    """Active rows with last contact (by the source), data_to (the end of what is archived), and whether they report."""
    contact = devices.groupBy("device_serial").agg(F.max("last_measurement").alias("last_contact"))
    archived = log.groupBy("device_serial").agg(F.max("end_date").alias("data_to"))
    out = active_rows(deployments).join(contact, "device_serial", "left").join(archived, "device_serial", "left")
    return out.withColumn("reports", F.lower("status").isin("online", "nonresponsive"))


def newest_observed(readings: DataFrame) -> DataFrame:
    """(device_serial, minutes): the most frequent gap, in minutes, of the readings of each device's newest file."""
    newest = readings.groupBy("device_serial").agg(F.max_by("source_file", F.struct("datetime", "source_file")).alias("source_file"))
    r = readings.join(newest, ["device_serial", "source_file"], "left_semi").select("device_serial", "datetime").distinct()
    gap = F.round((F.unix_micros("datetime") - F.unix_micros(F.lag("datetime").over(Window.partitionBy("device_serial").orderBy("datetime")))) / 6e7, 3)
    counted = r.withColumn("_g", gap).filter("_g > 0").groupBy("device_serial", "_g").agg(F.count("*").alias("n"))
    best = counted.groupBy("device_serial").agg(F.sum("n").alias("gaps"), F.min(F.struct((-F.col("n")).alias("o"), "_g")).alias("b"))
    return best.filter("gaps > 1").select("device_serial", F.col("b._g").alias("minutes"))
