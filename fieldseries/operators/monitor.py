"""Profiles of files and devices, and what needs attention in a network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import PROJECT_ZONE
from .diff import union_all
from .windows import active_rows, is_terminal

# The keys, which are the stages of pending work; each with where the data are.
STAGES = {
    "awaiting_offload": "on the device",
    "awaiting_shuttle_drop": "on the shuttle",
    "awaiting_temp_csv": "not exported",
    "awaiting_rename": "not renamed",
    "awaiting_cloud_upload": "not uploaded",
}


def profile_files(readings: DataFrame, keys: list[str], zone: str = PROJECT_ZONE) -> DataFrame:
    """Rows, distinct stamps, first and last local day and total by file: one aggregation over the archive."""
    local = F.from_utc_timestamp("datetime", zone)
    return readings.groupBy(*keys).agg(F.count("*").alias("rows"), F.count_distinct("datetime").alias("stamps"), F.min(local).cast("date").alias("first_day"), F.max(local).cast("date").alias("last_day"), F.sum("value").alias("total"))


def _files_in_order(readings: DataFrame) -> DataFrame:
    """A row a device and file: its first and last reading (a, b), their number, and the file before it."""
    f = readings.groupBy("device_serial", "source_file").agg(F.min("datetime").alias("a"), F.max("datetime").alias("b"), F.count("*").alias("n"))
    return f.withColumn("_before", F.lag(F.struct("source_file", "b")).over(Window.partitionBy("device_serial").orderBy("a", "source_file")))


def _break(hours: float) -> Column:
    return F.unix_micros("a") - F.unix_micros("_before.b") > hours * 3_600_000_000


def coverage_gaps(readings: DataFrame, gap_hours: float = 12) -> DataFrame:
    """A row a break of more than gap_hours between one file's end and the next one's start: device_serial, after_file, ends,
    before_file, starts, hours."""
    g = _files_in_order(readings).filter(_break(gap_hours))
    hours = F.round((F.unix_micros("a") - F.unix_micros("_before.b")) / 3_600_000_000, 4)
    return g.select("device_serial", F.col("_before.source_file").alias("after_file"), F.col("_before.b").alias("ends"), F.col("source_file").alias("before_file"), F.col("a").alias("starts"), hours.alias("hours"))


def device_coverage(readings: DataFrame, gap_hours: int = 12) -> DataFrame:
    """Files, readings, span and breaks between one file's end and the next one's start, by device."""
    g = _files_in_order(readings).withColumn("_g", F.coalesce(_break(gap_hours), F.lit(False)))
    return g.groupBy("device_serial").agg(F.count("*").alias("files"), F.sum("n").alias("readings"), F.min("a").alias("first"), F.max("b").alias("last"), F.count_if("_g").alias("gaps"))


def device_findings(devices: DataFrame, reporting: DataFrame, known: DataFrame, now: str, medium_hours: int = 24, high_hours: int = 168) -> DataFrame:
    """Findings (device_serial, issue, severity): silent devices, low batteries, unknown reporters.

    devices: device_serial, last_record, battery (percent).  `now` is a literal, so that a report can be repeated.
    """
    silent = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("last_record")) / 3_600_000_000
    found = [
        devices.filter(silent > medium_hours).select("device_serial", F.lit("silent").alias("issue"), F.when(silent > high_hours, "high").otherwise("medium").alias("severity")),
        devices.filter("battery < 25").select("device_serial", F.lit("low battery").alias("issue"), F.when(F.col("battery") < 15, "high").otherwise("medium").alias("severity")),
        reporting.join(known, "device_serial", "left_anti").distinct().select("device_serial", F.lit("unknown reporter").alias("issue"), F.lit("medium").alias("severity")),
    ]
    return union_all(found).withColumn("device_serial", F.col("device_serial").cast("string"))


def latest_fact_join(deployments: DataFrame, readings: DataFrame, is_battery: Column) -> DataFrame:
    """Active deployments with their device's newest battery and last reading; terminal ones get neither."""
    facts = readings.groupBy("device_serial").agg(F.max_by(F.when(is_battery, F.col("value")), F.when(is_battery, F.col("datetime"))).alias("_b"), F.max("datetime").alias("_l"))
    live = ~is_terminal(F.col("status"))
    out = deployments.join(facts, "device_serial", "left")
    return out.withColumns({"battery": F.when(live, F.col("_b")), "last_record": F.when(live, F.col("_l"))}).drop("_b", "_l")


def station_counts(deployments: DataFrame) -> DataFrame:
    """Active rows, devices and the newest deployment by station."""
    return active_rows(deployments).groupBy("station_id").agg(F.count("*").alias("live_rows"), F.count_distinct("device_serial").alias("devices"), F.max("deploy_datetime").alias("last_deploy"))


def pending_ages(pending: DataFrame, today: str, stale_days: int = 14) -> DataFrame:
    """Pending tasks with age, what they wait for, and whether they are stale."""
    age = F.datediff(F.lit(today).cast("date"), F.col("created").cast("date"))
    labels = F.create_map(*[F.lit(x) for p in STAGES.items() for x in p])
    return pending.withColumns({"age_days": age, "label": F.coalesce(F.try_element_at(labels, F.col("stage")), F.lit("unknown stage")), "stale": age > stale_days})


def years_to_build(windows: DataFrame, spans: DataFrame, first: int, last: int, zone: str = PROJECT_ZONE) -> DataFrame:
    """(station_id, year): local years of a station's deployments in which its devices' files (device_serial, a, b) lie."""
    y = lambda t: F.year(F.from_utc_timestamp(t, zone))
    j = windows.join(spans, "device_serial")
    lo = F.greatest(y("starts"), F.col("a"), F.lit(first))
    hi = F.least(F.coalesce(y("ends"), F.lit(last)), F.col("b"), F.lit(last))
    return j.filter(lo <= hi).select("station_id", F.explode(F.sequence(lo, hi)).alias("year")).distinct()
