"""Validity windows: deployments and port configurations as half-open intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# States of a row whose device is no longer there.
TERMINAL = ("removed", "replaced", "relocated", "decommissioned")


def is_terminal(status: Column) -> Column:
    return F.coalesce(F.lower(status).isin(*TERMINAL), F.lit(False))


def terminal_rows(deployments: DataFrame) -> DataFrame:
    return deployments.filter(is_terminal(F.col("status")))


def active_rows(deployments: DataFrame) -> DataFrame:
    return deployments.filter(~is_terminal(F.col("status")))


def end_of_day(day: Column, zone: str | None = None) -> Column:
    """The instant 23:59:59 of a day, in a zone (UTC without one)."""
    t = day.cast("date").cast("timestamp") + F.expr("interval 86399 seconds")
    return F.to_utc_timestamp(t, zone) if zone else t


def deployment_windows(deployments: DataFrame, zone: str | None = None) -> DataFrame:
    """One window a deployment: [starts, ends), a null end being open.

    deployments: device_serial, station_id, station_type, unique_id, deploy_datetime, status, last_visit.
    A window ends at the next strictly later start of the same device and type; a terminal one ends at
    the close of its last visit if that is earlier, or if nothing follows.  Without either it stays open and
    says so (end_basis `unknown`).  Rows without a start have no window.
    """
    at, terminal = F.unix_micros("deploy_datetime").alias("_at"), is_terminal(F.col("status"))
    last = F.when(terminal & F.col("last_visit").isNotNull(), end_of_day(F.col("last_visit"), zone))
    d = deployments.filter(F.col("deploy_datetime").isNotNull()).select("device_serial", "station_id", F.lower("station_type").alias("station_type"), "unique_id", at, last.alias("_out"), terminal.alias("_terminal"))
    # by value, not by row: equal starts do not end each other
    later = Window.partitionBy("device_serial", "station_type").orderBy("_at").rangeBetween(1, Window.unboundedFollowing)
    d = d.withColumn("_next", F.timestamp_micros(F.min("_at").over(later)))
    out = F.col("_out")
    visit_first = out.isNotNull() & (F.col("_next").isNull() | (out < F.col("_next")))
    ends = F.when(visit_first, out).otherwise(F.col("_next"))
    basis = F.when(visit_first, "last visit").when(F.col("_next").isNotNull(), "successor").when(F.col("_terminal"), "unknown").otherwise("open")
    return d.select("device_serial", "station_id", "station_type", "unique_id", F.timestamp_micros("_at").alias("starts"), ends.alias("ends"), basis.alias("end_basis"))


def port_windows(ports: DataFrame) -> DataFrame:
    """Windows of ports that have a sensor: device_serial, port, type, sensor, depth_cm, starts, ends."""
    has = F.col("sensor").isNotNull() & (F.lower("sensor") != "none")
    return ports.filter(has).select(F.col("sn").alias("device_serial"), F.col("port").cast("int").alias("port"), F.lower("type").alias("type"), "sensor", "depth_cm", F.col("valid_from").alias("starts"), F.col("valid_to").alias("ends"))


def active_ports(ports: DataFrame, type: str | None = None) -> DataFrame:
    """Open configurations with a sensor, of one type if given."""
    open_ = ports.filter(F.col("valid_to").isNull() & F.col("sensor").isNotNull() & (F.lower("sensor") != "none"))
    return open_ if type is None else open_.filter(F.lower("type") == type.lower())


def devices_in_years(windows: DataFrame, years: DataFrame) -> DataFrame:
    """(station_id, year, device_serial) of windows that touch a year of `years` (year, y0, y1).

    Years are few by nature; each window is dealt to the years between its ends, so nothing is cross-joined.
    """
    span = years.agg(F.min("year").alias("a"), F.max("year").alias("b")).first()
    if span is None or span.a is None:
        return windows.select("station_id", F.lit(None).cast("int").alias("year"), "device_serial").limit(0)
    first = F.greatest(F.year("starts") - 1, F.lit(span.a))
    last = F.least(F.coalesce(F.year("ends") + 1, F.lit(span.b)), F.lit(span.b))
    dealt = windows.filter(first <= last).withColumn("year", F.explode(F.sequence(first, last)))
    hit = dealt.join(years, "year").filter((F.col("starts") < F.col("y1")) & (F.col("ends").isNull() | (F.col("ends") >= F.col("y0"))))
    return hit.select("station_id", "year", "device_serial").distinct()
