"""Orders and picks: the current row of a station or device, the newest file, six-slot port views, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import parse_raw_filename
from .windows import is_terminal

# Ranks of roles, kinds of findings and severities.
ROLES = ("primary", "secondary", "tertiary")
KINDS = ("reporting", "battery", "memory", "survey", "known broken", "subscription", "ports", "not established", "metadata review", "error")
SEVERITIES = ("high", "medium", "low", "error")
SLOTS = 6


def rank_in(value: Column, known: tuple[str, ...]) -> Column:
    """Place of a value in a fixed order, from 1; what is not in it comes after all."""
    ranks = F.create_map(*[x for i, k in enumerate(known) for x in (F.lit(k), F.lit(i + 1))])
    return F.coalesce(F.try_element_at(ranks, F.lower(F.trim(value))), F.lit(len(known) + 1))


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; order must decide."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def current_station_row(deployments: DataFrame, tie: str = "unique_id") -> DataFrame:
    """One row a station: active rows before terminal ones, then the newest start; rows without a start come last."""
    return first_of(deployments, ["station_id"], [is_terminal(F.col("status")), F.col("deploy_datetime").desc_nulls_last(), F.col(tie).desc()])


def device_row(deployments: DataFrame, wanted: DataFrame, tie: str = "unique_id") -> DataFrame:
    """One row for each wanted (device_serial, station_id): active before terminal, then the first.

    A null station asks for any; a station that the device never stood at does not narrow.
    """
    w = wanted.select("device_serial", F.col("station_id").alias("asked")).distinct()
    d = deployments.join(w, "device_serial").withColumn("_here", F.coalesce(F.col("station_id") == F.col("asked"), F.lit(False)))
    return first_of(d, ["device_serial", "asked"], [F.col("_here").desc(), is_terminal(F.col("status")), F.col(tie)]).drop("_here")


def role_order(deployments: DataFrame, tie: str = "unique_id") -> DataFrame:
    """role_rank (primary, secondary, tertiary, others) and each row's place at its station by it, then by serial."""
    d = deployments.withColumn("role_rank", rank_in(F.col("device_role"), ROLES))
    return d.withColumn("place", F.row_number().over(Window.partitionBy("station_id").orderBy("role_rank", F.col("device_serial").asc_nulls_last(), tie)))


def latest_run(runs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return first_of(runs, keys, [F.col(c).desc_nulls_last() for c in order])


def newest_file_per_device(files: DataFrame, path: str = "filepath") -> DataFrame:
    """(device_serial, filepath, end_date) of the raw file with the latest end, then the latest stamp; no stamp comes first."""
    parsed = files.select(path, parse_raw_filename(F.element_at(F.split(path, "/"), -1)).alias("f")).select(path, "f.*")
    named = parsed.filter("device_serial is not null")
    best = F.max(F.struct("end_date", F.coalesce("stamp", F.lit("")).alias("stamp"), path)).alias("b")
    return named.groupBy("device_serial").agg(best).select("device_serial", F.col("b")[path].alias(path), "b.end_date")


def severity_order(findings: DataFrame) -> DataFrame:
    """Findings with the ranks that a report is ordered by: kind, severity, station."""
    ranked = findings.withColumns({"kind_rank": rank_in(F.col("kind"), KINDS), "severity_rank": rank_in(F.col("severity"), SEVERITIES)})
    return ranked.orderBy("kind_rank", "severity_rank", "station_id", "device_serial")


def samples(violations: DataFrame, n: int = 10) -> DataFrame:
    """The first n violations of each rule, by key and detail: a report's examples.

    Each task keeps its own first n before rows move (Spark's window group limit), so a rule's violations never meet.
    """
    w = Window.partitionBy("rule").orderBy("key", "detail")
    return violations.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def current_port_config(ports: DataFrame) -> DataFrame:
    """Six rows for each device with an open port, by port number; a port without an open configuration is `none`."""
    open_ = ports.filter("valid_to is null")
    # the newest; of equal times the last type, then sensor (none comes first), then depth
    by = F.struct("valid_from", "type", F.coalesce("sensor", F.lit("")).alias("_s"), "depth_cm", "sensor")
    newest = open_.filter(F.col("port").between(1, SLOTS)).groupBy("sn", "port").agg(F.max(by).alias("c"))
    slots = open_.select("sn").distinct().withColumn("port", F.explode(F.sequence(F.lit(1), F.lit(SLOTS))))
    out = slots.join(newest, ["sn", "port"], "left")
    none = lambda c: F.when(F.col("c").isNull(), "none").otherwise(F.col("c")[c]).alias(c)
    return out.select("sn", "port", none("type"), none("sensor"), F.col("c.depth_cm").alias("depth_cm"))
