"""Readings without a station: why, and in which episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import attribution
from .sequences import with_neighbour, with_running_sum

#: Seconds before and after a deployment's start that count as its installation, and between episodes.
BEFORE, AFTER, EPISODE_GAP = 7 * 86400, 86400, 7 * 86400


def compact_runs(numbers: Column) -> Column:
    """Distinct whole numbers as "1-4, 6, 8"."""
    n = F.array_sort(F.array_distinct(F.filter(numbers, lambda x: x.isNotNull())))
    start = F.filter(n, lambda x: ~F.array_contains(n, x - 1))
    end = F.filter(n, lambda x: ~F.array_contains(n, x + 1))
    text = F.zip_with(start, end, lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat(a.cast("string"), F.lit("-"), b.cast("string"))))
    return F.array_join(text, ", ")


def classify_unattributed(readings: DataFrame, windows: DataFrame, known: DataFrame) -> DataFrame:
    """readings with category (known, installation or unexplained) and the reason of a known period.

    known: rank, device_serial, port (null: any), from, to (null: open), reason; the first by rank wins and goes
    before an installation, which lies from 7 days before to 24 hours after a start, bounds included.
    """
    t = F.col("datetime")
    periods = known.withColumns({"starts": F.coalesce("from", F.timestamp_micros(F.lit(-(1 << 60)))), "ends": F.col("to")})
    second = lambda n: F.timestamp_micros(F.unix_micros("starts") + F.lit(n * 1_000_000))
    around = windows.filter("starts is not null").select("device_serial", second(-BEFORE).alias("_from"), F.timestamp_micros(F.unix_micros(second(AFTER)) + 1).alias("ends")).withColumnRenamed("_from", "starts")  # bounds included
    # both are dealt to slices of time, so a device's arrays are as long as a slice has periods and starts
    slices = lambda w: attribution.sliced(w, readings, "datetime")
    ks = attribution.gather(slices(periods), ["device_serial"], ["rank", "port", "starts", "ends", "reason"], [], "_ks")
    ss = attribution.gather(slices(around), ["device_serial"], ["starts", "ends"], [], "_ss")
    j = readings.withColumn("_slice", attribution.slice_of(t)).join(ks.join(ss, ["device_serial", "_slice"], "full"), ["device_serial", "_slice"], "left")
    hit = F.filter("_ks", lambda k: (k["port"].isNull() | (k["port"] == F.col("port"))) & attribution.covers(k, t))
    is_known = F.col("_ks").isNotNull() & (F.size(hit) > 0)
    near = F.exists("_ss", lambda s: attribution.covers(s, t))
    out = j.withColumn("category", F.when(is_known, "known").when(F.coalesce(near, F.lit(False)), "installation").otherwise("unexplained"))
    return out.withColumn("reason", F.when(is_known, F.try_element_at(hit, F.lit(1))["reason"])).drop("_ks", "_ss", "_slice")


def sessionize(readings: DataFrame, keys: list[str], gap_seconds: int = EPISODE_GAP, when: str = "datetime") -> DataFrame:
    """readings with `episode`, numbered from 1 by keys; a new one begins after a silence longer than the gap."""
    at = F.unix_micros(when)
    paired = with_neighbour(readings, keys, at, [], "_b", ahead=False)
    new = F.coalesce(at - F.col("_b.at") > gap_seconds * 1_000_000, F.lit(False))
    numbered = with_running_sum(paired.withColumn("_new", new), keys, at, F.col("_new").cast("int"), "_n")
    return numbered.withColumn("episode", F.col("_n") + 1).drop("_b", "_new", "_n")


def unattributed_episodes(classified: DataFrame, gap_seconds: int = EPISODE_GAP) -> DataFrame:
    """One row a category, device and episode: ports, first, last, distinct moments, variables in order."""
    s = sessionize(classified, ["category", "device_serial"], gap_seconds)
    return s.groupBy("category", "device_serial", "episode").agg(
        compact_runs(F.collect_set("port")).alias("ports"),
        F.min("datetime").alias("first"),
        F.max("datetime").alias("last"),
        F.count_distinct("datetime").alias("moments"),
        F.array_join(F.array_sort(F.collect_set("variable")), ", ").alias("variables"),
    )
