"""Lookups between files, logs and rows; lists and views of a network's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import PROJECT_ZONE
from .windows import active_rows, is_terminal

DEFAULT = "(default)"
#: Day and device at the front of a raw file's name: what two copies of one offload share.
STEM = r"^(.*?_[0-9]{8}_[0-9]{8})"


def fetch_time_lookup(files: DataFrame, log: DataFrame) -> DataFrame:
    """files with fetched_utc, the first time that the log has for each; a file that the log lacks is an error, named."""
    times = log.groupBy("filepath").agg(F.min("timestamp_utc").alias("_at"))
    missing = F.raise_error(F.concat(F.lit("no log row for "), F.col("filepath"))).cast("timestamp")
    return files.join(times, "filepath", "left").withColumn("fetched_utc", F.coalesce("_at", missing)).drop("_at")


def orphan_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """Listed files without a log row: filepath, twin (a logged file of the same device and days), identical.

    files: filepath, size, md5.  Contents are compared by size and digest; without a twin both are null.
    """
    named = log.select("filepath").distinct()
    stem = F.regexp_extract("filepath", STEM, 1).alias("stem")
    orphans = files.join(named, "filepath", "left_anti").select("filepath", "size", "md5", stem)
    logged = files.join(named, "filepath", "left_semi").select(stem, F.struct("filepath", "size", "md5").alias("t")).groupBy("stem").agg(F.min("t").alias("t"))
    same = (F.col("size") == F.col("t.size")) & (F.col("md5") == F.col("t.md5"))
    return orphans.join(logged.filter("stem <> ''"), "stem", "left").select("filepath", F.col("t.filepath").alias("twin"), same.alias("identical"))


def removable_orphans(orphans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(orphans proven identical to a logged file, the others)."""
    proven = F.coalesce("identical", F.lit(False))
    return orphans.filter(proven), orphans.filter(~proven)


def lookup_with_default(rows: DataFrame, table: DataFrame, key: str, value: str, constant: str) -> DataFrame:
    """rows with the value of their key, else that of the row DEFAULT, else a constant (a date as text)."""
    own = table.filter(F.col(key) != DEFAULT).groupBy(key).agg(F.min(value).alias("_own"))
    usual = table.groupBy().agg(F.min(F.when(F.col(key) == DEFAULT, F.col(value))).alias("_usual")).withColumn("_k", F.lit(1))
    out = rows.join(own, key, "left").withColumn("_k", F.lit(1)).join(F.broadcast(usual), "_k", "left")  # a single row
    return out.withColumn(value, F.coalesce("_own", "_usual", F.lit(constant).cast("date"))).drop("_own", "_usual", "_k")


def distinct_unattributed(unattributed: DataFrame) -> DataFrame:
    return unattributed.select("device_serial", "port", "variable", "datetime").distinct()


def first_last_by_device(deployments: DataFrame) -> DataFrame:
    """device_serial, first_name and last_name by start, and all its names in the order they were first used."""
    named = deployments.filter("device_name is not null and deploy_datetime is not null")
    first = named.groupBy("device_serial", "device_name").agg(F.min("deploy_datetime").alias("at"), F.max("deploy_datetime").alias("until"))
    return first.groupBy("device_serial").agg(
        F.min_by("device_name", F.struct("at", "device_name")).alias("first_name"),
        F.max_by("device_name", F.struct("until", "device_name")).alias("last_name"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "device_name"))), lambda x: x["device_name"]), ", ").alias("names"),
    )


def distinct_values(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, value, rows) of the values that are no null and not blank."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in fields])).alias("f")).select("f.*")
    return long.filter("trim(value) <> ''").groupBy("field", "value").agg(F.count("*").alias("rows"))


def station_list(deployments: DataFrame, include_retired: bool = False, tie: str = "unique_id") -> DataFrame:
    """(station_id, label): the area and the devices there, names in quotes, or serials where there is no name.

    Only live rows count unless retired ones are asked for; a station has the area of its first row.
    """
    d = deployments if include_retired else active_rows(deployments)
    name = F.when(F.trim(F.coalesce("device_name", F.lit(""))) != "", F.concat(F.lit('"'), F.trim("device_name"), F.lit('"'))).otherwise(F.col("device_serial"))
    rows = d.select("station_id", "area", F.col(tie).alias("_t"), name.alias("_name"))
    once = rows.groupBy("station_id", "_name").agg(F.min("_t").alias("_t"), F.min_by("area", "_t").alias("area"))
    names = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_name").isNotNull(), F.struct("_t", "_name")))), lambda x: x["_name"]), " / ")
    out = once.groupBy("station_id").agg(names.alias("names"), F.min_by("area", "_t").alias("area"))
    return out.select("station_id", F.concat_ws(", ", F.nullif(F.trim("area"), F.lit("")), F.nullif(F.col("names"), F.lit(""))).alias("label"))


def filtered_view(df: DataFrame, equal: dict[str, str] | None = None, day: str | None = None, first: str | None = None, last: str | None = None, newest: int | None = None, order: list[str] | None = None, zone: str = PROJECT_ZONE) -> DataFrame:
    """Rows with the given values (case does not matter), on local days from first to last, both included; of these
    the newest few by order, if asked for."""
    out = df
    for c, v in (equal or {}).items():
        out = out.filter(F.lower(F.col(c).cast("string")) == v.lower())
    if day:
        local = F.from_utc_timestamp(day, zone).cast("date")
        out = out.filter(local >= F.lit(first).cast("date")) if first else out
        out = out.filter(local <= F.lit(last).cast("date")) if last else out
    return out.orderBy(*[F.col(c).desc() for c in order or []]).limit(newest) if newest is not None else out


def unknown_keys(asked: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """asked with `exists`: whether its key is in the known table."""
    k = known.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_is", F.lit(True))
    return asked.join(k, key, "left").withColumn("exists", F.coalesce("_is", F.lit(False))).drop("_is")


def duplicate_ports(configs: DataFrame) -> DataFrame:
    """(sn, port, n) that one configuration names more than once."""
    return configs.groupBy("sn", "port").agg(F.count("*").alias("n")).filter("n > 1")


def time_range_local(readings: DataFrame, first: str, last: str, order: str, variables: list[str] | None = None, zone: str = PROJECT_ZONE) -> DataFrame:
    """Readings from the local day `first` to the end of `last`; of each port, measure and time the first copy."""
    at = lambda d, more: F.to_utc_timestamp(F.date_add(F.lit(d).cast("date"), more).cast("timestamp"), zone)
    r = readings.filter((F.col("datetime") >= at(first, 0)) & (F.col("datetime") < at(last, 1)))
    r = r.filter(F.col("series").isin(variables)) if variables else r
    w = Window.partitionBy("device_serial", "port", "series", "datetime").orderBy(order)
    return r.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def is_logger(maker: Column, serial: Column) -> Column:
    """Whether a device is read out by hand: by its maker, else by a serial that is no cloud one."""
    return F.when(maker.isNotNull(), F.lower(F.trim(maker)).isin("onset", "hobo")).otherwise(~F.lower(serial).startswith("z"))


def sensor_type(sensor: Column) -> Column:
    """Type of the station that a sensor belongs to; unknown sensors count as soil moisture."""
    s = F.lower(F.coalesce(sensor, F.lit("none")))
    return F.when(s == "none", "none").when(s.contains("teros"), "vwc").when(s.contains("atmos"), "weather").otherwise("vwc")


def logging_interval(readings: DataFrame, deployments: DataFrame, observed: DataFrame) -> DataFrame:
    """(device_serial, declared, observed, agree) in minutes; declared only where all rows of a device say the same.

    observed: device_serial, native (seconds).  They agree within 0.001 minutes; null where one is unknown.
    """
    declared = deployments.filter("device_serial is not null").groupBy("device_serial").agg(F.when(F.count_distinct("interval_min") == 1, F.min("interval_min").cast("double")).alias("declared"))
    devices = readings.select("device_serial").distinct()
    seen = observed.select("device_serial", F.round(F.col("native") / 60, 3).alias("observed"))
    out = devices.join(declared, "device_serial", "left").join(seen, "device_serial", "left")
    return out.withColumn("agree", F.abs(F.col("declared") - F.col("observed")) <= 0.001)


def interval_summary(intervals: DataFrame, group: str) -> DataFrame:
    """(group, summary): `device N min` for each device of a group, `?` where its interval is unknown."""
    minutes = F.coalesce(F.regexp_replace(F.round(F.col("native") / 60, 3).cast("string"), r"\.0$", ""), F.lit("?"))
    text = F.concat_ws(" ", F.col("device_serial"), minutes, F.lit("min"))
    return intervals.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(text)), ", ").alias("summary"))


def median_interval(readings: DataFrame, keys: list[str], when: str = "datetime") -> DataFrame:
    """(keys, median_min): the exact median of the gaps over zero between neighbouring times."""
    before = F.lag(when).over(Window.partitionBy(*keys).orderBy(when))
    gap = (F.unix_micros(when) - F.unix_micros(before)) / 6e7
    return readings.filter(F.col(when).isNotNull()).withColumn("_g", gap).filter("_g > 0").groupBy(*keys).agg(F.percentile("_g", 0.5).alias("median_min"))


def ingest_checks(files: DataFrame) -> DataFrame:
    """(filepath, problem) of files (filepath, observed_min, declared_min, end, visit) that need a look.

    An interval that differs from the declared one by over half a minute; a record that ends over two days before the
    visit that fetched it.
    """
    odd = F.abs(F.col("observed_min") - F.col("declared_min")) > 0.5
    short = F.unix_micros(F.col("visit").cast("timestamp")) - F.unix_micros("end") > 2 * 86_400_000_000
    found = F.array_compact(F.array(F.when(odd, F.lit("interval differs")), F.when(short, F.lit("ends before the visit"))))
    return files.select("filepath", F.explode(found).alias("problem"))


def table_drift(now: DataFrame, saved: DataFrame) -> DataFrame:
    """(name, state) of tables (name, fingerprint) that differ from a savepoint: changed, added or gone."""
    j = now.select("name", F.col("fingerprint").alias("_n")).join(saved.select("name", F.col("fingerprint").alias("_s")), "name", "full")
    state = F.when(F.col("_s").isNull(), "added").when(F.col("_n").isNull(), "gone").when(F.col("_n") != F.col("_s"), "changed")
    return j.select("name", state.alias("state")).filter("state is not null")


def live_flag(status: Column) -> Column:
    return ~is_terminal(status)
