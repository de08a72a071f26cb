"""Registered queries of the small operators: predicates, windows of ports, text forms, raw shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import network as net
from .adapters import event_readings, instant, table
from .functions import parsing, texts, units
from .operators import quality, survey, unattributed, windows
from .queries import ntz, query
from .queries_rules import _TERMINAL
from .sources import scratch, tables
from .streaming import landing

_M = f"WITH {net.SQL}\n"


@query(_M + f"SELECT number FROM m WHERE status NOT IN {_TERMINAL}")
def active_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.active_rows(net.deployments(spark, sf_dir).withColumn("status", F.initcap("status"))).select("number")


@query(_M + f"SELECT number FROM m WHERE status IN {_TERMINAL}")
def terminal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.terminal_rows(net.deployments(spark, sf_dir)).select("number")


@query(_M + "SELECT sn, port, sensor, count(*) AS n FROM p WHERE valid_to IS NULL AND sensor <> 'none' AND type = 'vwc' GROUP BY ALL")
def active_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.active_ports(net.ports(spark, sf_dir), "VWC").groupBy("sn", "port", "sensor").agg(F.count("*").alias("n"))


@query(_M + "SELECT sn AS device_serial, port, type, sensor, depth_cm, valid_from AS starts, valid_to AS ends FROM p WHERE sensor <> 'none'")
def port_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.port_windows(net.ports(spark, sf_dir))
    return w.select("device_serial", "port", "type", "sensor", "depth_cm", ntz("starts"), ntz("ends"))


@query(_M + f"SELECT number FROM (SELECT *, CASE WHEN status IN {_TERMINAL} THEN least(lead(deploy_datetime) OVER (PARTITION BY device_serial ORDER BY deploy_datetime, unique_id), CAST(last_visit AS TIMESTAMP) + INTERVAL 86399 SECOND + INTERVAL 4 HOUR) END AS e FROM m WHERE device_serial IS NOT NULL) WHERE last_record < deploy_datetime OR last_record > e")
def record_outside_deployment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.outside_deployment(net.deployments(spark, sf_dir)).select("number")


_SPELLED = "CASE p_size % 6 WHEN 0 THEN 'Â°C' WHEN 1 THEN '°F' WHEN 2 THEN ' kPa ' WHEN 3 THEN 'ft' WHEN 4 THEN 'mbar' ELSE 'odd' END"


@query(f"SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'degC' WHEN 1 THEN 'degF' WHEN 2 THEN 'kPa' WHEN 3 THEN 'ft' WHEN 4 THEN 'hPa' ELSE 'odd' END AS unit FROM (SELECT *, {_SPELLED} AS u FROM part)")
def normalize_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", units.normalize_unit(F.expr(_SPELLED)).alias("unit"))


@query("SELECT p_partkey, round(p_retailprice * CASE p_size % 7 WHEN 0 THEN 1 WHEN 1 THEN 0.01 WHEN 2 THEN 0.001 WHEN 3 THEN 0.3048 WHEN 4 THEN 0.0254 WHEN 5 THEN 0.9144 END, 6) AS metres FROM part")
def to_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(*[F.lit(u) for u in ("m", "cm", "mm", "ft", "in", "yd", "ell")]), F.col("p_size") % 7 + 1)
    return table(spark, sf_dir, "part").select("p_partkey", F.round(units.to_meters(F.col("p_retailprice"), unit), 6).alias("metres"))


_DATES = "CASE o_orderkey % 4 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) WHEN 1 THEN month(o_orderdate) || '/' || day(o_orderdate) || '/' || year(o_orderdate) WHEN 2 THEN 'soon' END"


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders")
def parse_date_flexible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", parsing.parse_date_flexible(F.expr(_DATES)).cast("string").alias("day"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN TIMESTAMP '1899-12-30' + CAST(30000 + o_custkey % 9000 AS INTEGER) * INTERVAL 1 DAY + INTERVAL 4 HOUR WHEN 1 THEN date_trunc('day', o_orderdate) + INTERVAL 4 HOUR WHEN 2 THEN date_trunc('day', o_orderdate) + INTERVAL 14 HOUR WHEN 3 THEN NULL ELSE date_trunc('day', o_orderdate) + INTERVAL 14 HOUR END AS at FROM orders""")
def coerce_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spreadsheet day numbers, bare dates, two-digit years, implausible years and full times."""
    text = F.expr("CASE o_orderkey % 5 WHEN 0 THEN cast(30000 + o_custkey % 9000 as string) WHEN 1 THEN cast(cast(o_orderdate as date) as string) WHEN 2 THEN date_format(o_orderdate, 'M/d/yy') || ' 10:00' WHEN 3 THEN '1812-01-01 00:00' ELSE date_format(o_orderdate, 'yyyy-MM-dd') || ' 10:00:00' END")
    return table(spark, sf_dir, "orders").select("o_orderkey", parsing.coerce_datetime(text).cast("timestamp_ntz").alias("at"))


@query("SELECT event_id, strftime(ts - INTERVAL 4 HOUR, '%Y-%m-%d %H:%M:%S') AS local FROM events")
def format_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", parsing.format_datetime(instant("ts")).alias("local"))


@query("SELECT event_id, CASE WHEN event_id % 7 <> 0 AND event_id % 5 <> 0 THEN user_id || '_' || strftime(ts - INTERVAL 4 HOUR, '%Y%m%d') || '_' || strftime(ts + INTERVAL 30 DAY - INTERVAL 4 HOUR, '%Y%m%d') || '_raw.csv' END AS name FROM events")
def build_raw_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    end = instant("ts") + F.when(k % 5 == 0, F.expr("interval -1 day")).otherwise(F.expr("interval 30 day"))
    return table(spark, sf_dir, "events").select("event_id", parsing.build_raw_filename(instant("ts"), end, F.when(k % 7 != 0, F.col("user_id").cast("string"))).alias("name"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 4 > 0 THEN round(abs(o_totalprice - 150000) / (o_custkey % 4), 6) END AS slope FROM orders")
def compute_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(survey.slope(F.col("o_totalprice") - 150000, F.col("o_custkey") % 4), 6).alias("slope"))


@query("SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN CASE WHEN p_size % 3 = 0 THEN 'other' WHEN p_size % 2 = 0 THEN 'usgs_3dep' ELSE 'usgs_3dep_' || p_size % 4 || 'm' END END AS label FROM part")
def elevation_source_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_size")
    return table(spark, sf_dir, "part").select("p_partkey", texts.elevation_source_label(k % 5 != 0, F.when(k % 3 == 0, "other"), F.when(k % 2 != 0, k % 4)).alias("label"))


@query("""WITH d AS (SELECT DISTINCT o_custkey AS k, CAST(o_orderkey % 13 AS INTEGER) AS p FROM orders), g AS (SELECT *, p - row_number() OVER (PARTITION BY k ORDER BY p) AS i FROM d), r AS (SELECT k, i, min(p) AS a, max(p) AS b FROM g GROUP BY 1, 2)
SELECT k, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ', ' ORDER BY a) AS ports FROM r GROUP BY 1""")
def compact_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_set((F.col("o_orderkey") % 13).cast("int")).alias("ps"))
    return o.select("k", unattributed.compact_runs(F.col("ps")).alias("ports"))


_WIDE = "SELECT 'Abs Pres' AS measurement, 'kPa' AS unit, '7' AS serial, round(value, 6) AS value, ts AS t, event_id FROM events UNION ALL SELECT 'Temp', '°C', '7', CASE WHEN event_id % 9 <> 0 THEN CAST(event_id % 40 AS DOUBLE) END, ts, event_id FROM events"


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select(k.alias("#"), F.date_format(instant("ts") - F.expr("interval 4 hours"), "MM/dd/yy hh:mm:ss a").alias("Date Time, GMT-04:00"), F.round("value", 6).alias("Abs Pres, kPa (LGR S/N: 7, LBL: x)"), F.when(k % 9 == 0, "off").otherwise((k % 40).cast("string")).alias("Temp, °C (LGR S/N: 7, LBL: y)"), F.lit("no").alias("Host, state (LGR S/N: 7)"), k.alias("event_id"))


@query(f"SELECT event_id, measurement, unit, serial, value FROM ({_WIDE})")
def unpivot_header_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.unpivot_header_coded(_wide(spark, sf_dir), ["event_id"], "Date Time, GMT-04:00").select("event_id", "measurement", "unit", "serial", "value")


@query(f"SELECT '7' AS device_serial, date_trunc('second', t) AS datetime, measurement, unit, value FROM ({_WIDE}) UNION ALL SELECT 'z6-' || user_id, ts, event_type, 'u', value FROM events UNION ALL SELECT 'x' || user_id, ts, event_type, 'u', value FROM events UNION ALL SELECT '9', date_trunc('second', ts), 'water_pressure_kpa', NULL, value FROM events UNION ALL SELECT '9', date_trunc('second', ts), 'temp_c', NULL, CASE WHEN event_id % 5 <> 0 THEN value / 2 END FROM events")
def read_readings_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four raw shapes, each known by its columns, in one long form."""
    t = table(spark, sf_dir, "events")
    e = t.select(F.concat(F.lit("z6-"), "user_id").alias("device_id"), instant("ts").alias("datetime"), F.lit(1).alias("port_num"), F.lit("s").alias("sensor_name"), F.col("event_type").alias("measurement"), F.lit("u").alias("unit"), "value", F.lit(0).alias("error_code"))
    export = t.select(F.concat(F.lit("x"), "user_id").alias("device_sn"), instant("ts").alias("timestamp_utc"), F.lit(2).alias("port"), F.lit("s").alias("sensor"), F.col("event_type").alias("measurement"), F.lit("u").alias("unit"), "value")
    local = F.date_format(instant("ts") - F.expr("interval 4 hours"), "yyyy-MM-dd HH:mm:ss")
    link = t.select(local.alias("datetime"), F.col("value").alias("water_pressure_kpa"), F.when(F.col("event_id") % 5 != 0, F.col("value") / 2).alias("temp_c"))
    read = tables.read_readings_long
    long = tables.union_readings([read(_wide(spark, sf_dir).drop("event_id"), "a.csv"), read(e, "b.csv"), read(export, "c.csv"), read(link, "d.csv", device_serial="9")])
    return long.select("device_serial", ntz("datetime"), "measurement", "unit", "value")


@query("SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS notes FROM customer")
def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit(None).cast("string").alias("notes"))
    return tables.append_by_name(target, table(spark, sf_dir, "customer").select("c_name", "c_custkey"))


@query("SELECT CAST(user_id AS VARCHAR) AS device_serial, 'f' || event_id % 3 AS source_file, min(ts) AS start_date, max(ts) AS end_date, count(*) AS n_records FROM events GROUP BY ALL")
def land_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log rows of a landed batch; landing it again changes nothing."""
    root = scratch.shared_folder(spark, "landed")
    r = event_readings(spark, sf_dir).select("device_serial", "datetime", "value", "source_file", "row_seq")
    for _ in range(2):
        landing.land_batch(r, 1, f"{root}/readings", f"{root}/log", f"{root}/dirty", "run")
    return spark.read.parquet(f"{root}/log").select("device_serial", "source_file", ntz("start_date"), ntz("end_date"), "n_records")
