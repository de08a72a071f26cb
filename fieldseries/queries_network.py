"""Registered queries: picks, lookups, lists and intervals over the network that network.py sees in the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import network as net
from .adapters import event_readings, instant, table
from .operators import diff, grid, lookups, monitor, quality, rules, topk
from .queries import ntz, query, r6
from .queries_rules import VIOLATIONS, _TERMINAL

_M = f"WITH {net.SQL}\n"
_DONE = f"(status IN {_TERMINAL})"


# --- picks --------------------------------------------------------------------------------------------


@query(_M + f"SELECT station_id, number FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY {_DONE}, deploy_datetime DESC NULLS LAST, number DESC) AS k FROM m) WHERE k = 1")
def current_station_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.current_station_row(net.deployments(spark, sf_dir), "number").select("station_id", "number")


@query(_M + f"""SELECT device_serial, asked, number FROM (SELECT m.*, w.asked, row_number() OVER (PARTITION BY m.device_serial, w.asked ORDER BY coalesce(m.station_id = w.asked, false) DESC, {_DONE}, number) AS k
FROM m JOIN (SELECT DISTINCT device_serial, CASE WHEN number % 3 = 0 THEN station_id END AS asked FROM m WHERE number % 2 = 0) w ON m.device_serial = w.device_serial) WHERE k = 1""")
def device_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = net.deployments(spark, sf_dir)
    wanted = d.filter("number % 2 = 0").select("device_serial", F.when(F.col("number") % 3 == 0, F.col("station_id")).alias("station_id"))
    return topk.device_row(d, wanted, "number").select("device_serial", "asked", "number")


@query(_M + "SELECT number, CAST(r AS INTEGER) AS role_rank, CAST(row_number() OVER (PARTITION BY station_id ORDER BY r, device_serial NULLS LAST, number) AS INTEGER) AS place FROM (SELECT *, CASE device_role WHEN 'primary' THEN 1 WHEN 'secondary' THEN 2 WHEN 'tertiary' THEN 3 ELSE 4 END AS r FROM m)")
def role_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.role_order(net.deployments(spark, sf_dir), "number").select("number", "role_rank", "place")


@query("SELECT event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.latest_run(table(spark, sf_dir, "events"), ["event_type"], ["ts", "event_id"]).select("event_type", "event_id")


@query(_M + "SELECT device_serial, filepath, end_date FROM (SELECT regexp_extract(filepath, 'raw/([0-9]+)_', 1) AS device_serial, filepath, strftime(strptime(regexp_extract(filepath, '_([0-9]{8})_raw', 1), '%Y%m%d'), '%Y-%m-%d') AS end_date, row_number() OVER (PARTITION BY regexp_extract(filepath, 'raw/([0-9]+)_', 1) ORDER BY regexp_extract(filepath, '_([0-9]{8})_raw', 1) DESC, filepath DESC) AS k FROM files WHERE filepath NOT LIKE '%extra%') WHERE k = 1")
def newest_file_per_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.newest_file_per_device(net.files(spark, sf_dir)).withColumn("end_date", F.col("end_date").cast("string"))


_EVERY = " UNION ALL ".join(f"SELECT '{n}' AS rule, CAST(v.key AS VARCHAR) AS key, CAST(v.detail AS VARCHAR) AS detail FROM ({q}) v(key, detail)" for n, q in VIOLATIONS.items())


@query(_M + f"SELECT rule, key, detail FROM (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY key NULLS FIRST, detail NULLS FIRST) AS k FROM ({_EVERY})) WHERE k <= 10")
def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.samples(rules.violations(net.network(spark, sf_dir))).select("rule", "key", "detail")


@query(_M + """, o AS (SELECT * FROM p WHERE valid_to IS NULL), c AS (SELECT sn, port, max({'a': valid_from, 'b': type, 'c': coalesce(sensor, ''), 'd': depth_cm}) AS c FROM o WHERE port BETWEEN 1 AND 6 GROUP BY 1, 2)
SELECT s.sn, CAST(s.port AS INTEGER) AS port, CASE WHEN c.c IS NULL THEN 'none' ELSE c.c.b END AS type, CASE WHEN c.c IS NULL THEN 'none' ELSE nullif(c.c.c, '') END AS sensor, c.c.d AS depth_cm FROM (SELECT sn, unnest(generate_series(1, 6)) AS port FROM (SELECT DISTINCT sn FROM o)) s LEFT JOIN c ON s.sn = c.sn AND s.port = c.port""")
def current_port_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.current_port_config(net.ports(spark, sf_dir))


# --- lookups ------------------------------------------------------------------------------------------------


@query(_M + "SELECT f.filepath, min(timestamp_utc) AS fetched_utc, count(DISTINCT f.n) AS copies FROM (SELECT filepath, row_number() OVER (PARTITION BY filepath) AS n FROM files WHERE filepath NOT LIKE '%extra%') f JOIN d ON f.filepath = d.filepath GROUP BY 1")
def fetch_time_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = net.files(spark, sf_dir).filter("filepath not like '%extra%'").groupBy("filepath").agg(F.count("*").alias("copies"))
    return lookups.fetch_time_lookup(f, net.downloads(spark, sf_dir)).select("filepath", ntz("fetched_utc"), "copies")


_COPIES = """ls AS (SELECT filepath, length(filepath) AS size, md5(CAST(event_id % 50 AS VARCHAR)) AS md5, event_id FROM d WHERE event_id % 13 <> 0),
one AS (SELECT filepath, min(size) AS size, min(md5) AS md5 FROM ls GROUP BY 1),
cp AS (SELECT replace(filepath, '_raw', '_20250101T000000_raw') AS filepath, CASE WHEN size % 2 = 0 THEN size ELSE size + 1 END AS size, md5, regexp_extract(filepath, '^(.*?_[0-9]{8}_[0-9]{8})', 1) AS stem FROM one WHERE size % 3 <> 0),
orp AS (SELECT cp.filepath, one.filepath AS twin, cp.size = one.size AND cp.md5 = one.md5 AS identical FROM cp LEFT JOIN one ON cp.stem = regexp_extract(one.filepath, '^(.*?_[0-9]{8}_[0-9]{8})', 1) UNION ALL SELECT 'raw/odd_' || size || md5, NULL, NULL FROM (SELECT DISTINCT size, md5 FROM one))"""


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = net.downloads(spark, sf_dir).filter("event_id % 13 <> 0").selectExpr("filepath", "length(filepath) as size", "md5(cast(event_id % 50 as string)) as md5")
    one = d.groupBy("filepath").agg(F.min("size").alias("size"), F.min("md5").alias("md5"))
    copies = one.filter("size % 3 <> 0").selectExpr("replace(filepath, '_raw', '_20250101T000000_raw') as filepath", "if(size % 2 = 0, size, size + 1) as size", "md5")
    odd = one.select("size", "md5").distinct().selectExpr("'raw/odd_' || size || md5 as filepath", "size", "md5")
    return lookups.orphan_files(one.unionByName(copies).unionByName(odd), net.downloads(spark, sf_dir))


@query(_M + f", {_COPIES} SELECT filepath, twin, identical FROM orp")
def orphan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orphans(spark, sf_dir)


@query(_M + f", {_COPIES} SELECT filepath, coalesce(identical, false) AS removable FROM orp")
def removable_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    go, stay = lookups.removable_orphans(_orphans(spark, sf_dir))
    return go.select("filepath", F.lit(True).alias("removable")).unionByName(stay.select("filepath", F.lit(False).alias("removable")))


@query(_M + "SELECT number, CAST(coalesce(CASE WHEN station_id <> '' AND CAST(substr(station_id, 3) AS INTEGER) % 4 = 0 THEN DATE '1996-01-01' + CAST(substr(station_id, 3) AS INTEGER) END, DATE '1995-06-01') AS VARCHAR) AS confirmed_from FROM m")
def lookup_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = net.deployments(spark, sf_dir)
    known = d.filter("station_id <> ''").select("station_id").distinct().filter("cast(substr(station_id, 3) as int) % 4 = 0").selectExpr("station_id", "date_add(date '1996-01-01', cast(substr(station_id, 3) as int)) as confirmed_from")
    usual = d.groupBy().agg(F.lit("(default)").alias("station_id"), F.lit("1995-06-01").cast("date").alias("confirmed_from"))
    return lookups.lookup_with_default(d, known.unionByName(usual), "station_id", "confirmed_from", "2026-09-01").select("number", F.col("confirmed_from").cast("string").alias("confirmed_from"))


@query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS device_serial, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 + 1 AS INTEGER) AS port, event_type AS variable, date_trunc('hour', ts) AS datetime FROM events")
def distinct_unattributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumns({"variable": F.col("series"), "datetime": F.date_trunc("hour", "datetime")})
    return lookups.distinct_unattributed(r).select("device_serial", "port", "variable", ntz("datetime"))


@query(_M + """, n AS (SELECT device_serial, device_name, min(deploy_datetime) AS a, max(deploy_datetime) AS b FROM m WHERE device_name IS NOT NULL GROUP BY 1, 2)
SELECT device_serial, arg_min(device_name, (a, device_name)) AS first_name, arg_max(device_name, (b, device_name)) AS last_name, string_agg(device_name, ', ' ORDER BY a, device_name) AS names FROM n GROUP BY 1""")
def first_last_by_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.first_last_by_device(net.deployments(spark, sf_dir))


@query(_M + "SELECT 'status' AS field, status AS value, count(*) AS rows FROM m GROUP BY ALL UNION ALL SELECT 'device_role', device_role, count(*) FROM m WHERE device_role IS NOT NULL GROUP BY ALL UNION ALL SELECT 'elev_source', elev_source, count(*) FROM m WHERE trim(elev_source) <> '' GROUP BY ALL")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.distinct_values(net.deployments(spark, sf_dir), ["status", "device_role", "elev_source"])


@query(_M + f""", r AS (SELECT station_id, area, number, CASE WHEN device_name IS NOT NULL THEN '"' || device_name || '"' ELSE device_serial END AS n FROM m WHERE NOT {_DONE}), o AS (SELECT station_id, n, min(number) AS t, arg_min(area, number) AS area FROM r GROUP BY 1, 2)
SELECT station_id, concat_ws(', ', arg_min(area, t), nullif(string_agg(n, ' / ' ORDER BY t, n), '')) AS label FROM o GROUP BY 1""")
def station_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.station_list(net.deployments(spark, sf_dir), tie="number")


@query(_M + "SELECT number, station_id FROM (SELECT * FROM m WHERE status = 'online' AND CAST(deploy_datetime - INTERVAL 4 HOUR AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-09-30' ORDER BY deploy_datetime DESC, number DESC LIMIT 20)")
def filtered_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = lookups.filtered_view(net.deployments(spark, sf_dir), {"status": "Online"}, "deploy_datetime", "1996-03-01", "1997-09-30", 20, ["deploy_datetime", "number"])
    return v.select("number", "station_id")


@query(_M + "SELECT c_custkey, CAST(c_custkey AS VARCHAR) IN (SELECT device_serial FROM m WHERE device_serial IS NOT NULL) AS exists, (SELECT count(*) FROM (SELECT sn, port FROM p GROUP BY 1, 2 HAVING count(*) > 1) x WHERE x.sn = CAST(c_custkey AS VARCHAR)) AS repeated_ports FROM customer")
def exists_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("device_serial"))
    found = lookups.unknown_keys(asked, net.deployments(spark, sf_dir), "device_serial")
    doubled = lookups.duplicate_ports(net.ports(spark, sf_dir)).groupBy(F.col("sn").alias("device_serial")).agg(F.count("*").alias("k"))
    return found.join(doubled, "device_serial", "left").select("c_custkey", "exists", F.coalesce("k", F.lit(0)).cast("bigint").alias("repeated_ports"))


@query("""SELECT min(event_id) AS event_id FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 AS port FROM events) WHERE ts >= TIMESTAMP '2024-01-05 04:00:00' AND ts < TIMESTAMP '2024-01-16 04:00:00' AND event_type IN ('click', 'view') GROUP BY user_id, port, event_type, ts""")
def time_range_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.time_range_local(event_readings(spark, sf_dir), "2024-01-05", "2024-01-15", "row_seq", ["click", "view"]).select(F.col("row_seq").alias("event_id"))


@query(_M + "SELECT DISTINCT sn, sensor, sn NOT LIKE 'z%' AS by_hand, CASE WHEN sensor IS NULL OR sensor = 'none' THEN 'none' ELSE 'vwc' END AS kind FROM p")
def device_kind_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return net.ports(spark, sf_dir).select("sn", "sensor", lookups.is_logger(none, F.col("sn")).alias("by_hand"), lookups.sensor_type(F.col("sensor")).alias("kind")).distinct()


@query(_M + f"SELECT device_serial FROM m GROUP BY 1 HAVING bool_and({_DONE})")
def group_all_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.all_terminal(net.deployments(spark, sf_dir))


@query(_M + """, a AS (SELECT DISTINCT station_id FROM m WHERE number % 2 = 0), b AS (SELECT DISTINCT station_id FROM mt) SELECT station_id FROM a INTERSECT SELECT station_id FROM b""")
def intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = net.network(spark, sf_dir)
    return n.deployments.filter("number % 2 = 0").select("station_id").intersect(n.maintenance.select("station_id"))


@query(_M + "SELECT DISTINCT filepath FROM files WHERE filepath NOT IN (SELECT filepath FROM d)")
def difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return net.files(spark, sf_dir).select("filepath").subtract(net.downloads(spark, sf_dir).select("filepath"))


# --- intervals --------------------------------------------------------------------------------------------------

_GAPS = """t AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS ts FROM events), gp AS (SELECT *, epoch(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM t),
cnt AS (SELECT user_id, gap, count(*) AS n FROM gp WHERE gap IS NOT NULL GROUP BY 1, 2), ob AS (SELECT t.user_id, CASE WHEN count(*) >= 3 THEN (SELECT arg_min(gap, (-n, gap)) FROM cnt WHERE cnt.user_id = t.user_id) END AS native FROM t GROUP BY 1)"""


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_readings(spark, sf_dir).withColumn("datetime", F.date_trunc("hour", "datetime"))


@query(_M + f", {_GAPS}, de AS (SELECT device_serial, CASE WHEN count(DISTINCT interval_min) = 1 THEN CAST(min(interval_min) AS DOUBLE) END AS declared FROM m WHERE number % 3 <> 1 GROUP BY 1) SELECT CAST(user_id AS VARCHAR) AS device_serial, declared, round(native / 60, 3) AS observed, abs(declared - round(native / 60, 3)) <= 0.001 AS agree FROM ob LEFT JOIN de ON CAST(user_id AS VARCHAR) = device_serial")
def logging_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _hourly(spark, sf_dir)
    return lookups.logging_interval(r, net.deployments(spark, sf_dir).filter("number % 3 <> 1"), grid.observed_interval(r, ["device_serial"]))


@query(f"WITH {_GAPS} SELECT user_id % 7 AS g, string_agg(user_id || ' ' || coalesce(CAST(CAST(native / 60 AS BIGINT) AS VARCHAR), '?') || ' min', ', ' ORDER BY user_id || ' ' || coalesce(CAST(CAST(native / 60 AS BIGINT) AS VARCHAR), '?') || ' min') AS summary FROM ob GROUP BY 1")
def interval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = grid.observed_interval(_hourly(spark, sf_dir), ["device_serial"])
    return lookups.interval_summary(o.withColumn("g", F.col("device_serial").cast("bigint") % 7), "g")


@query("SELECT CAST(user_id AS VARCHAR) AS device_serial, round(quantile_cont(gap, 0.5), 6) AS median_min FROM (SELECT user_id, epoch_us(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) / 6e7 AS gap FROM events) WHERE gap > 0 GROUP BY 1")
def median_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.median_interval(event_readings(spark, sf_dir), ["device_serial"]).select("device_serial", r6("median_min"))


@query("""WITH f AS (SELECT event_id AS filepath, event_id % 7 AS o, event_id % 5 AS dc, ts AS e, ts + event_id % 6 * INTERVAL 1 DAY AS v FROM events)
SELECT CAST(filepath AS VARCHAR) AS filepath, 'interval differs' AS problem FROM f WHERE abs(o - dc) > 0.5 UNION ALL SELECT CAST(filepath AS VARCHAR), 'ends before the visit' FROM f WHERE v - e > INTERVAL 2 DAY""")
def ingest_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("filepath"), (F.col("event_id") % 7).alias("observed_min"), (F.col("event_id") % 5).alias("declared_min"), instant("ts").alias("end"), (instant("ts") + F.make_dt_interval(days=(F.col("event_id") % 6).cast("int"))).alias("visit"))
    return lookups.ingest_checks(e)


@query("""SELECT 't' || user_id AS name, CASE WHEN user_id % 5 = 0 THEN 'gone' WHEN user_id % 7 = 0 THEN 'added' ELSE 'changed' END AS state FROM (SELECT DISTINCT user_id FROM events) WHERE (user_id % 5 = 0) <> (user_id % 7 = 0) OR (user_id % 5 <> 0 AND user_id % 7 <> 0 AND user_id IN (SELECT user_id FROM events WHERE event_id % 11 = 0 AND user_id % 3 = 0))""")
def table_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("name", F.concat(F.lit("t"), "user_id"))
    now = diff.content_fingerprint(e.filter("user_id % 5 <> 0").withColumn("value", F.when((F.col("event_id") % 11 == 0) & (F.col("user_id") % 3 == 0), F.col("value") + 1).otherwise(F.col("value"))), ["name"], ["event_id", "value"])
    saved = diff.content_fingerprint(e.filter("user_id % 7 <> 0"), ["name"], ["event_id", "value"])
    return lookups.table_drift(now, saved)
