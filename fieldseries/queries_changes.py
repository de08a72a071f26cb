"""Registered queries: findings, rosters, and bulk changes of a network's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import network as net
from .adapters import event_readings, table
from .operators import changes, findings, monitor
from .queries import ntz, query
from .queries_rules import _TERMINAL

_M = f"WITH {net.SQL}\n"
_LIVE = f"(status NOT IN {_TERMINAL})"
NOW = "1998-09-01"
_AT = f"TIMESTAMP '{NOW}'"
_DEV = "dv AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN 'z6-' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS device_serial, max(o_orderdate) AS last_measurement FROM orders GROUP BY 1 UNION ALL SELECT 'new-' || c_custkey, TIMESTAMP '1998-08-31' FROM customer WHERE c_custkey % 20 = 0)"
# the newest file of a user's events, and the most frequent gap in it
_OBS = """nf AS (SELECT user_id, arg_max(event_id % 3, (ts, 'f' || event_id % 3)) AS f FROM events GROUP BY 1), nr AS (SELECT DISTINCT e.user_id, e.ts FROM events e JOIN nf ON e.user_id = nf.user_id AND e.event_id % 3 = nf.f),
ng AS (SELECT user_id, round(epoch_us(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) / 6e7, 3) AS g FROM nr), nc AS (SELECT user_id, g, count(*) AS n FROM ng WHERE g > 0 GROUP BY 1, 2),
ob AS (SELECT CAST(user_id AS VARCHAR) AS device_serial, arg_min(g, (-n, g)) AS minutes FROM nc GROUP BY 1 HAVING sum(n) > 1)"""


def _devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").selectExpr("CASE WHEN o_custkey % 2 = 0 THEN 'z6-' || o_custkey ELSE CAST(o_custkey AS STRING) END AS device_serial", "cast(o_orderdate as timestamp) as at").groupBy("device_serial").agg(F.max("at").alias("last_measurement"))
    return o.unionByName(table(spark, sf_dir, "customer").filter("c_custkey % 20 = 0").selectExpr("'new-' || c_custkey as device_serial", "timestamp '1998-08-31' as last_measurement"))


def _d(a: str, b: str) -> str:
    return f"(epoch_us({a}) - epoch_us({b})) / 86400000000"


def _n(x: str) -> str:
    return f"CAST(CAST(round_even({x}, 0) AS BIGINT) AS VARCHAR)"


_PARTS = {
    "silent_devices": f"""SELECT coalesce(w.station_id, '(not in metadata)') AS station_id, dv.device_serial, CASE WHEN {_d(_AT, 'last_measurement')} > 7 THEN 'high' ELSE 'medium' END AS severity, 'silent for ' || CASE WHEN {_d(_AT, 'last_measurement')} > 7 THEN {_n(_d(_AT, 'last_measurement'))} || ' days' ELSE {_n(_d(_AT, 'last_measurement') + ' * 24')} || ' hours' END AS issue, 'reporting' AS kind
FROM dv LEFT JOIN (SELECT device_serial, arg_min(station_id, number) AS station_id FROM m WHERE {_LIVE} AND device_serial IS NOT NULL GROUP BY 1) w ON dv.device_serial = w.device_serial WHERE {_d(_AT, 'last_measurement')} > 1""",
    "unknown_reporters": "SELECT DISTINCT '(none)' AS station_id, device_serial, 'medium' AS severity, 'reports but is in no table' AS issue, 'not established' AS kind FROM dv WHERE device_serial NOT IN (SELECT device_serial FROM m WHERE device_serial IS NOT NULL)",
    "low_battery": f"SELECT station_id, device_serial, CASE WHEN battery < 15 THEN 'high' ELSE 'medium' END AS severity, 'battery at ' || battery || '%' || CASE WHEN {_d(_AT, 'last_download')} >= 1 THEN ', ' || {_n(_d(_AT, 'last_download'))} || ' days old' ELSE '' END AS issue, 'battery' AS kind FROM m WHERE {_LIVE} AND battery < 25",
    "memory_forecast": f"""SELECT station_id, device_serial, CASE WHEN l <= 14 THEN 'high' ELSE 'medium' END AS severity, CASE WHEN l < 0 THEN 'full, ' || {_n('-l')} || ' days lost' ELSE 'full in ' || {_n('l')} || ' days' END || CASE WHEN abs(seen - interval_min) > 0.001 THEN ', logs at another interval than declared' WHEN last_download IS NULL THEN CASE WHEN seen > 0 THEN ', no offload yet' ELSE ', no offload yet, interval not verified' END ELSE '' END AS issue, 'memory' AS kind
FROM (SELECT m.*, ob.minutes AS seen, {_d('coalesce(last_download, deploy_datetime)', _AT)} + 21600 * coalesce(ob.minutes, interval_min) / 1440 AS l FROM m LEFT JOIN ob ON m.device_serial = ob.device_serial WHERE {_LIVE} AND m.device_serial NOT LIKE 'z%') WHERE l <= 60""",
    "subscriptions": f"SELECT station_id, device_serial, CASE WHEN x < 0 THEN 'high' ELSE 'medium' END AS severity, CASE WHEN x < 0 THEN 'expired ' || {_n('-x')} || ' days ago' ELSE 'expires in ' || {_n('x')} || ' days' END AS issue, 'subscription' AS kind FROM (SELECT *, {_d('CAST(expiry_date AS TIMESTAMP)', _AT)} AS x FROM m WHERE {_LIVE} AND status NOT IN ('defunct', 'nonresponsive')) WHERE x < 60",
    "without_ports": f"SELECT arg_min(station_id, number) AS station_id, device_serial, 'high' AS severity, 'no open port' AS issue, 'ports' AS kind FROM m WHERE {_LIVE} AND device_serial LIKE 'z6%' AND device_serial NOT IN (SELECT sn FROM p WHERE valid_to IS NULL AND sensor <> 'none') GROUP BY device_serial",
    "known_broken": f"SELECT station_id, device_serial, 'medium' AS severity, status || ', seen ' || last_visit AS issue, 'known broken' AS kind FROM m WHERE status IN ('defunct', 'nonresponsive')",
    "stale_reviews": f"SELECT station_id, device_serial, 'low' AS severity, CASE WHEN last_reviewed IS NULL THEN 'never reviewed' ELSE 'reviewed ' || {_n(_d(_AT, 'last_reviewed') + ' / 30.4')} || ' months ago' END AS issue, 'metadata review' AS kind FROM m WHERE {_LIVE} AND status NOT IN ('defunct', 'nonresponsive') AND (last_reviewed IS NULL OR {_d(_AT, 'last_reviewed')} > 180)",
    "unsurveyed_pairs": f"SELECT station_id, device_serial, 'low' AS severity, 'not surveyed: ' || concat_ws(' and ', CASE WHEN elev IS NULL THEN 'elevation' END, CASE WHEN reach_length_m IS NULL THEN 'reach length' END) AS issue, 'survey' AS kind FROM m WHERE {_LIVE} AND status NOT IN ('defunct', 'nonresponsive') AND device_role IN ('secondary', 'tertiary') AND station_type = 'hydro' AND (elev IS NULL OR reach_length_m IS NULL)",
    "source_unavailable": "SELECT CAST(NULL AS VARCHAR) AS station_id, CAST(NULL AS VARCHAR) AS device_serial, 'high' AS severity, 'device list not available: reporting and new devices not checked' AS issue, 'error' AS kind",
}
_RANKS = "CASE kind WHEN 'reporting' THEN 1 WHEN 'battery' THEN 2 WHEN 'memory' THEN 3 WHEN 'survey' THEN 4 WHEN 'known broken' THEN 5 WHEN 'subscription' THEN 6 WHEN 'ports' THEN 7 WHEN 'not established' THEN 8 WHEN 'metadata review' THEN 9 ELSE 10 END AS kind_rank, CASE severity WHEN 'high' THEN 1 WHEN 'medium' THEN 2 WHEN 'low' THEN 3 ELSE 4 END AS severity_rank"


def _all(names: list[str]) -> str:
    parts = " UNION ALL ".join(f"({_PARTS[n]})" for n in names)
    return f"{_M}, {_DEV}, {_OBS} SELECT station_id, device_serial, severity, issue, kind, {_RANKS} FROM ({parts})"


@query(_all([n for n in _PARTS if n != "source_unavailable"]))
def network_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.network_findings(net.deployments(spark, sf_dir), net.ports(spark, sf_dir), _devices(spark, sf_dir), findings.newest_observed(event_readings(spark, sf_dir)), NOW, "number")


@query(_all([n for n in _PARTS if n not in ("silent_devices", "unknown_reporters")]))
def severity_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report without a device list: one finding says what was not checked, the rest is ranked as ever."""
    return findings.network_findings(net.deployments(spark, sf_dir), net.ports(spark, sf_dir), None, findings.newest_observed(event_readings(spark, sf_dir)), NOW, "number")


def _finding(name: str, build) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(spark, sf_dir)

    run.__name__ = name
    query(f"{_M}, {_DEV}, {_OBS} {_PARTS[name]}")(run)


_now = lambda: F.lit(NOW).cast("timestamp")
_finding("silent_devices", lambda s, d: findings.silent(net.deployments(s, d), _devices(s, d), _now(), "number"))
_finding("unknown_reporters", lambda s, d: findings.unknown_reporters(net.deployments(s, d), _devices(s, d)))
_finding("low_battery", lambda s, d: findings.low_battery(net.deployments(s, d), _now()))
_finding("memory_forecast", lambda s, d: findings.memory_forecast(net.deployments(s, d), findings.newest_observed(event_readings(s, d)), _now()))
_finding("subscriptions", lambda s, d: findings.subscriptions(net.deployments(s, d), _now()))
_finding("without_ports", lambda s, d: findings.without_ports(net.deployments(s, d), net.ports(s, d), "number"))
_finding("known_broken", lambda s, d: findings.known_broken(net.deployments(s, d)))
_finding("stale_reviews", lambda s, d: findings.stale_reviews(net.deployments(s, d), _now()))
_finding("unsurveyed_pairs", lambda s, d: findings.unsurveyed_pairs(net.deployments(s, d)))


@query(_M + f""", {_DEV}, ct AS (SELECT device_serial, max(last_measurement) AS c FROM dv GROUP BY 1), ar AS (SELECT trim(device_serial) AS s, max(end_date) AS e FROM d WHERE trim(device_serial) <> '' GROUP BY 1)
SELECT number, c AS last_contact, e AS data_to, status IN ('online', 'nonresponsive') AS reports FROM m LEFT JOIN ct ON m.device_serial = ct.device_serial LEFT JOIN ar ON m.device_serial = ar.s WHERE {_LIVE}""")
def station_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings.network_roster(net.deployments(spark, sf_dir), _devices(spark, sf_dir), net.downloads(spark, sf_dir)).select("number", ntz("last_contact"), ntz("data_to"), "reports")


# --- changes -------------------------------------------------------------------------------------------------

_PORTS_OUT = "SELECT sn, port, sensor, valid_from, valid_to, count(*) AS n FROM ({}) GROUP BY ALL"


def _counted_ports(ports: DataFrame) -> DataFrame:
    return ports.select("sn", "port", "sensor", ntz("valid_from"), ntz("valid_to")).groupBy("sn", "port", "sensor", "valid_from", "valid_to").agg(F.count("*").alias("n"))


def _only(d: DataFrame) -> DataFrame:
    """Without the repeated ids that the rules are tested on: the changes below name rows by id."""
    return d.withColumn("unique_id", F.concat(F.lit("o-"), F.col("number").cast("string")))


_CL = f"cl AS (SELECT device_serial AS sn, min(TIMESTAMP '1998-08-01') AS at FROM m WHERE number % 12 = 0 GROUP BY 1)"


@query(_M + f", {_CL} " + _PORTS_OUT.format("SELECT p.sn, port, sensor, valid_from, coalesce(valid_to, cl.at) AS valid_to FROM p LEFT JOIN cl ON p.sn = cl.sn"))
def close_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    retired = _only(net.deployments(spark, sf_dir)).filter("number % 12 = 0").select("unique_id", F.lit("1998-08-01").cast("timestamp").alias("at"))
    return _counted_ports(changes.retire_with_ports(_only(net.deployments(spark, sf_dir)), retired, net.ports(spark, sf_dir))[1])


_NEWROWS = "nr AS (SELECT c_custkey AS number, CASE WHEN c_custkey % 2 = 0 THEN 'z6-' || c_custkey ELSE CAST(c_custkey AS VARCHAR) END AS device_serial, CASE c_custkey % 3 WHEN 0 THEN 'Hydro' WHEN 1 THEN 'vwc' ELSE 'lake' END AS station_type, CASE c_custkey % 2 WHEN 0 THEN 'z' ELSE 'h' END AS pre FROM customer)"


def _new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr("c_custkey as number", "CASE WHEN c_custkey % 2 = 0 THEN 'z6-' || c_custkey ELSE CAST(c_custkey AS STRING) END AS device_serial", "CASE c_custkey % 3 WHEN 0 THEN 'Hydro' WHEN 1 THEN 'vwc' ELSE 'lake' END AS station_type", "CASE c_custkey % 2 WHEN 0 THEN 'z' ELSE 'h' END AS pre")


def _coded(d: DataFrame) -> DataFrame:
    return d.withColumn("unique_id", F.expr("CASE number % 3 WHEN 0 THEN 'z-' WHEN 1 THEN 'h-' ELSE 'q-' END || lpad(cast(number as string), greatest(4, length(cast(number as string))), '0')"))


_CODED = "mc AS (SELECT m.* EXCLUDE (unique_id), CASE number % 3 WHEN 0 THEN 'z-' WHEN 1 THEN 'h-' ELSE 'q-' END || lpad(CAST(number AS VARCHAR), CAST(greatest(4, length(CAST(number AS VARCHAR))) AS INTEGER), '0') AS unique_id FROM m)"
_PAD = "lpad(CAST({0} AS VARCHAR), CAST(greatest(4, length(CAST({0} AS VARCHAR))) AS INTEGER), '0')"


@query(_M + f""", {_NEWROWS}, {_CODED}, lv AS (SELECT DISTINCT device_serial, station_type FROM m WHERE {_LIVE} AND device_serial IS NOT NULL), tk AS (SELECT nr.*, EXISTS (SELECT 1 FROM lv WHERE lv.device_serial = nr.device_serial AND lv.station_type = lower(nr.station_type)) AS refused FROM nr),
nx AS (SELECT *, row_number() OVER (PARTITION BY pre ORDER BY number) + CASE pre WHEN 'z' THEN (SELECT max(number) FROM m WHERE number % 3 = 0) ELSE (SELECT max(number) FROM m WHERE number % 3 = 1) END AS k FROM tk WHERE NOT refused)
SELECT 'kept' AS part, unique_id, device_serial FROM mc UNION ALL SELECT 'added', pre || '-' || {_PAD.format('k')}, device_serial FROM nx UNION ALL SELECT 'refused', NULL, device_serial FROM tk WHERE refused""")
def add_deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, refused = changes.add_deployments(_coded(net.deployments(spark, sf_dir)), _new_rows(spark, sf_dir), F.col("pre"), ["number"])
    kept = every.select(F.when(F.col("pre").isNull(), "kept").otherwise("added").alias("part"), "unique_id", "device_serial")
    return kept.unionByName(refused.select(F.lit("refused").alias("part"), F.lit(None).cast("string").alias("unique_id"), "device_serial"))


@query(_M + f""", {_NEWROWS}, {_CODED} SELECT number, pre || '-' || {_PAD.format('k')} AS unique_id FROM (SELECT *, row_number() OVER (PARTITION BY pre ORDER BY number) + CASE pre WHEN 'z' THEN (SELECT max(number) FROM m WHERE number % 3 = 0) ELSE (SELECT max(number) FROM m WHERE number % 3 = 1) END AS k FROM nr)""")
def next_suffix_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.next_ids(_new_rows(spark, sf_dir), _coded(net.deployments(spark, sf_dir)), F.col("pre"), ["number"]).select("number", "unique_id")


@query("""WITH st AS (SELECT DISTINCT lower(n_name) || '_' || CASE n_nationkey % 3 WHEN 0 THEN 'hydro' || (n_nationkey % 5 + 1) WHEN 1 THEN 'pond' ELSE 'vwc' END AS id FROM nation),
w AS (SELECT c_custkey, lower(n_name) AS s, CASE c_custkey % 3 WHEN 0 THEN 'hydro' WHEN 1 THEN 'pond' ELSE 'lake' END AS t FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, s || '_' || t || CASE WHEN EXISTS (SELECT 1 FROM st WHERE regexp_full_match(id, s || '_' || t || '[0-9]*')) THEN coalesce((SELECT CAST(max(CAST(nullif(regexp_extract(id, '([0-9]*)$', 1), '') AS BIGINT)) + 1 AS VARCHAR) FROM st WHERE regexp_full_match(id, s || '_' || t || '[0-9]*')), '2') WHEN t = 'hydro' THEN '1' ELSE '' END AS station_id FROM w""")
def next_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    stations = nation.selectExpr("lower(n_name) || '_' || CASE n_nationkey % 3 WHEN 0 THEN 'hydro' || (n_nationkey % 5 + 1) WHEN 1 THEN 'pond' ELSE 'vwc' END AS station_id")
    wanted = c.join(nation, c["c_nationkey"] == nation["n_nationkey"]).selectExpr("c_custkey", "n_name as site", "CASE c_custkey % 3 WHEN 0 THEN 'hydro' WHEN 1 THEN 'pond' ELSE 'lake' END as station_type")
    return changes.next_station(wanted, stations).select("c_custkey", "station_id")


_DECOM = f"""cs AS (SELECT 'st' || k AS station_id FROM (SELECT unnest(generate_series(0, 99)) AS k) WHERE k % 3 = 0), dd AS (SELECT m.*, cs.station_id IS NOT NULL AS c, bool_or({_LIVE}) OVER (PARTITION BY m.station_id) AS a,
  max(CASE WHEN status = 'removed' THEN {{'v': last_visit, 's': device_serial}} END) OVER (PARTITION BY m.station_id) AS l FROM m LEFT JOIN cs ON m.station_id = cs.station_id),
de AS (SELECT *, c AND CASE WHEN a THEN {_LIVE} ELSE coalesce(status = 'removed' AND device_serial = l.s, false) END AS hit FROM dd), df AS (SELECT *, CASE WHEN hit THEN 'decommissioned' ELSE status END AS after FROM de)"""


def _decommissioned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = net.deployments(spark, sf_dir)
    stations = d.select("station_id").distinct().filter("station_id <> '' and cast(substr(station_id, 3) as int) % 3 = 0").withColumn("at", F.lit("1998-08-01").cast("timestamp"))
    return changes.decommission(d, stations, net.ports(spark, sf_dir))


@query(_M + f", {_DECOM} SELECT number, after AS status FROM df")
def decommission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decommissioned(spark, sf_dir)[0].select("number", "status")


@query(_M + f", {_DECOM}, cl AS (SELECT device_serial AS sn FROM df WHERE device_serial IS NOT NULL GROUP BY 1 HAVING bool_or(hit AND {_LIVE}) AND bool_and(after IN {_TERMINAL})) " + _PORTS_OUT.format("SELECT p.sn, port, sensor, valid_from, CASE WHEN valid_to IS NULL AND cl.sn IS NOT NULL THEN TIMESTAMP '1998-08-01' ELSE valid_to END AS valid_to FROM p LEFT JOIN cl ON p.sn = cl.sn"))
def decommission_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counted_ports(_decommissioned(spark, sf_dir)[1])


_PAIRS = "pr2 AS (SELECT station_id, min(device_serial) AS a, max(device_serial) AS b FROM m WHERE station_id <> '' AND device_serial IS NOT NULL AND number % 7 <> 0 GROUP BY 1 HAVING min(device_serial) <> max(device_serial))"


@query(_M + f""", {_PAIRS}, lv AS (SELECT DISTINCT station_id, device_serial FROM m WHERE {_LIVE}), ok AS (SELECT * FROM pr2 WHERE (station_id, a) IN (SELECT (station_id, device_serial) FROM lv) AND (station_id, b) IN (SELECT (station_id, device_serial) FROM lv)),
s AS (SELECT *, CASE WHEN number % 5 = 0 THEN 10.5 ELSE elev END AS e1, CASE WHEN number % 5 = 0 THEN 'gps' ELSE elev_source END AS s1 FROM m), t AS (SELECT *, CASE WHEN number % 9 = 0 THEN round(e1 + 0.25, 4) ELSE e1 END AS e2 FROM s)
SELECT number, CASE WHEN {_LIVE} AND x.a IS NOT NULL THEN 100.0 WHEN {_LIVE} AND y.b IS NOT NULL THEN 101.5 ELSE e2 END AS elev, CASE WHEN {_LIVE} AND x.a IS NOT NULL THEN 'lidar' WHEN {_LIVE} AND y.b IS NOT NULL THEN 'surveyed_relative' ELSE s1 END AS elev_source, CASE WHEN {_LIVE} AND y.b IS NOT NULL THEN 24.16 ELSE reach_length_m END AS reach_length_m, CASE WHEN number % 5 = 0 THEN 12.0 ELSE 8.0 END AS sensor_height_cm
FROM t LEFT JOIN ok x ON t.station_id = x.station_id AND t.device_serial = x.a LEFT JOIN ok y ON t.station_id = y.station_id AND t.device_serial = y.b""")
def apply_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _only(net.deployments(spark, sf_dir)).withColumn("sensor_height_cm", F.lit(8.0))
    surveys = d.filter("number % 5 = 0").selectExpr("unique_id", "10.5D as elev", "'gps' as elev_source", "12.0D as sensor_height_cm")
    shifts = d.filter("number % 9 = 0").selectExpr("unique_id", "0.25D as shift_by")
    pairs = d.filter("station_id <> '' and device_serial is not null and number % 7 <> 0").groupBy("station_id").agg(F.min("device_serial").alias("primary_serial"), F.max("device_serial").alias("secondary_serial")).filter("primary_serial <> secondary_serial")
    pairs = pairs.selectExpr("*", "100.0D as primary_elev", "'lidar' as primary_source", "1.5D as difference", "24.16D as reach")
    return changes.apply_survey(d, surveys, shifts, pairs).select("number", "elev", "elev_source", "reach_length_m", "sensor_height_cm")


@query(_M + f""", mv AS (SELECT station_id, device_serial, CASE WHEN number % 80 = 0 THEN 'Primary' ELSE device_role END AS role FROM m WHERE number % 16 = 0), mg AS (SELECT station_id, bool_or(coalesce(lower(role) = 'primary', false)) AS al, list(DISTINCT device_serial) FILTER (device_serial IS NOT NULL) AS own FROM mv GROUP BY 1),
h AS (SELECT m.*, {_LIVE} AND station_type = 'hydro' AND bool_or({_LIVE} AND coalesce(device_role IN ('secondary', 'tertiary'), false)) OVER (PARTITION BY m.station_id) AND coalesce(al OR list_contains(own, device_serial), false) AS hit FROM m LEFT JOIN mg ON m.station_id = mg.station_id)
SELECT number, CASE WHEN NOT hit THEN elev END AS elev, CASE WHEN NOT hit THEN elev_source END AS elev_source, CASE WHEN NOT hit THEN reach_length_m END AS reach_length_m FROM h""")
def invalidate_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = net.deployments(spark, sf_dir)
    moved = d.filter("number % 16 = 0").select("station_id", "device_serial", F.when(F.col("number") % 80 == 0, "Primary").otherwise(F.col("device_role")).alias("role"))
    return changes.invalidate_geometry(d, moved).select("number", "elev", "elev_source", "reach_length_m")


@query("SELECT CAST(c_custkey AS VARCHAR) AS station_id, CASE WHEN c_custkey % 4 = 0 THEN '1999-01-01' ELSE '1998-01-01' END AS confirmed_from FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 4 = 0")
def upsert_confirmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.diff import upsert

    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("station_id"), "c_custkey")
    old, new = c.filter("c_custkey % 3 <> 0").withColumn("confirmed_from", F.lit("1998-01-01")), c.filter("c_custkey % 4 = 0").withColumn("confirmed_from", F.lit("1999-01-01"))
    return upsert(old.drop("c_custkey"), new.drop("c_custkey"), ["station_id"])


@query("""WITH o AS (SELECT c_custkey AS k, 'awaiting_offload' AS stage, 'old' AS created, 'old' AS updated FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, 'awaiting_rename' AS stage, 'new' AS created, 'new' AS updated FROM customer WHERE c_custkey % 4 = 0),
u AS (SELECT * FROM o WHERE k NOT IN (SELECT k FROM n) UNION ALL SELECT n.k, n.stage, coalesce(o.created, n.created), n.updated FROM n LEFT JOIN o ON n.k = o.k)
SELECT k, CASE WHEN k % 5 = 0 THEN 'awaiting_temp_csv' ELSE stage END AS stage, created, CASE WHEN k % 5 = 0 THEN 'later' ELSE updated END AS updated FROM u WHERE k % 11 <> 0""")
def upsert_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.lit("st").alias("station_id"), F.col("c_custkey").cast("string").alias("device_serial"))
    row = lambda d, stage, when: d.withColumns({"stage": F.lit(stage), "created": F.lit(when), "updated": F.lit(when)})
    pending = changes.upsert_keeping(row(c.filter("k % 3 <> 0"), "awaiting_offload", "old"), row(c.filter("k % 4 = 0"), "awaiting_rename", "new"), ["station_id", "device_serial"], ["created"])
    updates = c.filter("k % 5 = 0").withColumns({"stage": F.lit("awaiting_temp_csv"), "updated": F.lit("later")})
    return changes.update_stages(pending, updates, c.filter("k % 11 = 0"), tuple(monitor.STAGES)).select("k", "stage", "created", "updated")


@query(_M + f""", {_CODED}, h AS (SELECT *, number % 15 = 0 AND {_LIVE} AS hit FROM mc) SELECT unique_id, device_serial, CASE WHEN hit THEN 'replaced' ELSE status END AS status, elev FROM h
UNION ALL SELECT 'z-' || {_PAD.format("((SELECT max(number) FROM m WHERE number % 3 = 0) + row_number() OVER (ORDER BY unique_id))")}, 'n' || number, status, CASE WHEN station_type <> 'hydro' THEN elev END FROM h WHERE hit""")
def replace_deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _coded(net.deployments(spark, sf_dir))
    r = d.filter("number % 15 = 0").select("unique_id", F.concat(F.lit("n"), F.col("number").cast("string")).alias("new_serial"), F.lit("1998-08-01").cast("timestamp").alias("at"))
    return changes.replace_deployments(d, r, F.lit("z")).select("unique_id", "device_serial", "status", "elev")


@query(_M + """, l AS (SELECT * FROM m WHERE number % 2 = 0 OR device_serial NOT LIKE '%7'), lost AS (SELECT DISTINCT device_serial FROM m WHERE number % 2 = 1 AND device_serial LIKE '%7' AND device_serial NOT IN (SELECT device_serial FROM l WHERE device_serial IS NOT NULL))
SELECT 'deployment' AS part, count(*) AS n, sum(number)::BIGINT AS total FROM (SELECT * FROM m WHERE NOT coalesce(number % 2 = 1 AND device_serial LIKE '%7', false)) UNION ALL SELECT 'port', count(*), sum(port)::BIGINT FROM p WHERE sn NOT IN (SELECT device_serial FROM lost)""")
def delete_deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _only(net.deployments(spark, sf_dir))
    left, ports = changes.delete_deployments(d, d.filter("number % 2 = 1 and device_serial like '%7'"), net.ports(spark, sf_dir))
    total = lambda df, part, c: df.agg(F.count("*").alias("n"), F.sum(c).cast("bigint").alias("total")).select(F.lit(part).alias("part"), "n", "total")
    return total(left, "deployment", "number").unionByName(total(ports, "port", "port"))


_FIX = "fx AS (SELECT number, CASE WHEN number % 20 <> 0 THEN 'fixed ' || number % 40 END AS n2, CASE WHEN number % 30 = 0 THEN 60 END AS i2 FROM m WHERE number % 10 = 0)"


def _corrected(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = _only(net.deployments(spark, sf_dir))
    fix = d.filter("number % 10 = 0").select("unique_id", F.when(F.col("number") % 20 != 0, F.concat(F.lit("fixed "), (F.col("number") % 40).cast("string"))).alias("device_name"), F.when(F.col("number") % 30 == 0, 60).alias("interval_min"))
    return changes.correct_fields(d, fix, ["device_name", "interval_min"])


@query(_M + f", {_FIX} SELECT m.number, coalesce(n2, device_name) AS device_name, CAST(coalesce(i2, interval_min) AS INTEGER) AS interval_min FROM m LEFT JOIN fx ON m.number = fx.number")
def correct_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corrected(spark, sf_dir)[0].select("number", "device_name", "interval_min")


@query(_M + f", {_FIX} SELECT 'o-' || m.number AS unique_id, 'device_name' AS field, device_name AS old, n2 AS new FROM m JOIN fx ON m.number = fx.number WHERE n2 IS NOT NULL AND n2 IS DISTINCT FROM device_name UNION ALL SELECT 'o-' || m.number, 'interval_min', CAST(interval_min AS VARCHAR), CAST(i2 AS VARCHAR) FROM m JOIN fx ON m.number = fx.number WHERE i2 IS NOT NULL AND i2 <> interval_min")
def correction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _corrected(spark, sf_dir)[1]
