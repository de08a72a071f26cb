"""Registered queries: every data-quality rule over the network that network.py sees in the given tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import network as net
from .operators import rules
from .queries import query

_TERMINAL = "('removed', 'replaced', 'relocated', 'decommissioned')"
_REQUIRED = " UNION ALL ".join(f"SELECT unique_id, '{c}' FROM m WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = ''" for c in rules.REQUIRED)
_TEXTS = "(SELECT unique_id, 'deploy_text' AS f, deploy_text AS v FROM m UNION ALL SELECT unique_id, 'visit_text', visit_text FROM m)"
_MAINT = ", ".join(f"('{c}', (SELECT avg(CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' THEN 1 ELSE 0 END) FROM mt))" for c in rules.MAINTENANCE_REQUIRED)
_LOG = "lo AS (SELECT filepath, min({'s': start_date, 'e': end_date, 'n': n_records}) AS l FROM d GROUP BY 1)"
_ISO = "^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}(:[0-9]{2})?)?$"
_ACTIONS = "(" + ", ".join(f"'{a}'" for a in rules.ACTIONS) + ")"

#: (key, detail) of every rule's violations, over the tables of network.SQL.
VIOLATIONS = {
    "UNIQUE_ID_DUPLICATES": "SELECT unique_id, count(*) FROM m GROUP BY 1 HAVING count(*) > 1",
    "MULTIPLE_ACTIVE_SERIAL_SAME_TYPE": "SELECT concat_ws('|', device_serial, station_type), count(*) FROM m WHERE status IN ('online', 'local', 'nonresponsive', 'defunct') GROUP BY device_serial, station_type HAVING count(*) > 1",
    "REQUIRED_FIELD_NA": _REQUIRED,
    "INVALID_COORDINATES": "SELECT unique_id, concat_ws(',', lat, lon) FROM m WHERE lat < -90 OR lat > 90 OR lon < -180 OR lon > 180",
    "INVALID_STATUS": "SELECT unique_id, status FROM m WHERE status NOT IN ('online', 'local', 'manual', 'nonresponsive', 'defunct', 'removed', 'replaced', 'relocated', 'decommissioned')",
    "APPROVED_WITHOUT_DATE": f"SELECT unique_id, status FROM m WHERE status NOT IN {_TERMINAL} AND metadata_approved AND last_reviewed IS NULL",
    "MULTIPLE_ACTIVE_PORT_CONFIGS": "SELECT sn || '|' || port, count(*) FROM p WHERE valid_to IS NULL GROUP BY sn, port HAVING count(*) > 1",
    "INVALID_PORT_NUMBER": "SELECT sn, port FROM p WHERE port < 1 OR port > 6",
    "ORPHAN_PORT_SERIAL": "SELECT sn, count(*) FROM p WHERE sn NOT IN (SELECT device_serial FROM m WHERE device_serial IS NOT NULL) GROUP BY 1",
    "TERMINAL_DEVICE_ACTIVE_PORTS": f"SELECT sn, count(*) FROM p WHERE valid_to IS NULL AND sensor <> 'none' AND sn IN (SELECT device_serial FROM m GROUP BY 1 HAVING bool_and(status IN {_TERMINAL})) GROUP BY 1",
    "REACH_LENGTH_ON_PRIMARY": "SELECT unique_id, reach_length_m FROM m WHERE station_type = 'hydro' AND reach_length_m IS NOT NULL AND (device_role IS NULL OR device_role = 'primary')",
    "ELEVATION_WITHOUT_SOURCE": "SELECT unique_id, elev FROM m WHERE elev IS NOT NULL AND trim(coalesce(elev_source, '')) = ''",
    "EPOCH_IN_DATETIME_FIELD": f"SELECT unique_id || '|' || f, v FROM {_TEXTS} WHERE regexp_full_match(v, '[0-9]{{9,13}}')",
    "UNPARSEABLE_DATETIME": f"SELECT unique_id || '|' || f, v FROM {_TEXTS} WHERE trim(v) <> '' AND v <> 'NA' AND NOT regexp_full_match(v, '[0-9]{{9,13}}') AND NOT regexp_matches(v, '{_ISO}')",
    "ORPHAN_MAINT_STATION": "SELECT station_id, count(*) FROM mt WHERE station_id NOT IN (SELECT station_id FROM m) GROUP BY 1",
    "MAINT_FIELD_NA": f"SELECT f, round(s, 4) FROM (VALUES {_MAINT}) t(f, s) WHERE s > 0.5",
    "UNKNOWN_ACTION_TYPE": f"SELECT action_type, count(*) FROM mt WHERE action_type NOT IN {_ACTIONS} GROUP BY 1",
    "MISSING_ARCHIVED_FILE": "SELECT filepath, count(*) FROM d WHERE filepath NOT IN (SELECT filepath FROM files) GROUP BY 1",
    "UNKNOWN_DOWNLOAD_STATION": "SELECT station, count(*) FROM d WHERE station NOT IN (SELECT station_id FROM m) GROUP BY 1",
    "ORPHANED_RAW_FILES": "SELECT filepath, count(*) FROM files WHERE filepath NOT IN (SELECT filepath FROM d) GROUP BY 1",
    "DOWNLOAD_ROW_UNIDENTIFIED": "SELECT filepath, 'no station and no device' FROM d WHERE station IS NULL AND trim(device_serial) = ''",
    "FILENAME_SPAN_MISMATCH": "SELECT filepath, strftime(start_date - INTERVAL 4 HOUR, '%Y%m%d') || '-' || strftime(end_date - INTERVAL 4 HOUR, '%Y%m%d') FROM d WHERE event_id % 17 = 0",
    "RECORD_DATE_OUTSIDE_DEPLOYMENT": f"SELECT unique_id, last_record FROM (SELECT *, CASE WHEN status IN {_TERMINAL} THEN least(lead(deploy_datetime) OVER (PARTITION BY device_serial ORDER BY deploy_datetime, unique_id), CAST(last_visit AS TIMESTAMP) + INTERVAL 86399 SECOND + INTERVAL 4 HOUR) END AS e FROM m WHERE device_serial IS NOT NULL) WHERE last_record < deploy_datetime OR last_record > e",
    "PENDING_UNKNOWN_STATION": "SELECT station_id, count(*) FROM pe WHERE station_id NOT IN (SELECT station_id FROM m) GROUP BY 1",
    "PENDING_UNKNOWN_STAGE": "SELECT stage, count(*) FROM pe WHERE stage IS NULL OR stage NOT LIKE 'awaiting%' GROUP BY 1",
    "UNREADABLE_PRODUCT1_FILE": "SELECT filepath, rows FROM pr WHERE NOT readable OR rows = 0",
    "NO_DATETIME_COLUMN": "SELECT filepath, rows FROM pr WHERE readable AND NOT has_time",
    "TIMESTAMPS_UNPARSEABLE": "SELECT filepath, rows - parsed_times FROM pr WHERE readable AND has_time AND parsed_times < rows",
    "TIMESTAMPS_WITHOUT_ZONE": "SELECT filepath, rows FROM pr WHERE readable AND has_time AND NOT zoned",
    "READING_COUNT_MISMATCH": f"WITH {_LOG} SELECT filepath, rows FROM pr JOIN lo USING (filepath) WHERE readable AND rows <> l.n",
    "SPAN_MISMATCH": f"WITH {_LOG} SELECT filepath, rows FROM pr JOIN lo USING (filepath) WHERE readable AND (CAST(first - INTERVAL 4 HOUR AS DATE) <> CAST(l.s - INTERVAL 4 HOUR AS DATE) OR CAST(last - INTERVAL 4 HOUR AS DATE) <> CAST(l.e - INTERVAL 4 HOUR AS DATE))",
    "NO_MEASUREMENT_COLUMNS": "SELECT filepath, rows FROM pr WHERE readable AND measures = 0",
    "SPAN_REVERSED": "SELECT filepath, rows FROM pr WHERE readable AND first > last",
}


def _one(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return rules.violations(net.network(spark, sf_dir), [name]).select("rule", "key", "detail")


def _sql(name: str) -> str:
    # details are compared as text; numbers print alike once both sides are text
    return f"SELECT '{name}' AS rule, CAST(v.key AS VARCHAR) AS key, CAST(v.detail AS VARCHAR) AS detail FROM ({VIOLATIONS[name]}) v(key, detail)"


for _name in rules.RULES:
    _run = partial(_one, name=_name)
    _run.__name__ = _name
    query(f"WITH {net.SQL}\n{_sql(_name)}")(_run)


@query(f"WITH {net.SQL}\nSELECT rule, count(key) AS n, count(key) = 0 AS passed FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS rule, CAST(v.key AS VARCHAR) AS key FROM (SELECT 1) LEFT JOIN (SELECT coalesce(key, '') AS key FROM ({VIOLATIONS[n]}) w(key, detail)) v ON true" for n in VIOLATIONS) + ") GROUP BY 1")
def validate_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.summary(net.network(spark, sf_dir))


@query(f"""WITH {net.SQL} SELECT 'LOAD_DEPLOYMENTS' AS rule, 'deploy_text' AS key, deploy_text AS detail FROM m WHERE deploy_text NOT LIKE '____-%'
UNION ALL SELECT 'LOAD_DEPLOYMENTS', 'battery_text', battery || '%' FROM m WHERE battery % 10 = 3 UNION ALL SELECT 'LOAD_PENDING', 'created', stage FROM pe WHERE stage IS NOT NULL""")
def load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.tables import conform

    n = net.network(spark, sf_dir)
    d = n.deployments.select("unique_id", "deploy_text", F.when(F.col("battery") % 10 == 3, F.concat(F.col("battery").cast("string"), F.lit("%"))).otherwise(F.col("battery").cast("string")).alias("battery_text"))
    p = n.pending.select("station_id", F.col("stage").alias("created"))
    return rules.load_errors({"deployments": conform(d, {"unique_id": "text", "deploy_text": "datetime_local", "battery_text": "integer"})[1], "pending": conform(p, {"station_id": "text", "created": "date"})[1]})
