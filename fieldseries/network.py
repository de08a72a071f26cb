"""The given tables seen as a station network: deployments, ports, logs, files, pending work.

Each adapter is a list of expressions that Spark and DuckDB read alike, so a query and its SQL start from the
same rows.  No row of the tables that are read is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import table
from .operators.rules import Network

_SERIAL = "CASE WHEN o_custkey % 2 = 0 THEN 'z6-' || CAST(o_custkey AS STRING) ELSE CAST(o_custkey AS STRING) END"
_DAY = "replace(CAST(CAST({} AS DATE) AS STRING), '-', '')"

DEPLOYMENTS = {
    "unique_id": "'id-' || CAST(CASE WHEN o_orderkey % 101 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS STRING)",
    "number": "o_orderkey",
    "device_serial": f"CASE WHEN o_orderkey % 211 = 0 THEN NULL ELSE {_SERIAL} END",
    "station_id": "CASE WHEN o_orderkey % 223 = 0 THEN '' ELSE 'st' || CAST(o_orderkey % 100 AS STRING) END",
    "station_type": "CASE o_orderkey % 4 WHEN 0 THEN 'hydro' WHEN 1 THEN 'weather' WHEN 2 THEN 'vwc' ELSE 'pond' END",
    "device_role": "CASE o_orderkey % 5 WHEN 0 THEN 'primary' WHEN 1 THEN 'secondary' WHEN 2 THEN 'tertiary' END",
    "status": "CASE WHEN o_orderkey % 97 = 0 THEN 'odd' WHEN o_custkey % 17 = 3 THEN 'decommissioned' WHEN o_orderstatus = 'F' THEN 'removed' WHEN o_orderstatus = 'P' THEN 'local' WHEN o_orderkey % 23 = 0 THEN 'defunct' WHEN o_orderkey % 29 = 0 THEN 'nonresponsive' ELSE 'online' END",
    "lat": "CASE WHEN o_orderkey % 89 <> 0 THEN CAST(o_orderkey % 185 - 92 AS DOUBLE) END",
    "lon": "CAST(o_orderkey % 365 - 182 AS DOUBLE)",
    "elev": "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey % 900 AS DOUBLE) END",
    "elev_source": "CASE WHEN o_orderkey % 7 = 0 THEN ' ' WHEN o_orderkey % 11 <> 0 THEN 'lidar' END",
    "reach_length_m": "CASE WHEN o_orderkey % 6 = 0 THEN CAST(o_custkey % 50 AS DOUBLE) END",
    "interval_min": "CAST(60 * (1 + o_orderkey % 3) AS INT)",
    "timezone": "CASE WHEN o_orderkey % 307 <> 0 THEN 'America/Puerto_Rico' END",
    "mfger": "CASE o_custkey % 2 WHEN 0 THEN 'Meter' ELSE 'Onset' END",
    "device_name": "CASE WHEN o_orderkey % 6 <> 0 THEN 'logger ' || CAST(o_custkey % 40 AS STRING) END",
    "area": "'area ' || CAST(o_orderkey % 100 % 9 AS STRING)",
    "deploy_datetime": "o_orderdate",
    "last_visit": "CAST(o_orderdate + o_orderkey % 400 * INTERVAL 1 DAY AS DATE)",
    "last_record": "o_orderdate + (o_orderkey % 500 - 20) * INTERVAL 1 DAY",
    "last_download": "CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + o_orderkey % 300 * INTERVAL 1 DAY END",
    "expiry_date": "CASE WHEN o_custkey % 2 = 0 THEN CAST(o_orderdate + 700 * INTERVAL 1 DAY AS DATE) END",
    "battery": "CAST(o_orderkey % 100 AS INT)",
    "metadata_approved": "o_orderkey % 3 <> 1",
    "last_reviewed": "CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate + 100 * INTERVAL 1 DAY END",
    "deploy_text": "CASE WHEN o_orderkey % 41 = 0 THEN '1791468900' WHEN o_orderkey % 43 = 0 THEN '3/23/2026' ELSE '2026-03-23 10:15:00' END",
    "visit_text": "CASE WHEN o_orderkey % 47 = 0 THEN 'last week' WHEN o_orderkey % 53 = 0 THEN '' ELSE '2026-03-23' END",
}
PORTS = {
    "sn": f"CASE WHEN l_orderkey % 103 = 0 THEN 'x' || CAST(l_orderkey AS STRING) ELSE {_SERIAL} END",
    "port": "CAST(CASE WHEN l_partkey % 53 = 0 THEN 9 ELSE l_linenumber END AS INT)",
    "sensor": "CASE WHEN l_suppkey % 7 = 0 THEN 'none' WHEN l_suppkey % 5 <> 0 THEN 'TEROS ' || CAST(l_suppkey % 3 AS STRING) END",
    "type": "CASE WHEN l_suppkey % 2 = 0 THEN 'vwc' ELSE 'weather' END",
    "depth_cm": "CAST(10 * l_linenumber AS DOUBLE)",
    "valid_from": "l_shipdate",
    "valid_to": "CASE WHEN l_returnflag <> 'N' THEN l_shipdate + 90 * INTERVAL 1 DAY END",
}
DOWNLOADS = {
    "filepath": f"'raw/' || CAST(user_id AS STRING) || '_' || {_DAY.format('ts - INTERVAL 4 HOUR')} || '_' || {_DAY.format('ts + (event_id % 30 + CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END) * INTERVAL 1 DAY - INTERVAL 4 HOUR')} || '_raw.csv'",
    "event_id": "event_id",
    "station": "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'nowhere' ELSE 'st' || CAST(event_id % 120 AS STRING) END",
    "device_serial": "CASE WHEN event_id % 3 = 0 THEN ' ' ELSE CAST(user_id AS STRING) END",
    "timestamp_utc": "ts",
    "start_date": "ts",
    "end_date": "ts + event_id % 30 * INTERVAL 1 DAY",
    "n_records": "event_id % 50",
}
MAINTENANCE = {
    "field_visit_date": "CAST(ts AS DATE)",
    "station_id": "CASE WHEN event_id % 9 <> 0 THEN 'st' || CAST(event_id % 110 AS STRING) END",
    "device_serial": "CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS STRING) END",
    "action_type": "CASE event_type WHEN 'click' THEN 'cleaning' WHEN 'view' THEN 'battery' ELSE event_type END",
    "logged_by": "CASE WHEN event_id % 2 = 0 THEN '' ELSE 'someone' END",
    "event_id": "event_id",
}
PENDING = {
    "station_id": "'st' || CAST(c_custkey % 130 AS STRING)",
    "device_serial": "CAST(c_custkey AS STRING)",
    "stage": "CASE c_custkey % 5 WHEN 0 THEN 'awaiting_offload' WHEN 1 THEN 'awaiting_rename' WHEN 2 THEN c_mktsegment WHEN 3 THEN 'awaiting_temp_csv' END",
    "created": "CAST('1998-01-01' AS DATE)",
}
PROFILES = {
    "filepath": DOWNLOADS["filepath"],
    "readable": "event_id % 59 <> 0",
    "has_time": "event_id % 61 <> 0",
    "zoned": "event_id % 31 <> 0",
    "rows": "event_id % 50 + CASE WHEN event_id % 37 = 0 THEN 1 ELSE 0 END",
    "parsed_times": "event_id % 50",
    "first": "ts - CASE WHEN event_id % 27 = 0 THEN 30 ELSE 0 END * INTERVAL 1 DAY",
    "last": "ts + (event_id % 30 - CASE WHEN event_id % 33 = 0 THEN 40 ELSE 0 END) * INTERVAL 1 DAY",
    "measures": "event_id % 67",
}


def _cte(name: str, columns: dict[str, str], source: str) -> str:
    return f"{name} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + f" FROM {source})"


_ITEMS = "lineitem JOIN orders ON l_orderkey = o_orderkey"
_FILES = "files AS (SELECT filepath FROM d WHERE event_id % 13 <> 0 UNION ALL SELECT 'raw/extra_' || CAST(event_id AS STRING) FROM d WHERE event_id % 19 = 0)"
#: The same tables for DuckDB: m, p, d, files, mt, pe, pr.
SQL = ",\n".join([_cte("m", DEPLOYMENTS, "orders"), _cte("p", PORTS, _ITEMS), _cte("d", DOWNLOADS, "events"), _FILES, _cte("mt", MAINTENANCE, "events"), _cte("pe", PENDING, "customer"), _cte("pr", PROFILES, "events")])


def _seen(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The columns, with times as instants of the UTC session."""
    out = df.selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
    return out.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in out.dtypes])


def deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seen(table(spark, sf_dir, "orders"), DEPLOYMENTS)


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return _seen(items.join(orders, items["l_orderkey"] == orders["o_orderkey"]), PORTS)


def downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seen(table(spark, sf_dir, "events"), DOWNLOADS)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = downloads(spark, sf_dir)
    return d.filter("event_id % 13 <> 0").select("filepath").unionByName(d.filter("event_id % 19 = 0").selectExpr("'raw/extra_' || cast(event_id as string) as filepath"))


def network(spark: SparkSession, sf_dir: str) -> Network:
    t = lambda name: table(spark, sf_dir, name)
    return Network(deployments(spark, sf_dir), ports(spark, sf_dir), downloads(spark, sf_dir), files(spark, sf_dir), _seen(t("events"), MAINTENANCE), _seen(t("customer"), PENDING), _seen(t("events"), PROFILES), ("deploy_text", "visit_text"))
