"""Registered queries over the given tables, with the SQL that DuckDB checks them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import event_readings, instant, item_moments, item_readings, order_deployments, table
from .functions import parsing, units
from .operators import attribution, dedupe, grid, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name; it runs in a UTC session."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def ntz(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def r6(name: str) -> Column:
    return F.round(name, 6).alias(name)


# --- units and text ---------------------------------------------------------------------------

_UNIT = "CASE user_id % 8 WHEN 0 THEN 'Â°C' WHEN 1 THEN ' F' WHEN 2 THEN 'psi' WHEN 3 THEN 'mbar' WHEN 4 THEN 'mm/hr' WHEN 5 THEN 'ft' WHEN 6 THEN 'mS/cm' ELSE 'odd unit' END"


@query(f"""
SELECT event_id, CASE u WHEN 'Â°C' THEN 'degC' WHEN ' F' THEN 'degF' WHEN 'mbar' THEN 'hPa' WHEN 'mm/hr' THEN 'mm/h' WHEN 'odd unit' THEN 'oddunit' ELSE u END AS unit,
  round(CASE u WHEN ' F' THEN (value - 32) * 5 / 9 WHEN 'psi' THEN value * 6.894757 WHEN 'mbar' THEN value / 10 WHEN 'ft' THEN value * 0.3048 ELSE value END, 6) AS value,
  CASE u WHEN ' F' THEN 'degC' WHEN 'psi' THEN 'kPa' WHEN 'mbar' THEN 'kPa' WHEN 'ft' THEN 'm' WHEN 'mS/cm' THEN 'dS/m' WHEN 'Â°C' THEN 'degC' WHEN 'mm/hr' THEN 'mm/h' WHEN 'odd unit' THEN 'oddunit' ELSE u END AS target
FROM (SELECT event_id, value, {_UNIT} AS u FROM events)""")
def convert_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "value", units.normalize_unit(F.expr(_UNIT)).alias("unit"))
    to = {"degF": "degC", "psi": "kPa", "hPa": "kPa", "ft": "m", "mS/cm": "dS/m"}
    target = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in to.items() for x in p]), F.col("unit")), F.col("unit"))
    return e.select("event_id", "unit", F.round(units.convert_units(F.col("value"), F.col("unit"), target), 6).alias("value"), target.alias("target"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE date_trunc('minute', o_orderdate) + CASE WHEN o_orderkey % 4 = 0 THEN second(o_orderdate) * INTERVAL 1 SECOND ELSE INTERVAL 0 SECOND END + INTERVAL 4 HOUR END AS at,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders""")
def parse_datetime_flexible(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    forms = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "MM/dd/yyyy hh:mm a", "MM/dd/yyyy"]
    text = F.lit(None).cast("string")
    for k, form in enumerate(forms):
        t = F.date_format("o_orderdate", form)
        text = F.when(F.col("o_orderkey") % 4 == k, t if k < 3 else F.concat(t, F.lit(" x"))).otherwise(text)
    day = parsing.parse_date_flexible(text)
    return o.select("o_orderkey", parsing.parse_datetime_flexible(text).cast("timestamp_ntz").alias("at"), day.cast("string").alias("day"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS device_serial,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 1 THEN 'site_' || o_custkey || '_hydro' || o_orderkey % 3 END AS station_id,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS start_date, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS DATE) AS VARCHAR) END AS end_date,
  CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 2 = 1 THEN 'hydro' END AS station_type
FROM orders""")
def parse_raw_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    stem = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(F.concat(F.lit("site_"), "o_custkey", F.lit("_hydro"), F.col("o_orderkey") % 3))
    later = F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 30).cast("int"))
    name = F.concat(stem, F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.date_format(later, "yyyyMMdd"), F.when(F.col("o_orderkey") % 5 == 0, "_odd.csv").when(F.col("o_orderkey") % 3 == 0, "_20240101T000000Z_raw.csv").otherwise("_raw.csv"))
    p = o.select("o_orderkey", parsing.parse_raw_filename(name).alias("p"))
    return p.select("o_orderkey", "p.device_serial", "p.station_id", F.col("p.start_date").cast("string").alias("start_date"), F.col("p.end_date").cast("string").alias("end_date"), parsing.station_type_of(F.col("p.station_id")).alias("station_type"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, e >= 0 AND l_linenumber <= 11 AND e < 8 AS ok,
  round(CASE WHEN l_linenumber <= 11 AND e < 8 THEN (l_quantity * 12 + l_linenumber + e / 8.0) * 0.0254 END, 6) AS value_m,
  round(l_extendedprice * 0.3048, 6) AS feet_m
FROM (SELECT *, l_partkey % 10 AS e FROM lineitem)""")
def parse_rod_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "lineitem")
    text = F.concat_ws(" ", F.col("l_quantity").cast("int"), "l_linenumber", F.col("l_partkey") % 10)
    p = i.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", parsing.parse_rod_reading(text, F.lit("ft_in_8")).alias("p"), F.round(units.to_meters(F.col("l_extendedprice"), F.lit("ft")), 6).alias("feet_m"))
    return p.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "p.ok", F.round("p.value_m", 6).alias("value_m"), "feet_m")


# --- windows and attribution --------------------------------------------------------------------

_WINDOWS = """
w0 AS (SELECT o_custkey AS device_serial, 'st' || o_orderkey % 100 AS station_id, lower(o_orderpriority) AS station_type, o_orderkey AS unique_id, o_orderdate AS starts,
    o_orderstatus = 'F' AS terminal, CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS TIMESTAMP) + INTERVAL 86399 SECOND AS visit,
    min(o_orderdate) OVER (PARTITION BY o_custkey, lower(o_orderpriority) ORDER BY o_orderdate RANGE BETWEEN INTERVAL 1 MICROSECOND FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM orders),
w AS (SELECT device_serial, station_id, station_type, unique_id, starts,
    CASE WHEN terminal AND (nxt IS NULL OR visit < nxt) THEN visit ELSE nxt END AS ends,
    CASE WHEN terminal AND (nxt IS NULL OR visit < nxt) THEN 'last visit' WHEN nxt IS NOT NULL THEN 'successor' ELSE 'open' END AS end_basis FROM w0)"""
_ITEMS = "r AS (SELECT o_custkey AS device_serial, l_orderkey AS item, l_linenumber AS port, l_shipdate AS datetime, l_quantity AS value, l_suppkey, l_partkey, row_number() OVER () AS rid FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


@query(f"WITH {_WINDOWS} SELECT * FROM w")
def deployment_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.deployment_windows(order_deployments(spark, sf_dir))
    return w.withColumns({"starts": F.col("starts").cast("timestamp_ntz"), "ends": F.col("ends").cast("timestamp_ntz")})


_LAST = """{ctes}, m AS (SELECT r.*, w.station_id, w.station_type, w.unique_id, row_number() OVER (PARTITION BY rid ORDER BY {order}) AS n
  FROM r LEFT JOIN w ON r.device_serial = w.device_serial {more} AND w.starts <= r.datetime AND (w.ends IS NULL OR r.datetime < w.ends))"""
_BY_DEVICE = "WITH " + _LAST.format(ctes=f"{_WINDOWS}, {_ITEMS}", more="", order="w.station_type DESC NULLS LAST, w.starts DESC, w.unique_id DESC")


@query(_BY_DEVICE + " SELECT device_serial, item, port, datetime, value, l_suppkey, l_partkey, station_id, station_type, unique_id FROM m WHERE n = 1")
def interval_join_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.deployment_windows(order_deployments(spark, sf_dir))
    return attribution.resolve_by_device(item_readings(spark, sf_dir), w, moments=item_moments(spark, sf_dir)).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@query("WITH " + _LAST.format(ctes=f"{_WINDOWS}, {_ITEMS}", more="AND ('st' || r.l_partkey % 100) = w.station_id", order="w.starts DESC NULLS LAST, w.unique_id DESC") + " SELECT device_serial, item, port, datetime, value, l_suppkey, l_partkey, unique_id FROM m WHERE n = 1")
def deployment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.deployment_windows(order_deployments(spark, sf_dir))
    r = item_readings(spark, sf_dir).withColumn("station_id", F.concat(F.lit("st"), F.col("l_partkey") % 100))
    out = attribution.interval_join(r, w, ["device_serial", "station_id"], "datetime", ["unique_id"], ["starts", "unique_id"], moments=item_moments(spark, sf_dir))
    return out.drop("station_id").withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@query("WITH " + _LAST.format(ctes=f"{_WINDOWS}, {_ITEMS}", more="", order="CASE WHEN w.station_type = '1-urgent' THEN 0 WHEN w.station_type IS NULL THEN 2 ELSE 1 END, w.station_id, w.starts, w.unique_id") + " SELECT device_serial, item, port, datetime, value, l_suppkey, l_partkey, station_id, station_type, unique_id FROM m WHERE n = 1")
def interval_join_prioritised(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.deployment_windows(order_deployments(spark, sf_dir))
    return attribution.resolve_device_level(item_readings(spark, sf_dir), w, first_type="1-urgent", moments=item_moments(spark, sf_dir)).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def _port_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ports of a device by the orders it placed: port k holds a sensor from one order to 200 days later."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("device_serial"),
        (F.col("o_orderkey") % 7 + 1).cast("int").alias("port"),
        F.lower("o_orderpriority").alias("type"),
        F.concat(F.lit("sensor"), F.col("o_orderkey") % 4).alias("sensor"),
        (F.col("o_orderkey") % 5 * 10).cast("double").alias("depth_cm"),
        instant("o_orderdate").alias("starts"),
        F.when(F.col("o_orderkey") % 3 != 0, instant("o_orderdate") + F.expr("interval 200 days")).alias("ends"),
        F.col("o_orderkey").alias("win_seq"),
    )


_PORTS = "p AS (SELECT o_custkey AS device_serial, CAST(o_orderkey % 7 + 1 AS INTEGER) AS port, lower(o_orderpriority) AS type, 'sensor' || o_orderkey % 4 AS sensor, CAST(o_orderkey % 5 * 10 AS DOUBLE) AS depth_cm, o_orderdate AS starts, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate + INTERVAL 200 DAY END AS ends, o_orderkey AS win_seq FROM orders)"
_BY_PORT = f"""WITH {_WINDOWS}, {_ITEMS}, {_PORTS},
a AS (SELECT r.*, p.sensor, p.depth_cm, p.type, row_number() OVER (PARTITION BY rid ORDER BY p.win_seq DESC NULLS LAST) AS n FROM r LEFT JOIN p ON r.device_serial = p.device_serial AND r.port = p.port AND p.starts <= r.datetime AND (p.ends IS NULL OR r.datetime < p.ends)),
b AS (SELECT a.* EXCLUDE (n), w.station_id, w.unique_id, row_number() OVER (PARTITION BY rid ORDER BY w.starts DESC NULLS LAST, w.unique_id DESC) AS n FROM a LEFT JOIN w ON a.device_serial = w.device_serial AND a.type = w.station_type AND w.starts <= a.datetime AND (w.ends IS NULL OR a.datetime < w.ends) WHERE a.n = 1)"""


@query(_BY_PORT + " SELECT device_serial, item, port, datetime, value, l_suppkey, l_partkey, sensor, depth_cm, type, station_id, unique_id FROM b WHERE n = 1")
def interval_join_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.deployment_windows(order_deployments(spark, sf_dir))
    return attribution.resolve_by_port(item_readings(spark, sf_dir), w, _port_windows(spark, sf_dir), moments=item_moments(spark, sf_dir)).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def _to_attribute(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Readings, windows and ports."""
    r = item_readings(spark, sf_dir, {"depth": F.col("l_partkey") % 2 == 0})
    r = r.withColumns({"variable": F.when(F.col("depth"), "soil").otherwise("level"), "device_level": F.lit(False)})
    return r, windows.deployment_windows(order_deployments(spark, sf_dir)), _port_windows(spark, sf_dir)


@query(_BY_PORT + """ SELECT device_serial, item, port, datetime, value, station_id, unique_id,
  (CASE WHEN l_partkey % 2 = 0 THEN 'soil_' || CAST(CAST(depth_cm AS INTEGER) AS VARCHAR) || 'cm' ELSE 'level' END) || CASE WHEN type = '1-urgent' THEN '_' || unique_id ELSE '' END AS series
FROM b WHERE n = 1 AND station_id IS NOT NULL""")
def attribute_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved, _ = attribution.attribute_readings(*_to_attribute(spark, sf_dir), per_deployment=("1-urgent",), moments=item_moments(spark, sf_dir))
    return resolved.select("device_serial", "item", "port", ntz("datetime"), "value", "station_id", "unique_id", "series")


@query(_BY_PORT + """ SELECT device_serial, port, CASE WHEN l_partkey % 2 = 0 THEN 'soil' ELSE 'level' END AS variable, count(*) AS rows, min(datetime) AS first, max(datetime) AS last
FROM b WHERE n = 1 AND station_id IS NULL GROUP BY ALL""")
def summarize_unattributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = attribution.summarize_unattributed(attribution.unattributed_readings(*_to_attribute(spark, sf_dir), moments=item_moments(spark, sf_dir)))
    return s.withColumns({"first": F.col("first").cast("timestamp_ntz"), "last": F.col("last").cast("timestamp_ntz")})


@query(f"""WITH {_WINDOWS}, y AS (SELECT CAST(generate_series AS INTEGER) AS year, make_timestamp(generate_series, 1, 1, 4, 0, 0) AS y0, make_timestamp(generate_series + 1, 1, 1, 4, 0, 0) AS y1 FROM generate_series(1995, 2002))
SELECT DISTINCT station_id, year, device_serial FROM w JOIN y ON starts < y1 AND (ends IS NULL OR ends >= y0)""")
def devices_in_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.deployment_windows(order_deployments(spark, sf_dir))
    span = F.sequence(F.lit(1995), F.lit(2002))
    y = spark.range(1).select(F.explode(span).alias("year"))
    local = lambda c: F.to_utc_timestamp(F.make_timestamp(c, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)), parsing.PROJECT_ZONE)
    return windows.devices_in_years(w, y.withColumns({"y0": local(F.col("year")), "y1": local(F.col("year") + 1)}))


# --- duplicates ------------------------------------------------------------------------------------

_DUP_ORDER = "l_suppkey, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_DEDUPE = f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey ORDER BY l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS nth,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, {_DUP_ORDER}) AS rnk FROM lineitem),
b AS (SELECT *, max(CASE WHEN rnk = 1 THEN l_quantity END) OVER (PARTITION BY l_orderkey, l_linenumber) AS kept FROM a),
c AS (SELECT l_orderkey, l_linenumber, max(kept) AS value, bool_or(nth = 1 AND l_quantity IS DISTINCT FROM kept) AS conflict, CAST(count(*) FILTER (nth > 1) AS INTEGER) AS repeats, sum(l_quantity) FILTER (nth > 1) AS repeat_dropped, count(*) AS n FROM b GROUP BY ALL)"""


def _deduped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    i = table(spark, sf_dir, "lineitem").select("*", F.struct("l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate").alias("row_seq"), F.lit(True).alias("sums"))
    return i, dedupe.dedupe_latest_wins(i, ["l_orderkey", "l_linenumber"], "l_shipdate", "l_suppkey", "row_seq", "l_quantity", "sums")


@query(_DEDUPE + " SELECT l_orderkey, l_linenumber, value, conflict, repeats, repeat_dropped FROM c")
def dedupe_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _deduped(spark, sf_dir)[1].select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("value"), "conflict", "repeats", "repeat_dropped")


@query(_DEDUPE + " SELECT CAST(sum(n) AS BIGINT) AS rows_in, count(*) AS rows_out, CAST(sum(n) AS BIGINT) - count(*) AS removed, count(*) FILTER (conflict) AS conflicts, CAST(sum(repeats) AS BIGINT) AS repeats FROM c")
def dedupe_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_stats(*_deduped(spark, sf_dir))


@query("SELECT event_type AS series, date_trunc('hour', ts) AS hour, min_by(event_id, (ts, event_id)) AS row_seq FROM events GROUP BY ALL")
def first_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "datetime"))
    return dedupe.first_copy(r, ["series", "hour"], ["datetime", "row_seq"]).select("series", ntz("hour"), "row_seq")


# --- grid -----------------------------------------------------------------------------------------------

@query("""WITH t AS (SELECT DISTINCT event_type AS series, to_timestamp(floor(epoch(ts) / 300) * 300) AT TIME ZONE 'UTC' AS t FROM events),
g AS (SELECT series, round_even(epoch(t) - epoch(lag(t) OVER (PARTITION BY series ORDER BY t)), 0) AS gap FROM t),
c AS (SELECT series, gap, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY ALL)
SELECT series, min_by(gap, (-n, gap)) AS native FROM c GROUP BY series""")
def observed_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumn("datetime", grid.moment(F.floor(grid.seconds(F.col("datetime")) / 300) * 300))
    return grid.observed_interval(r, ["series"])


@query("""WITH r AS (SELECT event_type AS series, epoch_us(ts) / 1e6 AS t, value AS v, event_id % 7 = 0 AS c, 'f' || event_id % 3 AS f FROM events),
n AS (SELECT *, lead(t) OVER s AS t1, lead(v) OVER s AS v1, lead(c) OVER s AS c1 FROM r WINDOW s AS (PARTITION BY series ORDER BY t)),
q AS (SELECT *, unnest(generate_series(CAST(floor(t / 900) * 900 AS BIGINT), CAST(floor(coalesce(t1, t) / 900) * 900 AS BIGINT), 900)) AS q FROM n)
SELECT series, make_timestamp(q * 1000000) AS datetime, round(CASE WHEN q = t THEN v ELSE v + (v1 - v) * ((q - t) / (t1 - t)) END, 6) AS value, f AS source_file, CASE WHEN q = t THEN c ELSE c OR c1 END AS conflict
FROM q WHERE q = t OR (q > t AND q < t1 AND t1 - t <= 960)""")
def align_to_grid_instantaneous(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumns({"kind": F.lit("instantaneous"), "conflict": F.col("row_seq") % 7 == 0})
    rows, _ = grid.align_to_grid(r, ["series"])
    return rows.select("series", ntz("datetime"), r6("value"), "source_file", "conflict")


def _bin_sql(kind: str, agg: str) -> str:
    return f"""WITH t AS (SELECT '{kind}' AS series, floor(epoch(ts) / 300) * 300 AS t, min_by(value, event_id) AS v, min_by('f' || event_id % 3, event_id) AS f, bool_or(event_id % 7 = 0) AS c FROM events GROUP BY ALL),
b AS (SELECT series, ceil(t / 900) * 900 AS q, count(*) AS n, {agg}(v) AS v, max_by(f, t) AS f, bool_or(c) AS c FROM t GROUP BY ALL)
SELECT series, make_timestamp(CAST(q * 1000000 AS BIGINT)) AS datetime, round(CASE WHEN n = 3 THEN v END, 6) AS value, f AS source_file, c AS conflict FROM b"""


def _five_minutes(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumn("t", grid.moment(F.floor(grid.seconds(F.col("datetime")) / 300) * 300))
    return r.groupBy(F.col("t").alias("datetime")).agg(F.min_by("value", "row_seq").alias("value"), F.min_by("source_file", "row_seq").alias("source_file"), F.bool_or(F.col("row_seq") % 7 == 0).alias("conflict")).withColumns({"series": F.lit(kind), "kind": F.lit(kind)})


@query(" UNION ALL ".join(f"SELECT * FROM ({_bin_sql(k, a)})" for k, a in (("accumulated", "sum"), ("maximum", "max"), ("minimum", "min"))))
def bin_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _five_minutes(spark, sf_dir, "accumulated").unionByName(_five_minutes(spark, sf_dir, "maximum")).unionByName(_five_minutes(spark, sf_dir, "minimum"))
    rows, _ = grid.align_to_grid(r, ["series"])
    return rows.select("series", ntz("datetime"), r6("value"), "source_file", "conflict")


_COVERED = """c AS (SELECT event_type AS series, CAST(user_id AS VARCHAR) AS device_serial, to_timestamp(floor(epoch(ts) / 900) * 900) AT TIME ZONE 'UTC' AS datetime, min_by(CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END, event_id) AS value,
  min_by('f' || event_id % 3, event_id) AS source_file, bool_or(event_id % 7 = 0) AS conflict FROM events GROUP BY ALL),
b AS (SELECT *, min(datetime) OVER (PARTITION BY series, device_serial) AS began FROM c),
d AS (SELECT *, row_number() OVER (PARTITION BY series, datetime ORDER BY began DESC, device_serial DESC) AS n, count(*) OVER (PARTITION BY series, datetime) AS claims FROM b)"""


def _covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumn("datetime", grid.moment(F.floor(grid.seconds(F.col("datetime")) / 900) * 900))
    value = F.struct("row_seq", F.when(F.col("row_seq") % 11 != 0, F.col("value")).alias("v"))
    return r.groupBy("series", "device_serial", "datetime").agg(F.min(value).alias("x"), F.min_by("source_file", "row_seq").alias("source_file"), F.bool_or(F.col("row_seq") % 7 == 0).alias("conflict")).select("series", "device_serial", "datetime", F.col("x.v").alias("value"), "source_file", "conflict")


# DuckDB's min_by skips nulls, so the covered value is taken by arg_min over a list there
_COVERED = _COVERED.replace("min_by(CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END, event_id)", "list_extract(list(CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END ORDER BY event_id), 1)")


@query(f"WITH {_COVERED} SELECT series, device_serial, datetime, value, source_file, conflict, claims FROM d WHERE n = 1")
def resolve_double_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.resolve_double_cover(_covered(spark, sf_dir), ["series"]).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


_STINTS = f"""WITH {_COVERED}, s AS (SELECT series, min(datetime) AS a, max(datetime) AS b FROM d GROUP BY series), g AS (SELECT series, unnest(generate_series(a, b, INTERVAL 15 MINUTE)) AS datetime FROM s),
l AS (SELECT g.series, g.datetime, d.value, CASE WHEN d.value IS NOT NULL THEN 'observed' ELSE 'missing' END AS flag, d.device_serial, d.source_file, coalesce(d.conflict, false) AS conflict FROM g LEFT JOIN d ON g.series = d.series AND g.datetime = d.datetime AND d.n = 1)"""


@query(_STINTS + " SELECT * FROM l")
def lay_stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.lay_stints(_covered(spark, sf_dir), ["series"]).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@query(_STINTS + " SELECT series, CAST(year(datetime - INTERVAL 4 HOUR) AS INTEGER) AS year, count(*) AS rows, count(*) FILTER (flag = 'observed') AS observed, min(datetime) AS first, max(datetime) AS last FROM l GROUP BY ALL")
def split_local_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = grid.split_local_year(grid.lay_stints(_covered(spark, sf_dir), ["series"]), parsing.PROJECT_ZONE)
    out = s.groupBy("series", "year").agg(F.count("*").alias("rows"), F.count_if(F.col("flag") == "observed").alias("observed"), F.min("datetime").alias("first"), F.max("datetime").alias("last"))
    return out.withColumns({"first": F.col("first").cast("timestamp_ntz"), "last": F.col("last").cast("timestamp_ntz")})


_REGULAR = """r AS (SELECT event_type || '/' || user_id % 10 AS series, epoch_us(ts) / 1e6 AS t, value AS v FROM events),
s AS (SELECT series, round_even(min(t) / 3600, 0) * 3600 AS a, max(t) AS b FROM r GROUP BY series),
g AS (SELECT series, a, unnest(generate_series(0, CAST(floor((b - a) / 3600) AS BIGINT))) AS k FROM s),
p AS (SELECT r.series, round_even((t - a) / 3600, 0) AS k, max_by(v, t) AS value FROM r JOIN s USING (series) GROUP BY ALL),
reg AS (SELECT g.series, make_timestamp(CAST((a + g.k * 3600) * 1000000 AS BIGINT)) AS datetime, value, CASE WHEN value IS NOT NULL THEN 'observed' ELSE 'missing' END AS flag FROM g LEFT JOIN p ON g.series = p.series AND g.k = p.k)"""


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumn("series", F.concat("series", F.lit("/"), F.col("device_serial").cast("long") % 10))
    return grid.regularise(r, ["series"], 60, ["row_seq"])


@query(f"WITH {_REGULAR} SELECT * FROM reg")
def regularise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hourly(spark, sf_dir).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


@query(f"""WITH {_REGULAR}, m AS (SELECT *, sum(CASE WHEN flag = 'observed' THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY datetime) AS run FROM reg)
SELECT series, min(datetime) AS starts, max(datetime) AS ends, count(*) AS n, count(*) * 60.0::DOUBLE AS minutes FROM m WHERE flag = 'missing' GROUP BY series, run""")
def find_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid.find_gaps(_hourly(spark, sf_dir), ["series"], 60)
    return g.withColumns({"starts": F.col("starts").cast("timestamp_ntz"), "ends": F.col("ends").cast("timestamp_ntz")})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean quarter-hour series from overlapping downloads: dedupe, align, lay stints; gaps are rows."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    clean = dedupe.dedupe_latest_wins(event_readings(spark, sf_dir)).withColumn("kind", F.lit("instantaneous"))
    rows, _ = grid.align_to_grid(clean, ["series", "device_serial"])
    return grid.lay_stints(rows, ["series"]).select("series", "datetime", "value", "flag")
