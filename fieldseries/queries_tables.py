"""Registered queries on tables: mapping, unattributed readings, manifests, differences, rules, monitoring, changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import event_readings, instant, item_readings, order_deployments, table
from .operators import changes, diff, mapping, monitor, quality, survey, unattributed, windows
from .plans import products
from .queries import _WINDOWS, ntz, query, r6
from .streaming import landing

# --- mapping ------------------------------------------------------------------------------------

_REGISTRY = """reg AS (SELECT * FROM (VALUES ('s0', 'click', 'reading', true, 'clicks', 'm', 'instantaneous', false, 'ft'), ('s0', '', 'reading', true, 'other', 'm', 'instantaneous', false, 'm'),
  ('s1', 'view', 'reading', true, 'views', 'degC', 'instantaneous', true, 'degF'), ('s1', 'purchase', 'reading', false, NULL, NULL, NULL, NULL, NULL)) AS t(source, sensor, measurement, keep, variable, unit, kind, depth, source_unit))"""
_REG_ROWS = [("s0", "click", "reading", True, "clicks", "m", "instantaneous", False, "ft"), ("s0", "", "reading", True, "other", "m", "instantaneous", False, "m"), ("s1", "view", "reading", True, "views", "degC", "instantaneous", True, "degF"), ("s1", "purchase", "reading", False, None, None, None, None, None)]
_RAW = f"WITH {_REGISTRY}, r AS (SELECT event_id, 's' || event_id % 2 AS source, event_type AS sensor, 'reading' AS measurement, value, CAST(event_id % 5 AS INTEGER) AS error_code FROM events), j AS (SELECT r.*, coalesce(e.keep, d.keep) AS keep, coalesce(e.variable, d.variable) AS variable, CASE WHEN e.source IS NOT NULL THEN e.source_unit ELSE d.source_unit END AS su, CASE WHEN e.source IS NOT NULL THEN e.unit ELSE d.unit END AS unit, e.source IS NOT NULL OR d.source IS NOT NULL AS known FROM r LEFT JOIN reg e ON r.source = e.source AND r.sensor = e.sensor AND r.measurement = e.measurement LEFT JOIN (SELECT * FROM reg WHERE sensor = '') d ON r.source = d.source AND r.measurement = d.measurement)"


def _registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_REG_ROWS, "source string, sensor string, measurement string, keep boolean, variable string, unit string, kind string, depth boolean, source_unit string")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.concat(F.lit("s"), F.col("event_id") % 2).alias("source"), F.col("event_type").alias("sensor"), F.lit("reading").alias("measurement"), F.lit("").alias("unit"), "value", (F.col("event_id") % 5).cast("int").alias("error_code"))


@query(_RAW + " SELECT event_id, variable, unit, round(CASE WHEN error_code = 0 THEN CASE su WHEN 'ft' THEN value * 0.3048 WHEN 'degF' THEN (value - 32) * 5 / 9 ELSE value END END, 6) AS value FROM j WHERE known AND keep")
def map_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.map_measurements(_raw(spark, sf_dir), _registry(spark)).select("event_id", "variable", "unit", r6("value"))


@query(_RAW + " SELECT source, sensor, measurement, count(*) AS rows FROM j WHERE NOT known GROUP BY ALL")
def count_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mapping.count_unmapped(_raw(spark, sf_dir), _registry(spark))


@query("""WITH k AS (SELECT DISTINCT substr(p_name, 1, 4 + p_partkey % 6) AS name FROM part WHERE p_partkey % 3 = 0)
SELECT p_partkey, coalesce((SELECT max_by(name, (length(name), name)) FROM k WHERE starts_with(lower(p_name), lower(name))), p_name) AS canonical FROM part""")
def longest_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    known = p.filter("p_partkey % 3 = 0").select(F.expr("substr(p_name, 1, int(4 + p_partkey % 6))").alias("name")).distinct()
    return mapping.longest_prefix_join(p, known, "p_name").select("p_partkey", "canonical")


# --- unattributed ----------------------------------------------------------------------------------

_KNOWN = """kn AS (SELECT user_id AS device_serial, CAST(CASE WHEN user_id % 2 = 0 THEN user_id % 6 + 1 END AS INTEGER) AS port, TIMESTAMP '2024-01-05' + user_id % 7 * INTERVAL 1 DAY AS f, CASE WHEN user_id % 3 <> 0 THEN TIMESTAMP '2024-01-15' + user_id % 7 * INTERVAL 1 DAY END AS t, 'known ' || user_id % 4 AS reason FROM (SELECT DISTINCT user_id FROM events) WHERE user_id % 2 = 0 OR user_id % 5 = 0),
e AS (SELECT *, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 + 1 AS INTEGER) AS port FROM events),
st AS (SELECT user_id, min(ts) + INTERVAL 10 DAY AS starts FROM events GROUP BY user_id),
cl AS (SELECT e.event_id, e.user_id, e.ts, e.port, e.event_type, kn.reason, CASE WHEN kn.reason IS NOT NULL THEN 'known' WHEN e.ts >= starts - INTERVAL 7 DAY AND e.ts <= starts + INTERVAL 24 HOUR THEN 'installation' ELSE 'unexplained' END AS category
  FROM e JOIN st ON e.user_id = st.user_id LEFT JOIN kn ON kn.device_serial = e.user_id AND (kn.port IS NULL OR kn.port = e.port) AND kn.f <= e.ts AND (kn.t IS NULL OR e.ts < kn.t))"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumn("variable", F.col("series"))
    users = r.select(F.col("device_serial").cast("long").alias("u")).distinct()
    day = lambda d: F.lit(d).cast("timestamp") + F.make_dt_interval(days=(F.col("u") % 7).cast("int"))
    known = users.filter("u % 2 = 0 or u % 5 = 0").select(
        F.lit(1).alias("rank"), F.col("u").cast("string").alias("device_serial"), F.when(F.col("u") % 2 == 0, (F.col("u") % 6 + 1).cast("int")).alias("port"), day("2024-01-05").alias("from"), F.when(F.col("u") % 3 != 0, day("2024-01-15")).alias("to"), F.concat(F.lit("known "), F.col("u") % 4).alias("reason")
    )
    starts = r.groupBy("device_serial").agg((F.min("datetime") + F.expr("interval 10 days")).alias("starts"))
    return unattributed.classify_unattributed(r, starts, known)


@query(f"WITH {_KNOWN} SELECT event_id, category, reason FROM cl")
def classify_unattributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select(F.col("row_seq").alias("event_id"), "category", "reason")


@query(f"""WITH {_KNOWN}, g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY category, user_id ORDER BY ts) > INTERVAL 1 DAY THEN 1 ELSE 0 END AS n FROM cl), s AS (SELECT *, sum(n) OVER (PARTITION BY category, user_id ORDER BY ts) + 1 AS episode FROM g),
p AS (SELECT DISTINCT category, user_id, episode, port FROM s), q AS (SELECT *, port - row_number() OVER (PARTITION BY category, user_id, episode ORDER BY port) AS i FROM p),
x AS (SELECT category, user_id, episode, i, min(port) AS a, max(port) AS b FROM q GROUP BY ALL), y AS (SELECT category, user_id, episode, string_agg(CASE WHEN a = b THEN CAST(a AS VARCHAR) ELSE a || '-' || b END, ', ' ORDER BY a) AS ports FROM x GROUP BY ALL)
SELECT s.category, CAST(s.user_id AS VARCHAR) AS device_serial, CAST(s.episode AS BIGINT) AS episode, any_value(ports) AS ports, min(ts) AS first, max(ts) AS last, count(DISTINCT ts) AS moments, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS variables
FROM s JOIN y ON s.category = y.category AND s.user_id = y.user_id AND s.episode = y.episode GROUP BY s.category, s.user_id, s.episode""")
def unattributed_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = unattributed.unattributed_episodes(_classified(spark, sf_dir), 86400)
    return u.withColumns({"first": F.col("first").cast("timestamp_ntz"), "last": F.col("last").cast("timestamp_ntz")})


# --- manifests and differences ------------------------------------------------------------------------

_NEW = "n AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 0 THEN 'X' WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 19 <> 0 UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 23 = 0)"


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    k = F.col("o_orderkey")
    new = o.filter(k % 19 != 0).withColumns({"o_orderstatus": F.when(k % 11 == 0, "X").when(k % 13 == 0, None).otherwise(F.col("o_orderstatus")), "o_totalprice": F.when(k % 17 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))})
    return o, new.unionByName(o.filter(k % 23 == 0).withColumn("o_orderkey", k + 1_000_000_000))


@query(f"""WITH {_NEW} SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'added' WHEN n.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM orders o FULL JOIN n ON o.o_orderkey = n.o_orderkey WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_totalprice IS DISTINCT FROM n.o_totalprice""")
def changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return diff.changed_rows(old, new, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])


@query(f"""WITH {_NEW}, j AS (SELECT o.o_orderkey, o.o_orderstatus AS a, n.o_orderstatus AS b, o.o_custkey AS c, n.o_custkey AS d FROM orders o JOIN n USING (o_orderkey))
SELECT 'o_orderstatus' AS column, count(*) FILTER (a IS DISTINCT FROM b) AS cells, min_by(coalesce(a, 'NULL') || ' -> ' || coalesce(b, 'NULL'), o_orderkey) FILTER (a IS DISTINCT FROM b) AS example FROM j
UNION ALL SELECT 'o_custkey', count(*) FILTER (c IS DISTINCT FROM d), min_by(c || ' -> ' || d, o_orderkey) FILTER (c IS DISTINCT FROM d) FROM j""")
def table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return diff.table_diff(old, new, ["o_orderkey"], ["o_orderstatus", "o_custkey"])


_HASH = "md5(coalesce(length(CAST({0}o_custkey AS VARCHAR)) || ':' || {0}o_custkey, '-') || coalesce(length({0}o_orderstatus) || ':' || {0}o_orderstatus, '-'))"


@query(f"""WITH {_NEW}, h AS (SELECT o_custkey % 50 AS g, {_HASH.format('')} AS h FROM n)
SELECT g, count(*) AS rows, sum(CAST('0x' || substr(h, 1, 15) AS BIGINT))::VARCHAR || '-' || sum(CAST('0x' || substr(h, 16, 15) AS BIGINT))::VARCHAR AS fingerprint FROM h GROUP BY g""")
def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = _snapshots(spark, sf_dir)[1].withColumn("g", F.col("o_custkey") % 50)
    return diff.content_fingerprint(new, ["g"], ["o_custkey", "o_orderstatus"])


@query(f"""WITH {_NEW}, b AS (SELECT o_custkey AS k, sum(CAST(round(o_totalprice) AS BIGINT)) AS content, count(*) AS inputs, min(o_orderkey) % 3 AS built FROM orders GROUP BY 1), a AS (SELECT o_custkey AS k, sum(CAST(round(o_totalprice) AS BIGINT)) AS content, count(*) AS inputs, min(o_orderkey) % 3 AS built FROM n WHERE o_custkey % 29 <> 0 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'gone' WHEN b.k IS NULL THEN 'new' WHEN a.content = b.content THEN 'identical' WHEN a.built = b.built THEN 'not rebuilt' WHEN a.inputs <> b.inputs THEN 'inputs changed' ELSE 'different with the same inputs' END AS verdict FROM b FULL JOIN a ON a.k = b.k""")
def manifest_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = lambda d: d.groupBy(F.col("o_custkey").alias("k")).agg(F.sum(F.round("o_totalprice").cast("bigint")).alias("content"), F.count("*").alias("inputs"), (F.min("o_orderkey") % 3).alias("built"))
    old, new = _snapshots(spark, sf_dir)
    return diff.manifest_compare(m(old), m(new.filter("o_custkey % 29 <> 0")), ["k"])


@query(f"WITH {_NEW} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM n UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n)")
def upsert_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    old, new = _snapshots(spark, sf_dir)
    return diff.upsert(old, new, ["o_orderkey"])


@query("""WITH w AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority ORDER BY o_orderpriority) AS i, count(*) AS f FROM orders WHERE o_custkey % 13 <> 0 GROUP BY 1),
m AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority ORDER BY o_orderpriority) AS i, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE count(*) END AS f, CASE WHEN o_custkey % 5 = 0 THEN '0' ELSE '1' END AS v FROM orders WHERE o_orderkey % 4 <> 0 AND o_custkey % 11 <> 0 GROUP BY o_custkey)
SELECT * FROM (SELECT coalesce(w.k, m.k) AS k, CASE WHEN w.k IS NULL THEN 'inputs no longer make it' WHEN m.k IS NULL THEN 'not built' WHEN m.f IS NULL THEN 'no fingerprint' WHEN len([x FOR x IN w.i IF NOT list_contains(m.i, x)]) > 0 THEN len([x FOR x IN w.i IF NOT list_contains(m.i, x)]) || ' new inputs' WHEN w.f <> m.f THEN 'metadata changed' WHEN m.v <> '1' THEN 'logic changed' END AS reason FROM w FULL JOIN m ON w.k = m.k) WHERE reason IS NOT NULL""")
def stale_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("k", F.col("o_custkey"))
    inputs = F.array_sort(F.collect_set("o_orderpriority")).alias("inputs")
    wanted = o.filter("k % 13 <> 0").groupBy("k").agg(inputs, F.count("*").alias("fingerprint"))
    built = o.filter("o_orderkey % 4 <> 0 and k % 11 <> 0").groupBy("k").agg(inputs, F.count("*").alias("n"))
    built = built.select("k", "inputs", F.when(F.col("k") % 7 != 0, F.col("n")).alias("fingerprint"), F.when(F.col("k") % 5 == 0, "0").otherwise("1").alias("logic_version"))
    return products.stale_partitions(wanted, built, ["k"])


@query("SELECT a.o_orderkey AS id, b.o_orderkey AS file, b.o_orderdate AS s, b.o_orderdate + b.o_orderkey % 60 * INTERVAL 1 DAY AS e FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND a.o_orderkey % 10 = 0 AND b.o_orderkey % 10 <> 0 AND b.o_orderdate <= a.o_orderdate + INTERVAL 30 DAY AND b.o_orderdate + b.o_orderkey % 60 * INTERVAL 1 DAY >= a.o_orderdate")
def overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file"), F.col("o_custkey").alias("device_serial"), instant("o_orderdate").alias("s"))
    files = o.filter("file % 10 <> 0").withColumn("e", F.col("s") + F.make_dt_interval(days=(F.col("file") % 60).cast("int")))
    new = o.filter("file % 10 = 0").select(F.col("file").alias("id"), "device_serial", "s", (F.col("s") + F.expr("interval 30 days")).alias("e"))
    return diff.overlaps(files, new).select("id", "file", ntz("s"), ntz("e"))


@query("""SELECT event_type AS station_id, 'f' || event_id % 3 AS file, count(*) AS rows, count(DISTINCT ts) AS stamps, CAST(CAST(min(ts) - INTERVAL 4 HOUR AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(ts) - INTERVAL 4 HOUR AS DATE) AS VARCHAR) AS last_day, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def profile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.profile_files(event_readings(spark, sf_dir), ["series", "source_file"]).select(F.col("series").alias("station_id"), F.col("source_file").alias("file"), "rows", "stamps", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"), F.round("total", 4).alias("total"))


@query("""WITH f AS (SELECT user_id, 'f' || event_id % 3 || '/' || day(ts) AS file, min(ts) AS a, max(ts) AS b, count(*) AS n FROM events GROUP BY ALL), g AS (SELECT *, lag(b) OVER (PARTITION BY user_id ORDER BY a, file) AS p FROM f)
SELECT CAST(user_id AS VARCHAR) AS device_serial, count(*) AS files, CAST(sum(n) AS BIGINT) AS readings, min(a) AS first, max(b) AS last, count(*) FILTER (a - p > INTERVAL 12 HOUR) AS gaps FROM g GROUP BY user_id""")
def device_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumn("source_file", F.concat("source_file", F.lit("/"), F.day("datetime")))
    c = monitor.device_coverage(r)
    return c.withColumns({"first": F.col("first").cast("timestamp_ntz"), "last": F.col("last").cast("timestamp_ntz")})


@query("""WITH f AS (SELECT user_id, 'f' || event_id % 3 || '/' || day(ts) AS file, min(ts) AS a, max(ts) AS b FROM events GROUP BY ALL), g AS (SELECT *, lag(b) OVER w AS p, lag(file) OVER w AS q FROM f WINDOW w AS (PARTITION BY user_id ORDER BY a, file))
SELECT CAST(user_id AS VARCHAR) AS device_serial, q AS after_file, p AS ends, file AS before_file, a AS starts, round((epoch_us(a) - epoch_us(p)) / 3600000000.0, 4) AS hours FROM g WHERE a - p > INTERVAL 12 HOUR""")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = event_readings(spark, sf_dir).withColumn("source_file", F.concat("source_file", F.lit("/"), F.day("datetime")))
    return monitor.coverage_gaps(r).select("device_serial", "after_file", ntz("ends"), "before_file", ntz("starts"), "hours")


# --- rules and monitoring ----------------------------------------------------------------------------------

_RULES = """WITH v AS (
SELECT 'DUPLICATE_LINES' AS rule, l_orderkey || '|' || l_linenumber AS key FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'MULTIPLE_ACTIVE_SERIAL_SAME_TYPE', o_custkey || '|' || lower(o_orderpriority) FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'NEGATIVE_BALANCE', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'ORPHAN_ITEM', CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 31 <> 0)
UNION ALL SELECT 'INVALID_STATUS', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'NEVER', CAST(p_partkey AS VARCHAR) FROM part WHERE p_size < 0)"""


def _rules(spark: SparkSession, sf_dir: str) -> list[quality.Rule]:
    t = lambda n: table(spark, sf_dir, n)
    d = order_deployments(spark, sf_dir)
    return [
        quality.duplicates("DUPLICATE_LINES", "lineitem", t("lineitem"), ["l_orderkey", "l_linenumber"]),
        quality.duplicates("MULTIPLE_ACTIVE_SERIAL_SAME_TYPE", "orders", windows.active_rows(d), ["device_serial", "station_type"]),
        quality.where("NEGATIVE_BALANCE", "customer", t("customer"), F.col("c_custkey"), F.col("c_acctbal") < 0, F.col("c_acctbal")),
        quality.orphans("ORPHAN_ITEM", "lineitem", t("lineitem"), "l_orderkey", t("orders").filter("o_orderkey % 31 <> 0"), "o_orderkey"),
        quality.where("INVALID_STATUS", "orders", t("orders"), F.col("o_orderkey"), ~F.col("o_orderstatus").isin("F", "O"), F.col("o_orderstatus")),
        quality.where("NEVER", "part", t("part"), F.col("p_partkey"), F.col("p_size") < 0, F.col("p_size")),
    ]


@query(_RULES + " SELECT r.rule, count(v.rule) AS n, count(v.rule) = 0 AS passed FROM (VALUES ('DUPLICATE_LINES'), ('MULTIPLE_ACTIVE_SERIAL_SAME_TYPE'), ('NEGATIVE_BALANCE'), ('ORPHAN_ITEM'), ('INVALID_STATUS'), ('NEVER')) r(rule) LEFT JOIN v ON r.rule = v.rule GROUP BY r.rule")
def run_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_summary(_rules(spark, sf_dir))


@query(_RULES + " SELECT rule, key FROM v")
def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.violations(_rules(spark, sf_dir)).select("rule", "key")


@query("""WITH d AS (SELECT o_custkey, max(o_orderdate) AS last, bool_and(o_orderstatus = 'F') AS gone, min_by(o_orderkey % 100, o_orderkey) AS battery FROM orders GROUP BY 1)
SELECT CAST(o_custkey AS VARCHAR) AS device_serial, 'silent' AS issue, CASE WHEN TIMESTAMP '2001-08-01' - last > INTERVAL 365 DAY THEN 'high' ELSE 'medium' END AS severity FROM d WHERE NOT gone AND TIMESTAMP '2001-08-01' - last > INTERVAL 120 DAY
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'low battery', CASE WHEN battery < 15 THEN 'high' ELSE 'medium' END FROM d WHERE NOT gone AND battery < 25
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'unknown reporter', 'medium' FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)""")
def device_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = o.groupBy(F.col("o_custkey").alias("device_serial")).agg(F.max(instant("o_orderdate")).alias("last_record"), F.bool_and(F.col("o_orderstatus") == "F").alias("gone"), F.min_by(F.col("o_orderkey") % 100, "o_orderkey").alias("battery"))
    live = d.filter("not gone")
    known = table(spark, sf_dir, "customer").filter("c_custkey % 10 <> 0").select(F.col("c_custkey").alias("device_serial"))
    return monitor.device_findings(live, d.select("device_serial"), known, "2001-08-01", medium_hours=120 * 24, high_hours=365 * 24)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS device_serial, coalesce(m.held + INTERVAL 1 SECOND, CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '1996-01-01' END, TIMESTAMP '1995-01-01') AS start, least(CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '1999-06-01' ELSE TIMESTAMP '2001-01-01' END, TIMESTAMP '2000-06-01') AS end
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS held FROM orders GROUP BY 1) m ON c_custkey = o_custkey WHERE m.held IS NULL OR CASE WHEN c_custkey % 3 = 0 THEN TIMESTAMP '1999-06-01' ELSE TIMESTAMP '2001-01-01' END > m.held""")
def download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    at = lambda t: F.lit(t).cast("timestamp")
    devices = table(spark, sf_dir, "customer").select(k.cast("string").alias("device_serial"), at("1995-01-01").alias("first_measurement"), F.when(k % 3 == 0, at("1999-06-01")).otherwise(at("2001-01-01")).alias("last_measurement"), F.when(k % 2 == 0, at("1996-01-01")).alias("backfill_from"))
    held = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("device_serial"), instant("o_orderdate").alias("datetime"))
    return landing.download_plan(devices, held, "2000-06-01").select("device_serial", ntz("start"), ntz("end"))


@query("""WITH f AS (SELECT user_id, max_by(value, ts) FILTER (event_type = 'click') AS battery, max(ts) AS last FROM events GROUP BY 1)
SELECT o_orderkey AS unique_id, CASE WHEN o_orderstatus <> 'F' THEN round(f.battery, 6) END AS battery, CASE WHEN o_orderstatus <> 'F' THEN f.last END AS last_record FROM orders LEFT JOIN f ON o_custkey = f.user_id""")
def latest_fact_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = order_deployments(spark, sf_dir).withColumn("device_serial", F.col("device_serial").cast("string"))
    out = monitor.latest_fact_join(d, event_readings(spark, sf_dir), F.col("series") == "click")
    return out.select("unique_id", r6("battery"), ntz("last_record"))


@query(f"""WITH a AS (SELECT 'st' || o_orderkey % 100 AS station_id, o_custkey, o_orderdate FROM orders WHERE o_orderstatus <> 'F')
SELECT station_id, count(*) AS live_rows, count(DISTINCT o_custkey) AS devices, max(o_orderdate) AS last_deploy FROM a GROUP BY 1""")
def station_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitor.station_counts(order_deployments(spark, sf_dir)).select("station_id", "live_rows", "devices", ntz("last_deploy"))


@query("SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-01-01') AS INTEGER) AS age_days, CASE o_orderkey % 3 WHEN 0 THEN 'on the device' WHEN 1 THEN 'not renamed' ELSE 'unknown stage' END AS label, date_diff('day', CAST(o_orderdate AS DATE), DATE '1998-01-01') > 14 AS stale FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'")
def pending_ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    p = o.select("o_orderkey", F.col("o_orderdate").alias("created"), F.when(F.col("o_orderkey") % 3 == 0, "awaiting_offload").when(F.col("o_orderkey") % 3 == 1, "awaiting_rename").otherwise("odd").alias("stage"))
    return monitor.pending_ages(p, "1998-01-01").select("o_orderkey", "age_days", "label", "stale")


# --- changes --------------------------------------------------------------------------------------------------

_CONFIG = "c0 AS (SELECT o_custkey AS sn, o_orderkey % 3 AS port, o_orderdate AS t, max(o_orderkey) AS k FROM orders GROUP BY ALL), c AS (SELECT sn, port, t, CASE WHEN k % 4 = 0 THEN 'none' ELSE 's' || k % 4 END AS sensor, 'vwc' AS type, CAST(k % 2 * 10 AS DOUBLE) AS depth, 'ok' AS status FROM c0)"


@query(f"""WITH {_CONFIG}, l AS (SELECT *, lag(sensor) OVER w AS s0, lag(depth) OVER w AS d0 FROM c WINDOW w AS (PARTITION BY sn, port ORDER BY t)),
k AS (SELECT * FROM l WHERE (s0 IS NULL OR sensor <> s0 OR abs(depth - d0) > 0.01) AND NOT (sensor = 'none' AND coalesce(s0, 'none') = 'none'))
SELECT sn, port, sensor, depth AS depth_cm, t AS valid_from, lead(t) OVER (PARTITION BY sn, port ORDER BY t) AS valid_to FROM k""")
def scd2_apply_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("sn"), (F.col("o_orderkey") % 3).alias("port"), instant("o_orderdate").alias("change_time")).agg(F.max("o_orderkey").alias("k"))
    c = o.select("sn", "port", "change_time", F.when(F.col("k") % 4 == 0, "none").otherwise(F.concat(F.lit("s"), F.col("k") % 4)).alias("sensor"), F.lit("vwc").alias("type"), (F.col("k") % 2 * 10).cast("double").alias("depth_cm"), F.lit("ok").alias("status"))
    return changes.scd2_apply_configs(c).select("sn", "port", "sensor", "depth_cm", ntz("valid_from"), ntz("valid_to"))


@query("""SELECT o_orderkey AS unique_id, CASE WHEN r THEN 'removed' WHEN o_orderstatus = 'F' THEN 'removed' ELSE 'online' END AS status, CAST(CASE WHEN r THEN DATE '2002-01-01' ELSE CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS DATE) END AS VARCHAR) AS last_visit FROM (SELECT *, o_orderkey % 9 = 0 AS r FROM orders)""")
def retire_deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = order_deployments(spark, sf_dir)
    gone = d.filter("unique_id % 9 = 0").select("unique_id", F.lit("2002-01-01 10:00:00").cast("timestamp").alias("at"))
    return changes.retire_deployments(d, gone).select("unique_id", "status", F.col("last_visit").cast("string").alias("last_visit"))


@query("""WITH d AS (SELECT o_orderkey AS unique_id, 'st' || o_orderkey % 100 AS station_id, o_orderdate AS deploy_datetime, CASE WHEN o_orderstatus = 'F' THEN 'removed' ELSE 'online' END AS status FROM orders)
SELECT unique_id, station_id, deploy_datetime, CASE WHEN status = 'online' AND CAST(substr(station_id, 3) AS INTEGER) % 10 = 0 THEN 'relocated' ELSE status END AS status FROM d
UNION ALL SELECT unique_id + 1000000000, station_id || '_b', TIMESTAMP '2002-01-01', status FROM d WHERE status = 'online' AND CAST(substr(station_id, 3) AS INTEGER) % 10 = 0""")
def supersede_deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = order_deployments(spark, sf_dir)
    moves = d.select("station_id").distinct().filter("cast(substr(station_id, 3) as int) % 10 = 0").select("station_id", F.concat("station_id", F.lit("_b")).alias("new_station_id"), F.lit("2002-01-01").cast("timestamp").alias("at"), F.lit(1_000_000_000).cast("bigint").alias("id_offset"))
    return changes.supersede_deployments(d, moves, {}).select("unique_id", "station_id", ntz("deploy_datetime"), "status")


@query("""WITH u AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'defunct' END AS s FROM customer WHERE c_custkey % 5 = 0)
SELECT o_orderkey AS unique_id, CASE WHEN o_orderstatus = 'F' THEN 'removed' ELSE coalesce(u.s, 'online') END AS status FROM orders LEFT JOIN u ON o_custkey = c_custkey""")
def update_active_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = table(spark, sf_dir, "customer").filter("c_custkey % 5 = 0").select(F.col("c_custkey").alias("device_serial"), F.when(F.col("c_custkey") % 2 == 0, "defunct").alias("status"))
    return changes.update_active_rows(order_deployments(spark, sf_dir), u, ["device_serial"], ["status"]).select("unique_id", "status")


@query("SELECT o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n > 1")
def delete_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.delete_latest(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_orderkey")


# --- survey -----------------------------------------------------------------------------------------------------

@query("""WITH f AS (SELECT l_orderkey AS pair, l_linenumber AS setup, min(l_quantity) / 100 AS fall FROM lineitem GROUP BY ALL), n AS (SELECT pair, count(*) AS n, min(setup) AS one, min_by(fall, setup) AS fall FROM f GROUP BY pair),
p AS (SELECT a.pair, a.setup AS a, b.setup AS b, (a.fall + b.fall) / 2 AS mean, round(abs(a.fall - b.fall), 6) AS diff, row_number() OVER (PARTITION BY a.pair ORDER BY round(abs(a.fall - b.fall), 6), a.setup, b.setup) AS k FROM f a JOIN f b ON a.pair = b.pair AND a.setup < b.setup)
SELECT n.pair, CASE WHEN n = 1 THEN one ELSE a END AS setup_a, b AS setup_b, round(CASE WHEN n = 1 THEN n.fall WHEN diff <= 0.01 THEN mean END, 6) AS fall, CASE WHEN n > 1 THEN diff <= 0.01 END AS agrees, round(abs(CASE WHEN n = 1 THEN n.fall WHEN diff <= 0.01 THEN mean END) / 24.16, 6) AS slope FROM n LEFT JOIN p ON n.pair = p.pair AND k = 1""")
def closest_pair_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pair"), F.col("l_linenumber").alias("setup")).agg((F.min("l_quantity") / 100).alias("fall"))
    s = survey.select_agreeing_pair(f)
    return s.select("pair", "setup_a", "setup_b", r6("fall"), "agrees", F.round(survey.slope(F.col("fall"), F.lit(24.16)), 6).alias("slope"))


@query("SELECT o_orderkey, round((o_totalprice / 1000 + 0.1) - (o_custkey / 100.0 + o_shippriority), 6) AS fall FROM (SELECT *, 0.25 AS o_shippriority FROM orders)")
def compute_falls(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.round(survey.fall(F.col("o_custkey") / 100, F.col("o_totalprice") / 1000, F.lit(0.25), F.lit(0.1)), 6).alias("fall"))


@query(f"WITH {_WINDOWS}, y AS (SELECT unnest(generate_series(1995, 2001)) AS year), s AS (SELECT o_custkey AS d, min(year(l_shipdate)) AS a, max(year(l_shipdate)) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) SELECT DISTINCT w.station_id, CAST(y.year AS INTEGER) AS year FROM w JOIN s ON w.device_serial = s.d JOIN y ON year(starts - INTERVAL 4 HOUR) <= y.year AND (ends IS NULL OR year(ends - INTERVAL 4 HOUR) >= y.year) AND s.a <= y.year AND s.b >= y.year")
def years_to_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = windows.deployment_windows(order_deployments(spark, sf_dir))
    spans = item_readings(spark, sf_dir).groupBy("device_serial").agg(F.min(F.year("datetime")).alias("a"), F.max(F.year("datetime")).alias("b"))
    return monitor.years_to_build(w, spans, 1995, 2001)
