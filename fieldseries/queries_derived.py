"""Queries of derived series: pairing, level, flags, chained surveys, statuses and requests for products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import instant, table
from .operators import decisions, derived, status, survey
from .plans import products
from .queries import ntz, query, r6
from .sources import scratch

# Gauges are customers modulo 40 and sources customers modulo 6, read on the day of an order; suppliers declare pairings.
_PRESSURE = "g AS (SELECT 'g' || o_custkey % 40 AS station_id, o_orderdate AS datetime, min(100 + o_totalprice / 100000) AS value, CAST(2 + o_custkey % 40 % 3 AS INTEGER) AS product FROM orders GROUP BY ALL)"
_AIR = "b AS (SELECT 'w' || o_custkey % 6 AS baro_source, o_orderdate AS datetime, min(CASE WHEN o_orderkey % 3 = 0 THEN 95 + o_totalprice / 200000 END) AS value FROM orders GROUP BY ALL)"
_PAIRS = "p AS (SELECT 'g' || s_suppkey % 40 AS station_id, 'w' || s_suppkey // 7 % 6 AS baro_source, s_suppkey AS priority, TIMESTAMP '1995-01-01' + s_suppkey % 900 * INTERVAL 1 DAY AS valid_from, CASE WHEN s_suppkey % 3 <> 0 THEN TIMESTAMP '1995-01-01' + (s_suppkey % 900 + 500) * INTERVAL 1 DAY END AS valid_to FROM supplier WHERE s_suppkey % 40 % 2 = s_suppkey // 7 % 6 % 2)"
_PAIRED = f"""{_PRESSURE}, {_AIR}, {_PAIRS},
c AS (SELECT g.*, p.baro_source, p.priority, b.value AS baro_value, min(p.priority) OVER (PARTITION BY g.station_id, g.datetime) AS best FROM g LEFT JOIN p ON g.station_id = p.station_id AND p.valid_from <= g.datetime AND (p.valid_to IS NULL OR g.datetime < p.valid_to) LEFT JOIN b ON p.baro_source = b.baro_source AND g.datetime = b.datetime),
n AS (SELECT *, row_number() OVER (PARTITION BY station_id, datetime ORDER BY baro_value IS NULL, priority) AS k FROM c),
x AS (SELECT station_id, datetime, value, product, CASE WHEN baro_value IS NOT NULL THEN baro_source END AS baro_source, baro_value, CASE WHEN baro_value IS NOT NULL THEN priority > best END AS substituted FROM n WHERE k = 1)"""


def _pressure(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_custkey") % 40
    o = table(spark, sf_dir, "orders").groupBy(k.alias("k"), instant("o_orderdate").alias("datetime")).agg(F.min(100 + F.col("o_totalprice") / 100_000).alias("value"))
    name = F.concat(F.lit("g"), "k")
    return o.select(name.alias("station_id"), F.concat(F.lit("d-"), "k").alias("unique_id"), "datetime", "value", F.lit("observed").alias("flag"), (2 + F.col("k") % 3).cast("int").alias("product"), F.concat(name, F.lit("_"), F.year("datetime")).alias("source_file"))


def _air(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("w"), F.col("o_custkey") % 6).alias("station_id"), instant("o_orderdate").alias("datetime"))
    return o.agg(F.min(F.when(F.col("o_orderkey") % 3 == 0, 95 + F.col("o_totalprice") / 200_000)).alias("value")).withColumns({"product": F.lit(3), "source_file": F.concat("station_id", F.lit("_"), F.year("datetime"))})


def _pairings(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda n: F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval(days=n.cast("int"))
    k = F.col("s_suppkey")
    p = table(spark, sf_dir, "supplier").select(F.concat(F.lit("g"), k % 40).alias("station_id"), F.concat(F.lit("w"), F.floor(k / 7) % 6).alias("baro_source"), k.alias("priority"), day(k % 900).alias("valid_from"), F.when(k % 3 != 0, day(k % 900 + 500)).alias("valid_to"))
    n = lambda c: F.substring(c, 2, 9).cast("int")
    zones = p.select(F.explode(F.array("station_id", "baro_source")).alias("station_id")).distinct().select("station_id", n("station_id").alias("zone") % 2)
    return derived.split_pairings(p, zones.toDF("station_id", "zone"))[0]


def _places(pressure: DataFrame, air: DataFrame) -> DataFrame:
    n = F.substring("station_id", 2, 9).cast("double")
    gauges = pressure.select("station_id", "unique_id").distinct().select("station_id", "unique_id", F.when(n % 10 != 9, n * 3).alias("elev"), (n / 100).alias("sensor_height_m"))
    return gauges.unionByName(air.select("station_id").distinct().select("station_id", (n * 10).alias("elev")), allowMissingColumns=True)


@query(f"WITH {_PAIRED} SELECT station_id, datetime, value, baro_source, baro_value, substituted FROM x")
def baro_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = derived.pair_barometers(_pressure(spark, sf_dir), _pairings(spark, sf_dir), _air(spark, sf_dir))
    return out.select("station_id", ntz("datetime"), "value", "baro_source", "baro_value", "substituted")


_LEVELS = f"""{_PAIRED}, l AS (SELECT station_id, 'd-' || substr(station_id, 2) AS unique_id, datetime, baro_source, substituted, CASE WHEN baro_source IS NULL THEN product ELSE least(product, 3) END AS product,
  (value - baro_value * exp(-(CASE WHEN CAST(substr(station_id, 2) AS INTEGER) % 10 <> 9 THEN CAST(substr(station_id, 2) AS DOUBLE) * 3 END - CAST(substr(baro_source, 2) AS DOUBLE) * 10) * {derived.GRAVITY * derived.AIR_MOLAR / (derived.GAS * derived.AIR_KELVIN)!r})) * {1000.0 / (derived.GRAVITY * derived.DENSITY)!r} + CAST(substr(station_id, 2) AS DOUBLE) / 100 AS level FROM x)"""


@query(f"WITH {_LEVELS} SELECT station_id, unique_id, datetime, round(level, 6) AS value, CASE WHEN level IS NULL THEN 'missing' WHEN substituted THEN 'substituted' ELSE 'observed' END AS flag, product, baro_source, station_id || '_' || year(datetime) AS source_file FROM l")
def derive_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, a = _pressure(spark, sf_dir), _air(spark, sf_dir)
    out = derived.derive_level(p, _pairings(spark, sf_dir), a, _places(p, a))
    return out.select("station_id", "unique_id", ntz("datetime"), r6("value"), "flag", "product", "baro_source", "source_file")


@query(f"""WITH {_LEVELS}, y AS (SELECT station_id, unique_id, CAST(year(datetime - INTERVAL 4 HOUR) AS INTEGER) AS year, * EXCLUDE (station_id, unique_id) FROM l)
SELECT station_id, unique_id, year, count(*) AS rows, count(*) FILTER (level IS NULL) AS missing, count(*) FILTER (level IS NOT NULL AND substituted) AS substituted, min(product) AS product, coalesce(array_to_string(list_sort(list(DISTINCT baro_source) FILTER (baro_source IS NOT NULL)), ' '), '') AS baro_sources,
  CASE WHEN CAST(substr(station_id, 2) AS INTEGER) % 4 = 1 THEN 'metadata changed' END AS reason FROM y GROUP BY station_id, unique_id, year""")
def derive_level_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of levels, and why a level is stale once the sensor of every fourth gauge has been surveyed anew."""
    zone = "America/Puerto_Rico"
    p, a, pairs = _pressure(spark, sf_dir), _air(spark, sf_dir), _pairings(spark, sf_dir)
    places = _places(p, a)
    keys = ["station_id", "unique_id", "year"]
    m = derived.level_manifest(derived.derive_level(p, pairs, a, places), derived.wanted_levels(p, pairs, a, places, zone), zone, products.LOGIC_VERSION)
    moved = places.withColumn("sensor_height_m", F.col("sensor_height_m") + F.when(F.substring("station_id", 2, 9).cast("int") % 4 == 1, 0.5).otherwise(0.0))
    stale = products.stale_partitions(derived.wanted_levels(p, pairs, a, moved, zone), m, keys)
    return m.join(stale, keys, "left").select(*keys, "rows", "missing", "substituted", "product", F.array_join("baro_sources", " ").alias("baro_sources"), "reason")


# Decisions are orders about the events of one type: from the event of a minute to some hours later.
_DECISIONS = """d AS (SELECT o_orderkey AS decision_id, ['click', 'view', 'error', 'purchase', 'signup'][1 + o_custkey % 5] AS series, TIMESTAMP '2024-01-01' + o_orderkey * 7 % 41000 * INTERVAL 1 MINUTE AS starts,
  CASE WHEN o_orderkey % 499 <> 0 THEN TIMESTAMP '2024-01-01' + (o_orderkey * 7 % 41000 + 1 + o_custkey % 300) * INTERVAL 1 MINUTE END AS ends, ['suspect', 'estimated', 'missing', 'manual'][1 + o_orderkey % 4] AS flag, CASE WHEN o_orderkey % 4 = 1 THEN o_totalprice END AS value, o_orderdate AS decided_at FROM orders)"""


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    one = lambda names, n: F.element_at(F.array(*[F.lit(x) for x in names]), (n + 1).cast("int"))
    minute = lambda n: F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(mins=n.cast("int"))
    start = k * 7 % 41000
    d = table(spark, sf_dir, "orders").select(k.alias("decision_id"), one(["click", "view", "error", "purchase", "signup"], c % 5).alias("series"), minute(start).alias("starts"), F.when(k % 499 != 0, minute(start + 1 + c % 300)).alias("ends"), one(["suspect", "estimated", "missing", "manual"], k % 4).alias("flag"), F.when(k % 4 == 1, F.col("o_totalprice")).alias("value"), instant("o_orderdate").alias("decided_at"))
    return decisions.split_decisions(d)[0]


@query(f"""WITH {_DECISIONS}, j AS (SELECT event_id, e.value AS recorded, d.decision_id, d.flag, d.value AS own, row_number() OVER (PARTITION BY event_id ORDER BY decided_at DESC NULLS LAST, decision_id DESC) AS n FROM (SELECT event_id, event_type, ts, CASE WHEN event_id % 13 <> 0 THEN value END AS value FROM events) e LEFT JOIN d ON d.series = e.event_type AND d.starts <= ts AND (d.ends IS NULL OR ts < d.ends))
SELECT event_id, recorded, decision_id, CASE WHEN flag IS DISTINCT FROM 'missing' THEN coalesce(own, recorded) END AS value, CASE WHEN flag = 'missing' OR coalesce(own, recorded) IS NULL THEN 'missing' ELSE coalesce(flag, 'observed') END AS flag FROM j WHERE n = 1""")
def value_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.when(F.col("event_id") % 13 != 0, F.col("value"))
    e = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("series"), instant("ts").alias("datetime"), v.alias("value"), F.when(v.isNull(), "missing").otherwise("observed").alias("flag"))
    return decisions.apply_flags(e, _decisions(spark, sf_dir), ["series"]).select("event_id", "recorded", "decision_id", "value", "flag")


@query(f"""WITH {_DECISIONS}, t AS (SELECT series, starts AS t FROM d UNION SELECT series, ends FROM d WHERE ends IS NOT NULL), s AS (SELECT series, t, lead(t) OVER (PARTITION BY series ORDER BY t) AS u FROM t),
c AS (SELECT s.series, s.t, s.u, max_by(decision_id, (decided_at, decision_id)) AS decision_id FROM s JOIN d ON d.series = s.series AND d.starts <= s.t AND (d.ends IS NULL OR s.t < d.ends) GROUP BY ALL),
r AS (SELECT *, CASE WHEN t = lag(u) OVER w THEN 0 ELSE 1 END AS fresh FROM c WINDOW w AS (PARTITION BY series, decision_id ORDER BY t)), k AS (SELECT *, sum(fresh) OVER (PARTITION BY series, decision_id ORDER BY t) AS run FROM r)
SELECT series, decision_id, min(t) AS starts, CASE WHEN bool_or(u IS NULL) THEN NULL ELSE max(u) END AS ends FROM k GROUP BY series, decision_id, run""")
def flag_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.cut_spans(_decisions(spark, sf_dir), ["series"]).select("series", "decision_id", ntz("starts"), ntz("ends"))


# Events are deployments, each surveyed against the one before it in runs of 1,000; every seventh run goes round.
_LINKS = "l AS (SELECT event_id AS node, CASE WHEN event_id % 1000 = 0 THEN CASE WHEN event_id // 1000 % 7 = 3 THEN event_id + 999 ELSE -1 - event_id // 1000 END ELSE event_id - 1 END AS parent, event_id % 17 * 0.25 AS value FROM events)"


@query(f"""WITH RECURSIVE {_LINKS}, r AS (SELECT node, parent AS root, CAST(value AS DOUBLE) AS height, CAST(1 AS BIGINT) AS hops FROM l WHERE parent < 0 OR parent NOT IN (SELECT node FROM l) UNION ALL SELECT l.node, r.root, r.height + l.value, r.hops + 1 FROM r JOIN l ON l.parent = r.node)
SELECT node, root, height, hops, false AS cyclic FROM r UNION ALL SELECT node, NULL, NULL, NULL, true FROM l WHERE node NOT IN (SELECT node FROM r)""")
def long_surveys(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    run = F.floor(k / 1000)
    first = F.when(run % 7 == 3, k + 999).otherwise(-1 - run)
    e = table(spark, sf_dir, "events").select(k.alias("node"), F.when(k % 1000 == 0, first).otherwise(k - 1).alias("parent"), (k % 17 * 0.25).alias("value"))
    heights, cyclic = survey.chain_heights(e)
    return heights.withColumn("cyclic", F.lit(False)).unionByName(cyclic.withColumn("cyclic", F.lit(True)), allowMissingColumns=True)


_SURVEYS = """s AS (SELECT 'e' || c_custkey AS unique_id, n AS quantity, CAST(c_custkey * 7 % 23 * 10 + k AS DOUBLE) - CASE WHEN c_custkey % 31 = 0 THEN 300 ELSE 0 END AS value, CASE n WHEN 'elev_rel_m' THEN 'e' || (c_custkey - 1) WHEN 'gzf_offset_cm' THEN 'rebar' WHEN 'sensor_height_cm' THEN CASE WHEN c_custkey % 2 = 0 THEN 'bed' ELSE 'rebar' END ELSE 'bed' END AS relative_to, DATE '2024-01-01' + CAST(k AS INTEGER) AS measured_on
  FROM customer, (VALUES ('rebar_offset_cm', 1), ('sensor_height_cm', 2), ('gzf_offset_cm', 3), ('elev_rel_m', 4), ('rebar_offset_cm', 5)) q(n, k) WHERE (c_custkey + k) % 6 <> 0)"""


@query(f"""WITH {_SURVEYS}, n AS (SELECT unique_id, quantity, max_by(value, measured_on) AS value, max_by(relative_to, measured_on) AS relative_to FROM s GROUP BY ALL),
o AS (SELECT unique_id, max(CASE WHEN quantity = 'rebar_offset_cm' THEN value END) / 100 AS rebar, max(CASE WHEN quantity = 'sensor_height_cm' AND relative_to = 'bed' THEN value END) / 100 AS sensor, max(CASE WHEN quantity = 'sensor_height_cm' AND relative_to = 'rebar' THEN value END) / 100 AS below, max(CASE WHEN quantity = 'gzf_offset_cm' THEN value END) / 100 AS gzf FROM n GROUP BY 1)
SELECT unique_id, round(rebar, 6) AS rebar, round(coalesce(sensor, rebar + below), 6) AS sensor, round(rebar - gzf, 6) AS overflow FROM o""")
def relative_heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    kinds = [("rebar_offset_cm", 1), ("sensor_height_cm", 2), ("gzf_offset_cm", 3), ("elev_rel_m", 4), ("rebar_offset_cm", 5)]
    place = {"elev_rel_m": F.concat(F.lit("e"), k - 1), "gzf_offset_cm": F.lit("rebar"), "sensor_height_cm": F.when(k % 2 == 0, "bed").otherwise("rebar")}
    each = [F.struct(F.lit(n).alias("quantity"), F.lit(i).alias("k"), place.get(n, F.lit("bed")).alias("relative_to")) for n, i in kinds]
    s = table(spark, sf_dir, "customer").select("c_custkey", F.inline(F.array(*each))).filter((k + F.col("k")) % 6 != 0)
    value = (k * 7 % 23 * 10 + F.col("k")).cast("double") - F.when(k % 31 == 0, 300).otherwise(0)
    s = s.select(F.concat(F.lit("e"), k).alias("unique_id"), "quantity", value.alias("value"), "relative_to", F.date_add(F.lit("2024-01-01").cast("date"), F.col("k")).alias("measured_on"))
    return survey.relative_heights(s)[0].select("unique_id", F.round("rebar_above_bed_m", 6).alias("rebar"), F.round("sensor_above_bed_m", 6).alias("sensor"), F.round("overflow_above_bed_m", 6).alias("overflow"))


_STATUS = """h AS (SELECT o_orderkey AS unique_id, o_custkey AS device_serial, CASE WHEN o_orderkey % 5 = 0 THEN 'nonresponsive' WHEN o_orderkey % 7 = 0 THEN 'defunct' ELSE 'online' END AS status, o_orderdate AS valid_from, CAST(CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS TIMESTAMP) AS valid_to FROM orders),
s AS (SELECT user_id AS device_serial, max(ts) AS seen FROM events GROUP BY 1), n AS (SELECT TIMESTAMP '2024-01-31' AS t),
c AS (SELECT h.*, CASE WHEN status = 'online' AND epoch(t - coalesce(seen, valid_from)) > 86400 * 1.0 THEN 'nonresponsive' WHEN status = 'nonresponsive' AND epoch(t - seen) <= 86400 * 0.5 THEN 'online' END AS fresh, t FROM h LEFT JOIN s USING (device_serial), n WHERE valid_to IS NULL)"""


@query(f"""WITH {_STATUS} SELECT unique_id, status, valid_from, CASE WHEN unique_id IN (SELECT unique_id FROM c WHERE fresh IS NOT NULL) AND valid_to IS NULL THEN (SELECT t FROM n) ELSE valid_to END AS valid_to FROM h
UNION ALL SELECT unique_id, fresh, t, NULL FROM c WHERE fresh IS NOT NULL""")
def auto_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    h = table(spark, sf_dir, "orders").select(k.alias("unique_id"), F.col("o_custkey").alias("device_serial"), F.when(k % 5 == 0, "nonresponsive").when(k % 7 == 0, "defunct").otherwise("online").alias("status"), instant("o_orderdate").alias("valid_from"), F.when(F.col("o_orderstatus") == "F", instant("o_orderdate") + F.expr("interval 30 days")).alias("valid_to"))
    seen = table(spark, sf_dir, "events").select(F.col("user_id").alias("device_serial"), instant("ts").alias("datetime"))
    out = status.apply_status(h, status.status_changes(h, seen, "2024-01-31", lost_days=1.0, back_days=0.5))
    return out.select("unique_id", "status", ntz("valid_from"), ntz("valid_to"))


@query("""WITH p AS (SELECT 'st' || user_id % 20 AS station_id, event_type AS variable, ts AS datetime, event_id, value FROM events),
r AS (SELECT c_custkey AS request, 'st' || c_custkey % 25 AS station_id, CASE c_custkey % 3 WHEN 0 THEN 'click' WHEN 1 THEN 'view' ELSE 'odd' END AS variable, TIMESTAMP '2023-12-20' + c_custkey % 60 * INTERVAL 1 DAY AS starts, CASE WHEN c_custkey % 4 <> 0 THEN TIMESTAMP '2023-12-20' + (c_custkey % 60 + 3) * INTERVAL 1 DAY END AS ends FROM customer)
SELECT request, p.station_id, p.variable, datetime, event_id FROM r JOIN p ON r.station_id = p.station_id AND r.variable = p.variable AND starts <= datetime AND (ends IS NULL OR datetime < ends)""")
def product_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = "America/Puerto_Rico"
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("st"), F.col("user_id") % 20).alias("station_id"), F.col("event_type").alias("variable"), instant("ts").alias("datetime"), "event_id", "value")
    path = scratch.shared_folder(spark, "products")
    products.write_product(e.withColumn("year", F.year(F.from_utc_timestamp("datetime", zone))), path)
    k = F.col("c_custkey")
    day = lambda n: F.lit("2023-12-20").cast("timestamp") + F.make_dt_interval(days=n.cast("int"))
    r = table(spark, sf_dir, "customer").select(k.alias("request"), F.concat(F.lit("st"), k % 25).alias("station_id"), F.when(k % 3 == 0, "click").when(k % 3 == 1, "view").otherwise("odd").alias("variable"), day(k % 60).alias("starts"), F.when(k % 4 != 0, day(k % 60 + 3)).alias("ends"))
    # the time that is told is made once a row, before requests multiply the rows
    p = spark.read.parquet(path).withColumn("told", ntz("datetime"))
    return derived.product_query(p, r, zone).select("request", "station_id", "variable", F.col("told").alias("datetime"), "event_id")
