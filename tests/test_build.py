"""Builds, their versions, what is rebuilt, and streams into kept readings."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fieldseries.operators import grid, sequences, unattributed, windows
from fieldseries.plans import build, products
from fieldseries.plans.store import ConcurrentBuild, VersionedProducts
from fieldseries.sources import scratch
from fieldseries.streaming import dedupe as stream

ZONE = "America/Puerto_Rico"
YEAR_END = datetime(2024, 1, 1, 4)  # local midnight


@pytest.fixture(scope="module")
def inputs(spark):
    """Two stations over two years: quarter-hour levels, and five-minute rain that began in seconds off the grid."""
    rows = []
    for device, file, start, n, minutes, sensor, late in (("d1", "a1", -30, 40, 15, "level", 0), ("d1", "a2", 5, 40, 15, "level", 437), ("d2", "b1", -20, 40, 15, "level", 0), ("d3", "c1", -30, 90, 5, "rain", 0), ("d1", "stray", 0, 5, 15, "level", 0), ("d4", "e1", 400_000, 20, 15, "level", 0)):
        rows += [(device, 1, "src", sensor, "reading", YEAR_END + timedelta(minutes=15 * start + minutes * k, seconds=late), float(k % 7), "m", 0, file, k) for k in range(n)]
    long = spark.createDataFrame(rows, "device_serial string, port int, source string, sensor string, measurement string, datetime timestamp, value double, unit string, error_code int, filepath string, row_seq long")
    log = spark.createDataFrame([(f, datetime(2025, 1, 1)) for f in ("a1", "a2", "b1", "c1", "e1")], "filepath string, timestamp_utc timestamp")
    registry = spark.createDataFrame([("src", "level", "reading", True, "stage", "m", "instantaneous", False, "m"), ("src", "rain", "reading", True, "rain", "m", "accumulated", False, "m")], "source string, sensor string, measurement string, keep boolean, variable string, unit string, kind string, depth boolean, source_unit string")
    w = spark.createDataFrame([(d, s, "wx", f"id-{d}", datetime(2023, 6, 1), None) for d, s in (("d1", "st_a"), ("d2", "st_b"), ("d3", "st_a"), ("d4", "st_b"))], "device_serial string, station_id string, station_type string, unique_id string, starts timestamp, ends timestamp")
    ports = spark.createDataFrame([], "device_serial string, port int, sensor string, depth_cm double, type string, starts timestamp, ends timestamp")
    files = long.groupBy("filepath", "device_serial").agg(F.min("datetime").cast("date").alias("start_date"), F.max("datetime").cast("date").alias("end_date"))
    return {"long": long, "registry": registry, "windows": w, "ports": ports, "log": log}, files


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_unlogged_files_are_listed_and_stop_nothing(spark, inputs):
    i, _ = inputs
    b = build.build_products(**i)
    assert [r.filepath for r in b.unlogged.collect()] == ["stray"]
    assert b.series.filter("source_file = 'stray'").count() == 0 and b.series.count() > 0
    m = {(r.station_id, r.variable, r.year): r for r in b.manifest.collect()}
    assert m["st_a", "rain", 2023].alignment == ["d3 summed"] and m["st_a", "rain", 2023].intervals == ["d3 5 min"]
    assert m["st_a", "stage", 2024].alignment == ["d1 interpolated"] and m["st_a", "stage", 2024].deployments == ["id-d1"]
    assert m["st_a", "stage", 2024].unit == "m" and m["st_a", "stage", 2024].timezone == ZONE and m["st_a", "stage", 2024].built_utc
    assert all(r.metadata_fingerprint and r.ports_fingerprint == "none" for r in m.values())


@pytest.mark.parametrize("station, year", [("st_a", 2023), ("st_a", 2024), ("st_b", 2024), ("st_b", 2035)])
def test_a_station_year_alone_is_as_in_a_full_build(spark, inputs, station, year):
    i, files = inputs
    i = {**i, "long": i["long"].filter("filepath <> 'stray'")}
    stale = spark.createDataFrame([(station, year)], "station_id string, year int")
    whole, part = build.build_products(**i), build.rebuild_stale(stale, **i, files=files)
    mine = F.col("station_id").eqNullSafe(station) & (F.col("year") == year)
    assert rows(part.series) == rows(whole.series.filter(mine)) and part.series.count() > 0
    drop = ("built_utc", "inputs")
    assert rows(part.manifest.drop(*drop)) == rows(whole.manifest.filter(mine).drop(*drop))


def test_a_rebuild_reads_only_its_files(spark, inputs):
    i, files = inputs
    path = scratch.shared_folder(spark, "long")
    i["long"].write.partitionBy("filepath").parquet(path)
    long = spark.read.schema(i["long"].schema).parquet(path)
    need, candidates, unlogged = build.needed_readings(spark.createDataFrame([("st_a", 2024)], "station_id string, year int"), long, i["windows"], files, i["log"])
    assert {r.filepath for r in candidates.select("filepath").collect()} == {"a1", "a2", "c1"} and [r.filepath for r in unlogged.collect()] == ["stray"]
    assert {r.filepath for r in need.select("filepath").distinct().collect()} == {"a1", "a2", "c1"}
    plan = need._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower() and "PushedFilters" in plan
    assert build.needed_readings(candidates.limit(0), long, i["windows"], files, i["log"])[0].count() == 0


def test_fingerprints_follow_what_decides_a_product(spark, inputs):
    i, _ = inputs
    ports = spark.createDataFrame([("d1", 1, "s", 10.0, "wx", datetime(2023, 6, 1), None)], i["ports"].schema)
    at = lambda w, p: {(r.station_id, r.year): (r.metadata_fingerprint, r.ports_fingerprint) for r in build.fingerprints(windows.devices_in_years(w, build.local_years(spark, 2023, 2024)), w, p, build.METADATA, build.PORTS).collect()}
    before = at(i["windows"], ports)
    deeper = at(i["windows"], ports.withColumn("depth_cm", F.lit(25.0)))
    assert {k for k in before if deeper[k] != before[k]} == {("st_a", 2023), ("st_a", 2024)} and all(deeper[k][0] == before[k][0] for k in before)
    moved = at(i["windows"].withColumn("starts", F.when(F.col("device_serial") == "d2", datetime(2023, 7, 1)).otherwise(F.col("starts"))), ports)
    assert {k for k in before if moved[k] != before[k]} == {("st_b", 2023), ("st_b", 2024)}
    assert at(i["windows"].withColumn("battery", F.lit(3)), ports) == before


def test_what_was_built_is_not_stale(spark, inputs):
    i, files = inputs
    years = build.local_years(spark, 2023, 2035)
    logged, _ = build.candidate_files(files, i["windows"], i["log"], years)
    b = build.build_products(**i, candidates=logged)
    wanted = build.wanted_station_years(i["windows"], i["ports"], logged, years)
    made = b.manifest.select("station_id", "year").distinct()
    assert products.stale_station_years(wanted.join(made, ["station_id", "year"], "left_semi"), b.manifest).count() == 0
    moved = i["windows"].withColumn("starts", F.col("starts") + F.expr("interval 1 day"))
    again = products.stale_station_years(build.wanted_station_years(moved, i["ports"], logged, years).join(made, ["station_id", "year"], "left_semi"), b.manifest)
    assert {r.reason for r in again.collect()} == {"metadata changed"}


# --- versions


def product(spark, *keys, value=1.0):
    s = spark.createDataFrame([(st, v, y, value) for st, v, y in keys], "station_id string, variable string, year int, value double")
    return s, s.groupBy("station_id", "variable", "year").agg(F.count("*").alias("rows"))


def test_versions(spark, monkeypatch):
    store = VersionedProducts(spark, scratch.shared_folder(spark, "store"))
    assert store.read() is None and store.manifest() is None and store.versions() == [] and store.remove_unused() == 0
    s, m = product(spark, ("a b/c", "v:1", 2023), ("a b/c", "old", 2023), ("z", "v:1", 2023))
    assert store.commit(s, m, m) == 1
    s2, m2 = product(spark, ("a b/c", "v:1", 2023), value=2.0)
    # a build that dies before it publishes leaves the last version as it was
    with monkeypatch.context() as p, pytest.raises(RuntimeError):
        p.setattr(VersionedProducts, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        store.commit(s2, m2, m2)
    assert store.versions() == [1] and store.read().agg(F.sum("value")).first()[0] == 3.0
    assert store.commit(s2, m2, m2) == 2
    got = {(r.station_id, r.variable): r.value for r in store.read().collect()}
    assert got == {("a b/c", "v:1"): 2.0, ("z", "v:1"): 1.0}  # what the station-year no longer makes is gone, others stay
    assert store.read(1).count() == 3 and store.manifest().count() == 2
    # two builds from the same version: the second to publish has to start again
    with pytest.raises(ConcurrentBuild):
        store._publish(2, "x", 1)
    with pytest.raises(ConcurrentBuild):
        store._publish(3, "x", 1)
    assert store.versions() == [1, 2]
    assert store.remove_unused(keep=2) == 1  # of the build that died
    assert store.remove_unused() == 2 and store.versions() == [2] and store.read(1) is None  # superseded, and no longer made
    assert {(r.station_id, r.variable): r.value for r in store.read().collect()} == got
    s3, m3 = product(spark)
    store.commit(s3, m3, m2)
    assert [r.station_id for r in store.read().collect()] == ["z"]


# --- streams


READING = "device_serial string, datetime timestamp, value double, fetched_utc timestamp, source_file string, row_seq long"
KEYS = ["device_serial", "datetime"]


def feed(spark, root, rows, checkpoint="ck"):
    df = spark.createDataFrame(rows, READING)
    df.write.mode("append").parquet(f"{root}/in-{checkpoint}")
    stream.stream_dedupe(spark.readStream.schema(df.schema).parquet(f"{root}/in-{checkpoint}"), f"{root}/kept", f"{root}/{checkpoint}", KEYS).awaitTermination()


def kept(spark, root):
    return {r.device_serial: r.value for r in stream.current_readings(spark, f"{root}/kept", KEYS).collect()}


def test_stream_keeps_the_latest_fetch(spark):
    root, t = scratch.shared_folder(spark, "s"), datetime(2024, 1, 1)
    f = lambda d: t + timedelta(days=d)
    feed(spark, root, [("a", t, 1.0, f(5), "x", 1), ("b", t, 1.0, None, "x", 1), ("c", t, 2.0, f(1), "x", 2), ("c", t, 1.0, f(1), "x", 1), ("c", t, 3.0, f(1), "y", 0), ("e", t, 1.0, f(3), "x", 1)])
    feed(spark, root, [("a", t, 9.0, f(4), "y", 1), ("b", t, 2.0, f(-9), "y", 1), ("a", t, 1.0, f(5), "x", 1)])
    want = {"a": 1.0, "b": 2.0, "c": 1.0, "e": 1.0}  # no fetch time comes last; in a fetch the first file and row
    assert kept(spark, root) == want
    log = spark.read.parquet(f"{root}/kept/log")
    assert log.filter("device_serial = 'a' and value = 1").count() == 1  # the exact repeat was dropped by the state
    # a new checkpoint loses nothing, old or new
    feed(spark, root, [("d", t, 4.0, f(1), "x", 1), ("e", t, 5.0, f(4), "z", 1), ("a", t, 0.0, f(0), "z", 1)], "ck2")
    want |= {"d": 4.0, "e": 5.0}
    assert kept(spark, root) == want


def test_compaction_changes_nothing_that_is_read(spark, monkeypatch):
    root, t = scratch.shared_folder(spark, "s"), datetime(2024, 1, 1)
    f = lambda d: t + timedelta(days=d)
    feed(spark, root, [("a", t, 1.0, f(1), "x", 1), ("b", t, 1.0, f(1), "x", 1)])
    feed(spark, root, [("a", t, 2.0, f(2), "y", 1)])
    path = f"{root}/kept"
    into = stream.compact(spark, path, KEYS)
    assert kept(spark, root) == {"a": 2.0, "b": 1.0}
    # a compaction that died before its last step is not looked at
    spark.createDataFrame([("zombie", t, 7.0, f(9), "x", 1, "compacted-dead", 0, "2024-01-01")], READING + ", run string, batch long, day string").write.mode("append").partitionBy("run", "batch", "day").parquet(f"{path}/log")
    assert kept(spark, root) == {"a": 2.0, "b": 1.0}
    assert stream.remove_compacted(spark, path) == 2
    feed(spark, root, [("b", t, 3.0, f(3), "y", 1)])
    assert kept(spark, root) == {"a": 2.0, "b": 3.0}
    assert stream.compact(spark, path, KEYS) != into and kept(spark, root) == {"a": 2.0, "b": 3.0}


# --- windows by slices


def test_neighbours_and_sums_over_slices(spark):
    t = datetime(2020, 1, 1)
    data = [(k, t + timedelta(days=d), v) for k in ("a", None) for d, v in ((0, 1), (1, 2), (1, 3), (200, 4), (201, 5), (900, 6))] + [("b", t, 1), ("b", None, 9)]
    df = spark.createDataFrame(data, "k string, at timestamp, v int").repartition(3)
    at = F.unix_micros("at")
    n = sequences.with_neighbour(df, ["k"], at, ["v"], "n").collect()
    assert len(n) == len(data) - 1
    nxt = {(r.k, (r.at - t).days, r.v): r.n and (r.n.at - int(datetime(2020, 1, 1).timestamp() * 1e6)) // 86_400_000_000 for r in n}
    for k in ("a", None):
        assert [nxt[k, d, v] for d, v in ((0, 1), (200, 4), (201, 5), (900, 6))] == [1, 201, 900, None]
        assert sorted([nxt[k, 1, 2], nxt[k, 1, 3]]) == [1, 200]
    p = {(r.k, (r.at - t).days): r.n and r.n.v for r in sequences.with_neighbour(df, ["k"], at, ["v"], "n", ahead=False).collect()}
    assert p["a", 200] in (2, 3) and p["a", 900] == 5 and p[None, 201] == 4 and p["b", 0] is None
    s = {(r.k, (r.at - t).days): r.s for r in sequences.with_running_sum(df, ["k"], at, F.col("v"), "s").collect()}
    assert s == {**{(k, d): v for k in ("a", None) for d, v in ((0, 1), (1, 6), (200, 10), (201, 15), (900, 21))}, ("b", 0): 1}
    assert sequences.with_running_sum(df.limit(0), ["k"], at, F.col("v"), "s").count() == 0


def test_a_long_series_is_many_tasks(spark):
    """One series with nearly all rows: no window task gets more than a slice of it, and gaps and episodes over the edges are whole."""
    t = "timestamp'2020-01-01' + make_dt_interval(0, 0, 0, id * 3600)"
    df = spark.range(0, 24 * 720).selectExpr("'hot' as k", f"{t} as datetime", "case when id % 2000 between 700 and 720 then 'missing' else 'observed' end as flag")
    sized = sequences.with_running_sum(df, ["k"], F.unix_micros("datetime"), F.lit(1), "n").withColumn("_p", F.spark_partition_id())
    counts = sorted(r["count"] for r in sized.groupBy("_p").count().collect())
    assert len(counts) > 1 and counts[-1] <= df.count() / 2 and all(c % 720 == 0 for c in counts)  # whole slices, dealt to several tasks
    gaps = grid.find_gaps(df, ["k"], 60).collect()
    assert sorted(g.n for g in gaps) == [21] * 9
    lost = df.filter("flag = 'missing'").selectExpr("'x' as category", "k as device_serial", "datetime", "1 as port", "'v' as variable")
    assert [(r.moments, r.episode) for r in unattributed.unattributed_episodes(lost, 86400).orderBy("episode").collect()] == [(21, k) for k in range(1, 10)]
