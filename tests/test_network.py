"""Refusals, nulls and empty tables of the network's operators."""

import pytest
from pyspark.sql import functions as F

from fieldseries.functions import texts
from fieldseries.operators import attribution, changes, findings, lookups, quality, rules, topk
from fieldseries.plans import build
from fieldseries.sources import files, named, scratch


def test_a_table_that_changed_is_not_overwritten(spark):
    schema = {"k": "integer", "name": "text", "yes": "logical"}
    path = scratch.shared_folder(spark, "t")
    df = spark.createDataFrame([(True, 1, "a"), (None, 2, None)], "yes boolean, k long, name string")
    base = named.write_typed_table(df, path, schema)
    assert named.write_typed_table(df.limit(1), path, schema, base) != base
    with pytest.raises(ValueError, match="changed"):
        named.write_typed_table(df, path, schema, base)
    with pytest.raises(ValueError, match="not declared"):
        named.write_typed_table(df.drop("yes"), path, schema)


def test_files_that_the_log_lacks_are_named(spark):
    log = spark.createDataFrame([("a", None), ("a", "2024-01-02")], "filepath string, t string").select("filepath", F.col("t").cast("timestamp").alias("timestamp_utc"))
    one = spark.createDataFrame([("a",)], "filepath string")
    assert lookups.fetch_time_lookup(one, log).count() == 1
    with pytest.raises(Exception, match="no log row for b"):
        lookups.fetch_time_lookup(one.unionByName(spark.createDataFrame([("b",)], "filepath string")), log).collect()


def test_unknown_stages_are_refused(spark):
    p = spark.createDataFrame([("s", "d", "x", "old"), ("s", "e", "x", "old")], "station_id string, device_serial string, stage string, updated string")
    u = p.limit(1).withColumns({"stage": F.lit("no such"), "updated": F.lit("new")})
    with pytest.raises(Exception, match="unknown stage"):
        changes.update_stages(p, u, p.limit(0), ("x",)).collect()
    assert changes.update_stages(p, u.withColumn("stage", F.lit("x")), p.filter("device_serial = 'e'"), ("x",)).count() == 1


def test_a_replica_is_not_emptied(spark):
    f = spark.createDataFrame([(f"p2/wx/s{i}/v/s{i}_v_p2_2024.csv.gz",) for i in range(8)], "filepath string")
    m = f.limit(4).select(F.col("filepath").alias("product_path"))
    with pytest.raises(ValueError, match="more of the replica"):
        build.retired_partitions(f.limit(4), f, m, m)
    with pytest.raises(ValueError, match="differ"):
        build.retired_partitions(f.limit(4), f, m, m.limit(3))
    with pytest.raises(ValueError):
        build.product_path("a_wx1", "v", 2024, 1)
    assert build.product_path("a_wx1", "v", 2024) == "p2/wx/a_wx1/v/a_wx1_v_p2_2024.csv.gz"


REPORT = "PROJECT\nUnits: Meters\nTotal Measurements: {}\nHorizontal Distance: 7.67 Meters\nHorizontal Distance: {}\n"


def test_reports(spark):
    rows = [("a", REPORT.format(2, "16.49 Meters")), ("b", REPORT.format(3, "16.49 Meters")), ("c", REPORT.format(2, "0 Meters")), ("d", REPORT.format(2, "16.49 Feet")), ("e", REPORT.format(2, "N/A")), ("f", ""), ("g", None), ("h", REPORT.format(2, "1 Meters").replace("Units: Meters", "Units: Ells"))]
    got = {r.file: (r.problem, r.total_m and round(r.total_m, 2)) for r in files.read_measure_report(spark.createDataFrame(rows, "file string, text string")).collect()}
    assert got["a"] == (None, 24.16)
    assert {k: v[0] for k, v in got.items() if k != "a"} == {"b": "other number of legs than declared", "c": "leg of zero or less", "d": "mixed units", "e": "leg without a distance", "f": "no unit", "g": "no unit", "h": "unknown unit"}


def test_exports_with_odd_tops(spark):
    good = "﻿Title, with, more, commas\nid,stamp,v\n" + "\n".join(f"{i},2024-01-{i + 1:02d} 00:00:00,\"1,{i}\"" for i in range(20)) + "\n"
    rows = [("good", good), ("no time", "a,b\n1,2\n3,4\n"), ("one column", "a\nb\n"), ("empty", ""), ("null", None), ("header only", "Date Time,b\n")]
    r, errors = files.read_preamble_csv(spark.createDataFrame(rows, "file string, text string"))
    got = r.collect()
    assert len(got) == 20 and {x.file for x in got} == {"good"} and got[0]["values"]["v"] == "1,0"
    assert got[3].time.isoformat() == "2024-01-04T04:00:00"
    assert {e.file: e.problem for e in errors.collect()} == {"no time": "no time column", "one column": "no header", "empty": "no header", "null": "no header", "header only": "no rows"}


def test_attribution_of_a_hot_device_and_open_windows(spark):
    at = lambda d: F.timestamp_seconds(F.col(d) * 86_400)
    w = spark.createDataFrame([("a", "s1", "vwc", "1", 0, 200), ("a", "s2", "weather", "2", 100, None), ("b", "s3", "vwc", "3", None, None), (None, "s4", "vwc", "4", 0, None)], "device_serial string, station_id string, station_type string, unique_id string, x int, y int").select("device_serial", "station_id", "station_type", "unique_id", at("x").alias("starts"), at("y").alias("ends"))
    r = spark.createDataFrame([("a", d) for d in range(0, 1_000, 7)] + [("b", 5), (None, 5), ("a", None), ("z", 1)], "device_serial string, d int").withColumn("datetime", at("d"))
    got = {(x.device_serial, x.d): x.station_id for x in attribution.resolve_by_device(r, w).collect()}
    assert len(got) == r.count()
    assert all(got["a", d] == ("s1" if d < 100 else "s2") for d in range(0, 1_000, 7))
    assert got["b", 5] is got[None, 5] is got["a", None] is got["z", 1] is None
    assert attribution.resolve_by_device(r.limit(0), w).count() == 0
    assert attribution.resolve_by_device(r, w.limit(0)).filter("station_id is not null").count() == 0


def test_device_level_readings_need_an_open_port(spark):
    at = lambda d: F.timestamp_seconds(F.lit(d) * 86_400)
    one = spark.range(1)
    w = one.select(F.lit("a").alias("device_serial"), F.explode(F.array(F.struct(F.lit("s1").alias("station_id"), F.lit("vwc").alias("station_type"), F.lit("1").alias("unique_id")), F.struct(F.lit("s2").alias("station_id"), F.lit("weather").alias("station_type"), F.lit("2").alias("unique_id")))).alias("w")).select("device_serial", "w.*", at(0).alias("starts"), F.lit(None).cast("timestamp").alias("ends"))
    p = one.select(F.lit("a").alias("device_serial"), F.lit(1).alias("port"), F.lit("t").alias("sensor"), F.lit(10.0).alias("depth_cm"), F.lit("weather").alias("type"), at(0).alias("starts"), at(50).alias("ends"))
    r = spark.createDataFrame([("a", 1, 10, True), ("a", 1, 60, True), ("a", 1, 10, False), ("a", 1, 60, False)], "device_serial string, port int, d int, device_level boolean").withColumns({"datetime": F.timestamp_seconds(F.col("d") * 86_400), "variable": F.lit("v"), "depth": F.lit(False)})
    known, lost = attribution.attribute_readings(r, w, p)
    assert sorted((x.d, x.device_level, x.station_id) for x in known.collect()) == [(10, False, "s2"), (10, True, "s2")]
    assert lost.count() == 2
    free, _ = attribution.attribute_readings(r, w, p.limit(0))
    assert sorted((x.d, x.device_level, x.station_id) for x in free.collect()) == [(10, False, "s2"), (10, True, "s2"), (60, False, "s2"), (60, True, "s2")]


def test_rules_on_missing_columns_and_empty_tables(spark):
    d = spark.createDataFrame([("1", None, " ")], "unique_id string, station_id string, device_serial string")
    n = rules.Network(d, *[None] * 6)
    got = {(r.key, r.detail) for r in rules.violations(n, ["REQUIRED_FIELD_NA"]).collect()}
    assert got == {("1", "station_id"), ("1", "device_serial"), *((None, f) for f in rules.REQUIRED if f not in d.columns)}
    v = spark.createDataFrame([("R", str(i), "x") for i in range(30)], "rule string, key string, detail string")
    assert topk.samples(v, 10).count() == 10 and topk.samples(v.limit(0)).count() == 0
    assert quality.all_terminal(spark.createDataFrame([("a", "removed"), ("b", "online"), ("b", "removed")], "device_serial string, status string")).count() == 1


def test_displays(spark):
    row = spark.range(1).select(texts.show_rod(F.lit("4, 3-2"), F.lit("ft_in_8")).alias("a"), texts.show_fall(F.lit(-1.5)).alias("b"), texts.show_fall(F.lit(None).cast("double")).alias("c"), texts.shown(F.lit(" ")).alias("d"), texts.is_survey_filename(F.lit("s_h1_fall_rod_20240101_2.csv")).alias("e"), lookups.sensor_type(F.lit("ATMOS 41")).alias("f"), lookups.is_logger(F.lit(" HOBO "), F.lit("z6-1")).alias("g")).first()
    assert tuple(row) == ("4' 3 2/8\"", "-1.5000 m (a climb)", "(none)", "-", True, "weather", True)


def test_no_device_list_is_a_finding(spark):
    assert [r.kind for r in findings.source_unavailable(spark).collect()] == ["error"]
