from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fieldseries.functions import parsing, units
from fieldseries.operators import attribution, changes, dedupe, mapping, survey, unattributed, windows
from fieldseries.plans import products
from fieldseries.streaming import landing

DAY = datetime(2024, 8, 1)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


# --- duplicates

READINGS = "value double, source_file string, fetched_utc timestamp, row_seq long, sums boolean"


def deduped(spark, rows):
    df = spark.createDataFrame([(v, f, DAY + timedelta(days=d), i, True) for i, (v, f, d) in enumerate(rows)], READINGS)
    df = df.select(*[F.lit("k").alias(c) for c in ("device_serial", "sensor", "measurement")], F.lit(None).cast("int").alias("port"), F.lit(DAY).alias("datetime"), "*")
    (r,) = dedupe.dedupe_latest_wins(df, accumulated="sums").collect()
    return r.value, r.conflict, r.repeats, r.repeat_dropped


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(0.3, "a", 0), (None, "b", 1)], (None, True, 0, None)),  # a later null is kept and is a conflict
        ([(None, "a", 0), (None, "b", 1)], (None, False, 0, None)),
        ([(23.8, "a", 0), (23.9, "a", 0)], (23.8, False, 1, 23.9)),  # a repeat is no conflict
        ([(23.8, "a", 0), (23.9, "a", 0), (24.4, "b", 1)], (24.4, True, 1, 23.9)),
        ([(0.0, "a", 0), (0.97, "a", 0)], (0.0, False, 1, 0.97)),
        ([(2.0, "b", 1), (1.0, "a", 0)], (2.0, True, 0, None)),  # in any input order
    ],
)
def test_dedupe(spark, rows, expected):
    assert deduped(spark, rows) == expected


# --- windows and attribution


def deployments(spark, rows):
    return spark.createDataFrame(rows, "device_serial string, station_id string, station_type string, unique_id long, deploy_datetime timestamp, status string, last_visit date")


def test_a_removed_device_leaves_no_mans_land(spark):
    d = deployments(spark, [("d", "a", "Hydro", 1, datetime(2024, 8, 1), "removed", date(2024, 8, 29)), ("d", "b", "hydro", 2, datetime(2024, 9, 1, 12), "online", None)])
    w = windows.deployment_windows(d)
    ends = {r.station_id: (r.ends, r.end_basis) for r in w.collect()}
    assert ends == {"a": (datetime(2024, 8, 29, 23, 59, 59), "last visit"), "b": (None, "open")}
    r = spark.createDataFrame([("d", t) for t in (datetime(2024, 8, 29, 12), datetime(2024, 8, 30), datetime(2024, 9, 1, 12), datetime(2024, 9, 1, 11, 59))], "device_serial string, datetime timestamp")
    got = {x.datetime: x.station_id for x in attribution.resolve_by_device(r, w).collect()}
    assert list(got.values()).count(None) == 2
    assert got[datetime(2024, 8, 29, 12)] == "a" and got[datetime(2024, 9, 1, 12)] == "b"


def test_equal_starts_do_not_end_each_other(spark):
    d = deployments(spark, [("d", "a", "x", 1, DAY, "online", None), ("d", "b", "x", 2, DAY, "removed", None), ("e", "c", "x", 3, None, "online", None)])
    assert {(r.unique_id, r.ends, r.end_basis) for r in windows.deployment_windows(d).collect()} == {(1, None, "open"), (2, None, "unknown")}


def test_known_periods_go_before_installations(spark):
    w = spark.createDataFrame([("d", DAY)], "device_serial string, starts timestamp")
    known = spark.createDataFrame([(1, "d", None, DAY, DAY + timedelta(hours=1), "bench")], "rank int, device_serial string, port int, from timestamp, to timestamp, reason string")
    hours = {0.5: "known", -5 * 24: "installation", 1.5: "installation", 24: "installation", 26: "unexplained", -12 * 24: "unexplained"}
    r = spark.createDataFrame([("d", 1, DAY + timedelta(hours=h), "v") for h in hours], "device_serial string, port int, datetime timestamp, variable string")
    got = {(x.datetime - DAY).total_seconds() / 3600: x.category for x in unattributed.classify_unattributed(r, w, known).collect()}
    assert got == hours


def test_episodes_and_runs(spark):
    r = spark.createDataFrame([("d", p, datetime(2024, 3, d), "v", "unexplained") for d, p in ((1, 3), (5, 4), (10, 5), (25, 8))], "device_serial string, port int, datetime timestamp, variable string, category string")
    got = [(x.moments, x.ports) for x in unattributed.unattributed_episodes(r).orderBy("first").collect()]
    assert got == [(3, "3-5"), (1, "8")]
    assert one(spark, unattributed.compact_runs(F.array(*map(F.lit, (8, 3, 4, 5, 3)))).alias("x")).x == "3-5, 8"


# --- text and units


@pytest.mark.parametrize(("text", "unit"), [("Â°C", "degC"), (" °F ", "degF"), ("W/m²", "W/m2"), ("m<U+00B3>/m<U+00B3>", "m3/m3"), ("furlong s", "furlongs"), (None, "")])
def test_units(spark, text, unit):
    assert one(spark, units.normalize_unit(F.lit(text).cast("string")).alias("x")).x == unit


def test_an_unknown_conversion_is_an_error(spark):
    with pytest.raises(Exception, match="No conversion from 'ft' to 'kPa'"):
        one(spark, units.convert_units(F.col("id").cast("double"), F.lit("ft"), F.lit("kPa")).alias("x"))


@pytest.mark.parametrize(
    ("text", "expected"),
    [("2023-11-06 10:45", datetime(2023, 11, 6, 14, 45)), ("2023-11-06 10:45:30", datetime(2023, 11, 6, 14, 45, 30)), ("1/2/2024 3:04 PM", datetime(2024, 1, 2, 19, 4)), ("1/2/2024 13:04", datetime(2024, 1, 2, 17, 4)), ("soon", None), ("", None), (None, None)],
)
def test_datetimes(spark, text, expected):
    assert one(spark, parsing.parse_datetime_flexible(F.lit(text).cast("string")).alias("x")).x == expected


@pytest.mark.parametrize(("text", "expected"), [("45000", datetime(2023, 3, 15, 4)), ("1/2/24", datetime(2024, 1, 2, 4)), ("2024-01-02", datetime(2024, 1, 2, 4)), ("1/2/0024", None), ("x", None)])
def test_coerced_datetimes(spark, text, expected):
    assert one(spark, parsing.coerce_datetime(F.lit(text)).alias("x")).x == expected


def test_file_names(spark):
    p = one(spark, parsing.parse_raw_filename(F.lit("z6-13368_20240101_20240131_20240201T0304Z_raw.csv")).alias("x")).x
    assert (p.device_serial, p.station_id, p.start_date, p.end_date, p.stamp) == ("z6-13368", None, date(2024, 1, 1), date(2024, 1, 31), "20240201T0304Z")
    assert one(spark, parsing.parse_raw_filename(F.lit("x_20240132_20240131_raw.csv")).alias("x")).x.stem is None
    assert one(spark, parsing.build_raw_filename(F.lit(datetime(2024, 1, 1, 3)), F.lit(datetime(2024, 1, 2, 5)), F.lit("a_hydro1")).alias("x")).x == "a_hydro1_20231231_20240102_raw.csv"
    assert one(spark, parsing.station_type_of(F.lit("a_b_hydro12")).alias("x")).x == "hydro"


@pytest.mark.parametrize(("text", "unit", "value"), [("4 7 3", "ft_in_8", (4 * 12 + 7 + 3 / 8) * 0.0254), ("4 12 3", "ft_in_8", None), ("4 7", "ft_in_8", None), ("1.482", "m", 1.482), ("-1", "m", None), ("2", "parsec", None)])
def test_rod_readings(spark, text, unit, value):
    r = one(spark, parsing.parse_rod_reading(F.lit(text), F.lit(unit)).alias("x")).x
    assert r.ok == (value is not None) and (r.value_m is None if value is None else abs(r.value_m - value) < 1e-9)


def test_agreeing_setups(spark):
    f = spark.createDataFrame([("p", 1, 0.10), ("p", 2, 0.13), ("p", 3, 0.135), ("q", 1, 0.5), ("r", 1, 0.1), ("r", 2, 0.2)], "pair string, setup int, fall double")
    got = {r.pair: (r.setup_a, r.setup_b, r.fall and round(r.fall, 6), r.agrees) for r in survey.select_agreeing_pair(f).collect()}
    assert got == {"p": (2, 3, 0.1325, True), "q": (1, None, 0.5, None), "r": (1, 2, None, False)}


def test_longest_prefix(spark):
    names = spark.createDataFrame([("ATMOS 41W",), ("teros 12",), ("other",), (None,)], "sensor string")
    known = spark.createDataFrame([("ATMOS",), ("ATMOS 41",), ("TEROS 12",)], "name string")
    got = {r.sensor: r.canonical for r in mapping.longest_prefix_join(names, known).collect()}
    assert got == {"ATMOS 41W": "ATMOS 41", "teros 12": "TEROS 12", "other": "other", None: None}


# --- changes, products, streaming


def test_scd2_records_only_what_changes(spark):
    at = [DAY + timedelta(days=k) for k in range(4)]
    rows = [("d", 1, at[0], "none", None, None, "ok"), ("d", 1, at[1], "T", "vwc", 10.0, "ok"), ("d", 1, at[2], "T", "vwc", 10.005, "ok"), ("d", 1, at[3], "none", None, None, "ok")]
    got = changes.scd2_apply_configs(spark.createDataFrame(rows, "sn string, port int, change_time timestamp, sensor string, type string, depth_cm double, status string")).orderBy("valid_from").collect()
    assert [(r.sensor, r.valid_from, r.valid_to) for r in got] == [("T", at[1], at[3]), ("none", at[3], None)]


def test_stale_reasons(spark):
    wanted = spark.createDataFrame([(1, ["a"], "x"), (2, ["a", "b"], "x"), (3, ["a"], "y"), (4, ["a"], "x"), (5, ["a"], "x"), (7, ["a"], "x")], "k int, inputs array<string>, fingerprint string")
    built = spark.createDataFrame([(2, ["a"], "x", "1"), (3, ["a"], "x", "1"), (4, ["a"], "x", "1"), (5, ["a"], "x", "0"), (6, ["a"], "x", "1"), (7, ["a"], None, "1")], "k int, inputs array<string>, fingerprint string, logic_version string")
    got = {r.k: r.reason for r in products.stale_partitions(wanted, built, ["k"]).collect()}
    assert got == {1: "not built", 2: "1 new inputs", 3: "metadata changed", 5: "logic changed", 6: "inputs no longer make it", 7: "no fingerprint"}
    unversioned = built.withColumn("logic_version", F.when(F.col("k") != 4, F.col("logic_version")))
    assert {r.k: r.reason for r in products.stale_partitions(wanted, unversioned, ["k"]).collect()} == {**got, 4: "logic changed"}


def test_stale_station_years_have_six_reasons(spark):
    wanted = spark.createDataFrame([(y, "s", ["a"], "m", "p") for y in (1, 2, 3, 4, 5, 6)] + [(7, "s", ["a", "b"], "m", "p")], "year int, station_id string, inputs array<string>, metadata_fingerprint string, ports_fingerprint string")
    rows = [(1, "m", "p", "1"), (1, "m", "p", "1"), (2, "other", "p", "1"), (3, "m", "other", "1"), (4, "m", "p", "1"), (4, "m", "p", None), (5, None, "p", "1"), (5, "m", "p", "1"), (7, "m", "p", "1"), (8, "m", "p", "1")]
    built = spark.createDataFrame([(y, "s", f"v{i}", ["a"], *r) for i, (y, *r) in enumerate(rows)], "year int, station_id string, variable string, inputs array<string>, metadata_fingerprint string, ports_fingerprint string, logic_version string")
    got = {r.year: r.reason for r in products.stale_station_years(wanted, built).collect()}
    assert got == {2: "metadata changed", 3: "ports changed", 4: "logic changed", 5: "no fingerprint", 6: "not built", 7: "1 new inputs", 8: "inputs no longer make it"}


def test_build_and_rebuild(spark, tmp_path):
    rows = [("st_hydro1", "level", "d", "instantaneous", datetime(2024, 1, 1, 3, 30) + timedelta(minutes=15 * k), float(k), "f", DAY, k, 1, "s", "m") for k in range(8)]
    r = spark.createDataFrame(rows, "station_id string, variable string, device_serial string, kind string, datetime timestamp, value double, source_file string, fetched_utc timestamp, row_seq long, port int, sensor string, measurement string")
    series, clean, problems = products.build_series(r)
    m = {x.year: (x.rows, x.observed, x.missing, x.inputs) for x in products.manifest(series, clean).collect()}
    assert m == {2023: (2, 2, 0, ["f"]), 2024: (6, 6, 0, ["f"])} and problems.count() == 0
    path = str(tmp_path / "p2")
    products.write_product(series, path)
    products.write_product(series.filter("year = 2024").withColumn("value", F.lit(0.0)), path)
    back = spark.read.parquet(path)
    assert {x.year: x.s for x in back.groupBy("year").agg(F.sum("value").alias("s")).collect()} == {2023: 1.0, 2024: 0.0}


def test_landing_is_idempotent(spark, tmp_path):
    src, out = str(tmp_path / "in"), [str(tmp_path / n) for n in ("readings", "log", "dirty", "ck")]
    rows = [("d", DAY + timedelta(hours=k), 1.0, f"f{k % 2}") for k in range(4)]
    df = spark.createDataFrame(rows, "device_serial string, datetime timestamp, value double, source_file string")
    df.write.parquet(src)
    for _ in range(2):
        landing.stream_land(spark.readStream.schema(df.schema).parquet(src), *out).awaitTermination()
    assert spark.read.parquet(out[0]).count() == 4
    assert sorted(r.n_records for r in spark.read.parquet(out[1]).collect()) == [2, 2]
    run = landing.run_of(spark, out[3])
    landing.land_batch(df, 0, *out[:3], run)
    assert spark.read.parquet(out[0]).count() == 4
    # a new checkpoint counts its batches from 0 again and overwrites nothing
    more, ck = str(tmp_path / "in2"), str(tmp_path / "ck2")
    df.withColumn("device_serial", F.lit("e")).write.parquet(more)
    landing.stream_land(spark.readStream.schema(df.schema).parquet(more), *out[:3], ck).awaitTermination()
    assert {(r.device_serial, r["count"]) for r in spark.read.parquet(out[0]).groupBy("device_serial").count().collect()} == {("d", 4), ("e", 4)}
    assert landing.run_of(spark, ck) != run
