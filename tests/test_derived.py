"""Pairing, level, flags, chains, statuses and requests on small cases."""

import math

import pytest
from pyspark.sql import functions as F

from fieldseries.operators import decisions, derived, status, survey
from fieldseries.plans import products
from fieldseries.sources import scratch

PAIRING = "station_id string, baro_source string, priority int, valid_from string, valid_to string"


def times(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp") for n in names})


def test_pairing(spark):
    rows = [("g", "near", 1, "2024-01-01", "2024-01-10"), ("g", "far", 2, "2024-01-01", None), ("g", "over", 1, "2024-01-01", None), ("g", "nowhere", 3, "2024-01-01", None), ("g", "far", 4, "2024-01-02", "2024-01-02"), ("g", "far", 5, None, None)]
    zones = spark.createDataFrame([("g", "a"), ("near", "a"), ("far", "a"), ("over", "b"), ("nowhere", None)], "station_id string, zone string")
    usable, refused = derived.split_pairings(times(spark.createDataFrame(rows, PAIRING), "valid_from", "valid_to"), zones)
    assert sorted((r.baro_source, r.problem) for r in refused.collect()) == [("far", "ends before it starts"), ("far", "no start or no priority"), ("nowhere", "unknown zone"), ("over", "another zone")]
    assert usable.count() == 2
    air = times(spark.createDataFrame([("near", "2024-01-02", 100.0), ("far", "2024-01-02", 90.0), ("near", "2024-01-03", None), ("far", "2024-01-03", 91.0), ("far", "2024-01-03", 95.0), ("near", "2024-01-10", 99.0), ("far", "2024-01-10", 92.0), ("over", "2024-01-04", 1.0)], "station_id string, datetime string, value double"), "datetime")
    asked = times(spark.createDataFrame([("g", d) for d in ("2024-01-02", "2024-01-03", "2024-01-03", "2024-01-04", "2024-01-10", "2023-12-31", None)], "station_id string, datetime string"), "datetime")
    got = sorted((str(r.datetime)[:10], r.baro_source, r.baro_value, r.substituted) for r in derived.pair_barometers(asked, usable, air).collect())
    assert got == [("2023-12-31", None, None, None), ("2024-01-02", "near", 100.0, False), *[("2024-01-03", "far", 91.0, True)] * 2, ("2024-01-04", None, None, None), ("2024-01-10", "far", 92.0, False), ("None", None, None, None)]
    assert derived.pair_barometers(asked.limit(0), usable, air).count() == 0


@pytest.fixture
def gauge(spark):
    p = times(spark.createDataFrame([("g", "d1", "2024-06-01", 110.0, "observed", 4, "f1"), ("g", "d1", "2024-06-02", 110.0, "suspect", 4, "f1"), ("g", "d1", "2024-06-03", None, "missing", 4, "f2"), ("g", "d1", "2024-06-04", 110.0, "observed", 4, "f2")], "station_id string, unique_id string, datetime string, value double, flag string, product int, source_file string"), "datetime")
    air = times(spark.createDataFrame([("w", "2024-06-01", 100.0, 3, "w1"), ("x", "2024-06-02", 100.0, 2, "x1"), ("w", "2024-06-03", 100.0, 3, "w1"), ("x", "2024-06-01", 1.0, 2, "x1")], "station_id string, datetime string, value double, product int, source_file string"), "datetime")
    pairs = times(spark.createDataFrame([("g", "w", 1, "2024-01-01", None), ("g", "x", 2, "2024-01-01", None)], PAIRING), "valid_from", "valid_to")
    places = spark.createDataFrame([("g", "d1", 100.0, 0.05), ("w", None, 0.0, None), ("x", None, 100.0, None)], "station_id string, unique_id string, elev double, sensor_height_m double")
    return p, air, pairs, places


def test_level_and_its_lineage(spark, gauge):
    p, air, pairs, places = gauge
    got = {str(r.datetime)[:10]: r for r in derived.derive_level(p, pairs, air, places).collect()}
    lowered = 100 * math.exp(-100 * 9.80665 * 0.0289644 / (8.31446 * 288.15))
    assert got["2024-06-01"].value == pytest.approx((110 - lowered) / 9.80665 + 0.05)
    assert got["2024-06-02"].value == pytest.approx(10 / 9.80665 + 0.05)
    assert [(got[f"2024-06-0{d}"].flag, got[f"2024-06-0{d}"].product, got[f"2024-06-0{d}"].baro_source) for d in (1, 2, 3, 4)] == [("observed", 3, "w"), ("suspect", 2, "x"), ("missing", 3, "w"), ("missing", 4, None)]


@pytest.mark.parametrize("what", ["nothing", "pressure", "air", "pairing", "height", "file", "other station"])
def test_a_changed_input_makes_a_level_stale(spark, gauge, what):
    p, air, pairs, places = gauge
    zone, keys = "America/Puerto_Rico", ["station_id", "unique_id", "year"]
    m = derived.level_manifest(derived.derive_level(p, pairs, air, places), derived.wanted_levels(p, pairs, air, places, zone), zone, products.LOGIC_VERSION)
    assert [(r.rows, r.missing, r.substituted, r["product"], r.baro_sources, r.inputs) for r in m.collect()] == [(4, 2, 0, 2, ["w", "x"], ["f1", "f2", "w1", "x1"])]
    if what == "pressure":
        p = p.withColumn("value", F.col("value") + 1)
    if what == "air":
        air = air.withColumn("value", F.when(F.col("station_id") == "x", 2.0).otherwise(F.col("value")))
    if what == "pairing":
        pairs = pairs.withColumn("priority", 3 - F.col("priority"))
    if what == "height":
        places = places.withColumn("sensor_height_m", F.col("sensor_height_m") * 2)
    if what == "file":
        p = p.withColumn("source_file", F.lit("f9"))
    if what == "other station":
        places = places.union(spark.createDataFrame([("h", "d2", 1.0, 1.0)], places.schema))
    stale = products.stale_partitions(derived.wanted_levels(p, pairs, air, places, zone), m, keys).collect()
    assert len(stale) == (what not in ("nothing", "other station"))


def test_flags(spark):
    rows = [(1, "s", "2024-01-01", "2024-03-01", "suspect", None, "2024-05-01"), (2, "s", "2024-02-01", "2024-02-10", "estimated", 5.0, "2024-05-02"), (3, "s", "2024-02-05", "2024-02-06", "missing", None, "2024-05-03"), (4, "s", "2026-01-01", None, "manual", None, "2024-05-01"), (5, "s", "2024-01-01", "2024-01-02", "odd", None, "2024-05-01"), (6, "s", None, None, "suspect", None, "2024-05-01"), (7, "s", "2024-01-02", "2024-01-01", "suspect", None, "2024-05-01"), (8, "s", "2024-01-02", None, "suspect", 1.0, "2024-05-01")]
    d = times(spark.createDataFrame(rows, "decision_id int, series string, starts string, ends string, flag string, value double, decided_at string"), "starts", "ends", "decided_at")
    valid, refused = decisions.split_decisions(d)
    assert sorted(r.decision_id for r in refused.collect()) == [5, 6, 7, 8]
    day = lambda t: t and str(t)[:10]
    spans = sorted((day(r.starts), day(r.ends), r.decision_id) for r in decisions.cut_spans(valid, ["series"]).collect())
    assert spans == [("2024-01-01", "2024-02-01", 1), ("2024-02-01", "2024-02-05", 2), ("2024-02-05", "2024-02-06", 3), ("2024-02-06", "2024-02-10", 2), ("2024-02-10", "2024-03-01", 1), ("2026-01-01", None, 4)]
    series = times(spark.createDataFrame([("s", f"2024-{m}", v, "observed" if v else "missing") for m, v in (("01-01", 1.0), ("02-01", 1.0), ("02-04", None), ("02-05", 1.0), ("02-28", None), ("03-01", 1.0))] + [("s", "2030-01-01", 2.0, "observed"), ("t", "2024-01-01", 3.0, "observed")], "series string, datetime string, value double, flag string"), "datetime")
    got = sorted((r.series, day(r.datetime), r.value, r.flag, r.decision_id, r.recorded) for r in decisions.apply_flags(series, valid, ["series"]).collect())
    assert got == [("s", "2024-01-01", 1.0, "suspect", 1, 1.0), ("s", "2024-02-01", 5.0, "estimated", 2, 1.0), ("s", "2024-02-04", 5.0, "estimated", 2, None), ("s", "2024-02-05", None, "missing", 3, 1.0), ("s", "2024-02-28", None, "missing", 1, None), ("s", "2024-03-01", 1.0, "observed", None, 1.0), ("s", "2030-01-01", 2.0, "manual", 4, 2.0), ("t", "2024-01-01", 3.0, "observed", None, 3.0)]
    assert decisions.cut_spans(valid.limit(0), ["series"]).count() == 0


def test_spans_over_slices_are_put_together(spark):
    d = times(spark.createDataFrame([(1, "s", "1990-01-01", "2020-01-01", "suspect", None, "2024-01-01"), (2, "s", "2000-01-01", "2000-02-01", "manual", None, "2024-01-02")], "decision_id int, series string, starts string, ends string, flag string, value double, decided_at string"), "starts", "ends", "decided_at")
    assert sorted((str(r.starts)[:10], str(r.ends)[:10], r.decision_id) for r in decisions.cut_spans(d, ["series"]).collect()) == [("1990-01-01", "2000-01-01", 1), ("2000-01-01", "2000-02-01", 2), ("2000-02-01", "2020-01-01", 1)]


def test_a_chain_of_a_thousand_takes_ten_joins(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(survey.scratch, "written", lambda df, name, f=scratch.written: steps.append(name) or f(df, name))
    links = spark.range(1, 1001).selectExpr("id as node", "id - 1 as parent", "0.5d as value").unionByName(spark.createDataFrame([(2000, 2001, 1.0), (2001, 2000, 1.0), (2002, 2001, 1.0), (3000, 3000, 1.0)], "node long, parent long, value double"))
    heights, cyclic = survey.chain_heights(links)
    assert {(r.node, r.root, r.height, r.hops) for r in heights.collect()} == {(i, 0, i / 2, i) for i in range(1, 1001)}
    assert sorted(r.node for r in cyclic.collect()) == [2000, 2001, 2002, 3000]
    assert len(steps) <= 12  # the start, ten steps, and the one that finds cycles only
    assert survey.chain_heights(links.limit(0))[0].count() == 0


def test_long_surveys(spark):
    rows = [("a", "2024-01-01", "rebar_offset_cm", 150.0, "bed"), ("a", "2024-02-01", "rebar_offset_cm", 160.0, "bed"), ("a", "2024-01-01", "gzf_offset_cm", 100.0, "rebar"), ("a", "2024-01-01", "sensor_height_cm", -3.0, "bed"), ("b", "2024-01-01", "elev_rel_m", 2.0, "a"), ("c", "2024-01-01", "elev_rel_m", 1.0, "b"), ("b", "2024-01-01", "gzf_offset_cm", 10.0, "rebar"), ("d", "2024-01-01", "elev_rel_m", None, "a"), ("x", "2024-01-01", "elev_rel_m", 1.0, "x")]
    s = spark.createDataFrame(rows, "unique_id string, measured_on string, quantity string, value double, relative_to string")
    heights, cyclic, look = survey.relative_heights(s)
    got = {r.unique_id: tuple(r)[1:] for r in heights.collect()}
    assert got["a"] == (pytest.approx(1.6), pytest.approx(-0.03), pytest.approx(0.6), None, None)
    assert got["b"] == (None, None, None, 2.0, "a") and got["c"][3:] == (3.0, "a") and "d" not in got
    assert [r.node for r in cyclic.collect()] == ["x"] and [(r.unique_id, r.value) for r in look.collect()] == [("a", -3.0)]


def test_status_has_hysteresis_and_is_idempotent(spark):
    h = times(spark.createDataFrame([("a", "d1", "online", "2024-01-01", None), ("b", "d2", "nonresponsive", "2024-01-01", None), ("c", "d3", "nonresponsive", "2024-01-01", None), ("d", "d4", "online", "2024-01-01", None), ("e", "d5", "online", "2024-01-30", None), ("f", "d1", "removed", "2023-01-01", None), ("g", "d1", "online", "2023-01-01", "2024-01-01")], "unique_id string, device_serial string, status string, valid_from string, valid_to string"), "valid_from", "valid_to")
    seen = times(spark.createDataFrame([("d1", "2024-01-10"), ("d2", "2024-01-31"), ("d3", "2024-01-25"), ("d3", "2024-03-01"), (None, "2024-01-31")], "device_serial string, datetime string"), "datetime")
    found = status.status_changes(h, seen, "2024-02-01")
    assert sorted((r.unique_id, r.new_status) for r in found.collect()) == [("a", "nonresponsive"), ("b", "online"), ("d", "nonresponsive")]
    after = status.apply_status(h, found)
    assert after.count() == h.count() + 3 and after.filter("valid_to is null").count() == h.filter("valid_to is null").count()
    again = status.apply_status(after, status.status_changes(after, seen, "2024-02-01"))
    assert sorted(map(str, again.collect())) == sorted(map(str, after.collect()))
    with pytest.raises(ValueError):
        status.status_changes(h, seen, "2024-02-01", 1, 2)


def test_requests_prune_folders(spark):
    path = scratch.shared_folder(spark, "products")
    d = spark.range(4000).selectExpr("concat('s', id % 10) as station_id", "concat('v', id % 3) as variable", "timestamp'2020-01-01 12:00:00' + make_dt_interval(cast(id as int)) as datetime", "id")
    products.write_product(d.withColumn("year", F.year("datetime")), path)
    ask = times(spark.createDataFrame([(1, "s3", "v0", "2021-03-01", "2021-04-01"), (2, "s3", "v0", "2021-03-15", None), (3, "s3", None, "2021-01-01", None), (4, "s4", "v1", "2024-01-01", "2023-01-01")], "request int, station_id string, variable string, starts string, ends string"), "starts", "ends")
    out = derived.product_query(spark.read.parquet(path), ask, "UTC")
    rows = d.collect()
    want = {(q, r.id) for r in rows for q, a, b in ((1, "2021-03-01", "2021-04-01"), (2, "2021-03-15", "9999")) if r.station_id == "s3" and r.variable == "v0" and a <= str(r.datetime) < b}
    assert {(r.request, r.id) for r in out.collect()} == want and len(want) > 30
    assert "dynamicpruning" in out._jdf.queryExecution().toString().lower()
