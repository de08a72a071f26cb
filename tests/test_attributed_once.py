"""Readings meet what is known of their device in one join, whichever path they take."""

from datetime import datetime

from fieldseries.operators import attribution


def test_readings_are_joined_once(spark):
    w = spark.createDataFrame([("d", "a", "wx", 1, datetime(2020, 1, 1), None), ("e", "b", "wx", 2, datetime(2020, 1, 1), None), ("f", "c", "soil", 3, datetime(2023, 1, 1), datetime(2024, 1, 1))], "device_serial string, station_id string, station_type string, unique_id long, starts timestamp, ends timestamp")
    # d's only port closed years before its reading: it is a device with ports all the same
    p = spark.createDataFrame([("d", 1, "wx", "s", 0.0, datetime(2020, 1, 1), datetime(2020, 2, 1)), ("f", 1, "soil", "old", 10.0, datetime(2023, 1, 1), None), ("f", 1, "soil", "new", 20.0, datetime(2023, 6, 1), None), ("f", None, "soil", "lost", 30.0, datetime(2023, 1, 1), None)], "device_serial string, port int, type string, sensor string, depth_cm double, starts timestamp, ends timestamp")
    r = spark.createDataFrame([("d", 1, datetime(2024, 5, 1), "v", False, False), ("d", 1, datetime(2020, 1, 5), "v", False, False), ("e", 1, datetime(2024, 5, 1), "v", False, False), ("f", 1, datetime(2023, 3, 1), "v", True, False), ("f", 1, datetime(2023, 7, 1), "v", True, False), ("f", 2, datetime(2023, 7, 1), "v", True, False), ("f", None, datetime(2023, 7, 1), "v", True, False), ("d", 1, datetime(2024, 5, 1), "p", False, True), ("e", 1, datetime(2024, 5, 1), "p", False, True), ("x", 1, datetime(2024, 5, 1), "v", False, False), ("e", 1, None, "v", False, False)], "device_serial string, port int, datetime timestamp, variable string, depth boolean, device_level boolean")
    known, lost = attribution.attribute_readings(r, w, p)
    got = sorted((x.device_serial, x.station_id, x.sensor or "", x.series) for x in known.collect())
    assert got == [("d", "a", "s", "v"), ("e", "b", "", "p"), ("e", "b", "", "v"), ("f", "c", "new", "v_20cm"), ("f", "c", "old", "v_10cm")]
    assert known.count() + lost.count() == r.count()
    plan = lost._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.count("Join FullOuter") == 0
