from datetime import date, datetime

import pytest

from fieldseries.sources import tables


def test_typed_tables_report_what_they_cannot_type(spark, tmp_path):
    schema = {"id": "text", "n": "integer", "x": "number", "ok": "logical", "day": "date", "at": "datetime_local"}
    (tmp_path / "t.csv").write_text("id,n,x,ok,day,at\na,2,1e3,TRUE,2024-01-02,2024-01-02 10:00\nb,2.5,NA,maybe,,x\n")
    typed, errors = tables.read_typed_table(spark, str(tmp_path / "t.csv"), schema)
    a, b = typed.orderBy("id").collect()
    assert tuple(a) == ("a", 2, 1000.0, True, date(2024, 1, 2), datetime(2024, 1, 2, 14))
    assert tuple(b) == ("b", None, None, None, None, None)
    assert {(e["column"], e["value"]) for e in errors.collect()} == {("n", "2.5"), ("ok", "maybe"), ("at", "x")}
    typed, errors = tables.read_typed_table(spark, str(tmp_path / "none.csv"), schema)
    assert typed.count() == errors.count() == 0 and typed.columns == list(schema)
    with pytest.raises(ValueError, match="are not"):
        tables.read_typed_table(spark, str(tmp_path / "t.csv"), {"id": "text"})


def test_append_by_name(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    assert [tuple(r) for r in tables.append_by_name(target, spark.createDataFrame([(2,)], "k int")).collect()] == [(2, None)]
    with pytest.raises(ValueError, match="unknown"):
        tables.append_by_name(target, spark.createDataFrame([(2,)], "z int"))


def test_four_shapes_in_one_form(spark):
    hobo = spark.createDataFrame(
        [(1, "01/02/24 10:15:00 AM", "91.99", "x", ""), (2, "01/02/24 10:30:00 AM", "bad", "y", ""), (3, None, "1", "z", "")],
        ["#", "Date Time, GMT-04:00", "Abs Pres, kPa (LGR S/N: 123, SEN S/N: 123, LBL: a)", "Note, text", "Temp, C"],
    )
    got = tables.read_readings_long(hobo, "f").orderBy("datetime").collect()
    assert [(r.device_serial, r.datetime, r.measurement, r.unit, r.value) for r in got] == [("123", datetime(2024, 1, 2, 14, 15), "Abs Pres", "kPa", 91.99), ("123", datetime(2024, 1, 2, 14, 30), "Abs Pres", "kPa", None)]
    link = spark.createDataFrame([(datetime(2024, 1, 2, 10), 90.0, 20.0, 1)], "datetime timestamp, water_pressure_kpa double, water_temp_c double, line_no int")
    zentra = spark.createDataFrame([("z6-1", datetime(2024, 1, 2), 1, "ATMOS", "Rain", "mm", 1.0, 0)], "device_id string, datetime timestamp, port_num int, sensor_name string, measurement string, unit string, value double, error_code int")
    export = spark.createDataFrame([("z6-1", datetime(2024, 1, 2), 1, "ATMOS", "Rain", "mm", 1.0)], "device_sn string, timestamp_utc timestamp, port int, sensor string, measurement string, unit string, value double")
    every = tables.union_readings([tables.read_readings_long(d, "f", "9") for d in (hobo, link, zentra, export)])
    assert every.count() == 6
    assert {r.datetime for r in every.filter("source = 'hobolink'").collect()} == {datetime(2024, 1, 2, 14)}
    with pytest.raises(ValueError, match="unknown shape"):
        tables.detect_shape(["a"])
    assert tables.header_offset_hours("Date Time, GMT+05:30") == 5.5
