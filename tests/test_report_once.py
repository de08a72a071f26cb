"""Both parts of a report's episodes are read from one written table."""

from datetime import datetime, timedelta

from fieldseries.plans import build


def test_episodes_are_written_once(spark):
    none = spark.sql("select 1 as x").filter("false")
    m = spark.sql("select 1L as rows, 0L as missing, 0L as conflicts, 0L as repeats")
    lost = spark.createDataFrame([("d", 1, datetime(2024, 1, 1) + timedelta(days=n), "v") for n in (0, 1, 300)], "device_serial string, port int, datetime timestamp, variable string")
    windows = spark.sql("select 'd' as device_serial, timestamp'2030-01-01' as starts")
    known = spark.sql("select 1 as rank, 'e' as device_serial, cast(null as int) as port, timestamp'2024-01-01' as `from`, cast(null as timestamp) as to, 'x' as reason")
    report = build.build_report(build.Build(none, m, none, lost, none, none, none), windows, known, "2024-11-01", recent_days=30)
    assert [report[k].count() for k in ("recent", "older")] == [1, 1] and report["totals"].first().products == 1
    assert all("Aggregate" not in report[k]._jdf.queryExecution().optimizedPlan().toString() for k in ("recent", "older"))
