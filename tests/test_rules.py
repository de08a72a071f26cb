"""Rules in few passes, project-local days, and the operators that no longer gather a key in one task."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fieldseries import network as net
from fieldseries.operators import changes, lookups, monitor, quality, rules, topk
from fieldseries.sources import files, scratch, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def network(spark):
    """Every table of the network in a folder of its own, so that a plan shows which of them it reads."""
    n = net.network(spark, SF)
    held = {t: scratch.written(getattr(n, t), f"net_{t}") for t in ("deployments", "ports", "downloads", "files", "maintenance", "pending", "profiles")}
    return rules.Network(**held, texts=n.texts)


def scans(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    found: dict[str, int] = {}
    for t in re.findall(r"FileScan parquet [^\n]*?/net_(\w+)-", plan):
        found[t] = found.get(t, 0) + 1
    return found


def test_all_rules_read_each_table_at_most_twice(spark, network, monkeypatch):
    claims = []
    monkeypatch.setattr(rules.scratch, "written", lambda df, name, f=scratch.written: claims.append(scans(df)) or f(df, name))
    found = scans(rules.violations(network))
    both = {t: found.get(t, 0) + claims[0].get(t, 0) for t in {*found, *claims[0]}}
    assert len(claims) == 1 and max(both.values()) <= 2 and set(both) == {"deployments", "ports", "downloads", "files", "maintenance", "pending", "profiles"}


def test_all_rules_at_once_are_each_rule_alone(network):
    whole = sorted(map(str, rules.violations(network).collect()))
    alone = sorted(str(r) for name in rules.RULES for r in rules.violations(network, [name]).collect())
    assert whole == alone and len(whole) > 100
    told = {r.rule: (r.n, r.passed) for r in rules.summary(network).collect()}
    assert set(told) == set(rules.RULES) and sum(n for n, _ in told.values()) == len(whole) and all(p == (n == 0) for n, p in told.values())


def test_absent_columns_and_empty_tables(network):
    gone = rules.Network(**{**network.__dict__, "deployments": network.deployments.drop("mfger")})
    assert [(r.key, r.detail) for r in rules.violations(gone, ["REQUIRED_FIELD_NA"]).collect() if r.detail == "mfger"] == [(None, "mfger")]
    empty = rules.Network(**{k: v.limit(0) if k != "texts" else v for k, v in network.__dict__.items()})
    assert rules.violations(empty).count() == 0 and rules.summary(empty).count() == len(rules.RULES)


def test_keys_that_look_alike_are_not_one(spark, network):
    d = network.deployments.limit(0).select("device_serial", "station_type", "status")
    rows = spark.createDataFrame([("a|b", "c", "online"), ("a", "b|c", "online"), (None, "x", "online"), (None, "x", "online")], d.schema)
    n = rules.Network(**{**network.__dict__, "deployments": network.deployments.limit(0).unionByName(rows, allowMissingColumns=True)})
    assert [(r.key, r.detail) for r in rules.violations(n, ["MULTIPLE_ACTIVE_SERIAL_SAME_TYPE"]).collect()] == [("x", "2")]


def test_the_last_visit_ends_with_the_local_day(spark):
    schema = "unique_id string, device_serial string, status string, deploy_datetime timestamp, last_visit date, last_record timestamp"
    start, visit = datetime(2024, 1, 1), date(2024, 6, 1)
    rows = [("in", "a", "removed", start, visit, datetime(2024, 6, 2, 3, 59, 59)), ("late", "b", "removed", start, visit, datetime(2024, 6, 2, 4, 0, 0)), ("n1", None, "removed", start, visit, datetime(2030, 1, 1)), ("n2", None, "removed", start, visit, datetime(2030, 1, 1)), ("early", "c", "online", start, None, datetime(2023, 12, 31)), ("next", "d", "removed", start, None, datetime(2024, 3, 2)), ("next2", "d", "online", datetime(2024, 3, 1), None, None)]
    df = spark.createDataFrame(rows, schema)
    assert sorted(r.unique_id for r in quality.outside_deployment(df).collect()) == ["early", "late", "next"]
    assert sorted(r.unique_id for r in quality.outside_deployment(df, "UTC").collect()) == ["early", "in", "late", "next"]


def test_numbers_go_on_over_ranges(spark):
    new = spark.range(5000).selectExpr("case when id % 100 = 7 then null when id % 2 = 0 then 'h' else 'w' end as p", "id", "'x' as more").repartition(7)
    old = spark.createDataFrame([("h-0009",), ("h-0002",), ("odd",), ("w-12000",), (None,)], "unique_id string")
    out = changes.next_ids(new, old, F.col("p"), ["id"]).collect()
    assert len(out) == 5000 and all((r.unique_id is None) == (r.p is None) for r in out)
    for p, first in (("h", 10), ("w", 12001)):
        assert [r.unique_id for r in sorted((r for r in out if r.p == p), key=lambda r: r.id)] == [f"{p}-{k:04d}" for k in range(first, first + sum(r.p == p for r in out))]
    assert changes.next_ids(new.limit(0), old, F.col("p"), ["id"]).count() == 0


def test_samples_are_cut_before_rows_move(spark):
    v = spark.range(5000).selectExpr("if(id < 4990, 'r', 'q') as rule", "cast(id as string) as key", "'d' as detail").repartition(8)
    s = topk.samples(v, 3)
    assert [r.key for r in s.filter("rule = 'r'").orderBy("place").collect()] == ["0", "1", "10"]
    assert "WindowGroupLimit" in s._jdf.queryExecution().executedPlan().toString()


def test_cells_of_a_line(spark):
    lines = ["a,b", '"x, y",z', '"say ""hi"", you",2', 'in "quo,ted" field,3', 'never "closed,4', ",", "", "a,,c", " spaced , q ", '"' + "long," * 20_000 + '",end']
    want = [["a", "b"], ["x, y", "z"], ['say "hi", you', "2"], ['in "quo,ted" field', "3"], ['never "closed', "4"], ["", ""], [""], ["a", "", "c"], ["spaced", "q"], ["long," * 20_000, "end"]]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "i int, t string").select("i", files.cells(F.col("t")).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == want


def test_unpivoting_scans_when_the_plan_runs(spark):
    wide = spark.createDataFrame([(1, "t1", "3.5", "x", None)], "`#` int, `Date Time, GMT-04:00` string, `Temp, C (LGR S/N: 7, SEN S/N: 7)` string, `Note, text` string, `Rain, mm` double")
    bad = wide.withColumn("Temp, C (LGR S/N: 7, SEN S/N: 7)", F.raise_error(F.lit("read too early")).cast("string"))
    tables.unpivot_header_coded(bad, [], "Date Time, GMT-04:00")  # nothing is read while the plan is built
    assert [(r.measurement, r.unit, r.serial, r.value) for r in tables.unpivot_header_coded(wide, [], "Date Time, GMT-04:00").collect()] == [("Temp", "C", "7", 3.5)]


def test_breaks_are_rows(spark):
    r = spark.createDataFrame([("d", "f1", datetime(2024, 1, 1)), ("d", "f1", datetime(2024, 1, 2)), ("d", "f2", datetime(2024, 1, 2, 12)), ("d", "f3", datetime(2024, 1, 3, 1)), ("e", "f1", datetime(2024, 1, 9))], "device_serial string, source_file string, datetime timestamp")
    got = [(g.device_serial, g.after_file, g.before_file, g.hours) for g in monitor.coverage_gaps(r).collect()]
    assert got == [("d", "f2", "f3", 13.0)]


def test_defaults_have_no_hot_key(spark):
    t = spark.createDataFrame([("a", date(2020, 1, 1)), (lookups.DEFAULT, date(2021, 1, 1))], "station_id string, confirmed_from date")
    out = lookups.lookup_with_default(spark.createDataFrame([("a",), ("b",), (None,)], "station_id string"), t, "station_id", "confirmed_from", "2000-01-01")
    assert sorted((str(r.station_id), str(r.confirmed_from)) for r in out.collect()) == [("None", "2021-01-01"), ("a", "2020-01-01"), ("b", "2021-01-01")]
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
