"""What a row is parsed for is parsed once, however many fields and filters look at it."""

from pyspark.sql import functions as F

from fieldseries.functions import parsing
from fieldseries.sources import files


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_rod_reading_is_split_once(spark):
    d = spark.createDataFrame([("5 3 7",), (" 1, 2/ 9",), ("1 2",), ("",), ("1 x 2",)], "t string")
    p = d.select(parsing.parse_rod_reading(F.col("t"), F.lit("ft_in_8")).alias("p")).select("p.ok", "p.value_m", "p.message")
    assert _optimized(p).count("split(") == 1
    assert [(r.ok, r.message) for r in p.collect()] == [(True, None), (False, "eighths over 7"), (False, "three numbers needed"), (False, "empty"), (False, "no number, or below zero")]


def test_a_file_name_is_taken_apart_once_and_candidates_come_out_of_one_pass(spark):
    d = spark.createDataFrame([("raw/1_20240101_20240102_raw.csv",), ("raw/st_wx1_20240105_20240103_raw.csv",), ("raw/x\n_20240101_20240102_raw.csv",)], "filepath string")
    named = d.select("filepath", parsing.parse_raw_filename(F.col("filepath")).alias("n")).select("filepath", "n.*")
    assert _optimized(named).count("regexp_extract(") == 5
    assert [r.device_serial for r in d.select(parsing.parse_raw_filename(F.element_at(F.split("filepath", "/"), -1)).alias("n")).select("n.*").collect()] == ["1", None, None]
    years = spark.sql("select 2024 as year, timestamp'2024-01-01 04:00:00' as y0, timestamp'2025-01-01 04:00:00' as y1")
    windows = spark.sql("select 'st1' as station_id, '1' as device_serial, timestamp'2024-01-01' as starts, cast(null as timestamp) as ends")
    log = spark.sql("select 'b' as filepath")
    f = spark.sql("select x as filepath, '1' as device_serial, date'2024-02-01' as start_date, date'2024-02-02' as end_date from values ('a'), ('b') as t(x)")
    marked = files.marked_candidates(f, windows, log, years)
    assert sorted((r.filepath, r.logged) for r in marked.collect()) == [("a", False), ("b", True)]
    logged, unlogged = files.candidate_files(f, windows, log, years)
    assert [r.filepath for r in logged.collect()] == ["b"] and [r.filepath for r in unlogged.collect()] == ["a"]


def test_values_and_their_errors_come_out_of_one_reading(spark, tmp_path):
    from fieldseries.sources import named

    rows = [("2024-01-02 03:04:05", "st1", "1", "2024-01-01 00:00:00", "soon", "x", "f"), ("NA", "st1", "", "2024-02-30 10:00:00", "NA", "7", "g")]
    spark.createDataFrame(rows, list(named.SCHEMAS["downloads"])).write.option("header", True).option("quoteAll", True).csv(f"{tmp_path}/downloads")
    whole = named.load_whole_tables(spark, str(tmp_path))
    assert _optimized(whole["downloads"]).count("Relation") == 1 and whole["ports"].count() == 0
    got = {r.filepath: (r.timestamp_utc is None, r.n_records, [tuple(e) for e in r._errors]) for r in whole["downloads"].collect()}
    assert got == {"f": (False, None, [("end_date", "soon"), ("n_records", "x")]), "g": (True, 7, [("start_date", "2024-02-30 10:00:00")])}
    typed, errors = named.load_named_tables(spark, str(tmp_path))["downloads"]
    assert typed.count() == 2 and sorted((r.column, r.value) for r in errors.collect()) == [("end_date", "soon"), ("n_records", "x"), ("start_date", "2024-02-30 10:00:00")]


def test_rules_gather_sums_only_and_so_need_no_sorting(spark):
    from fieldseries import network as net
    from fieldseries.operators import rules

    n = net.network(spark, "/root/testdata/sf0.001")
    plan = rules.violations(n, [r for r in rules.RULES if r not in rules._LOGGED])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    logged = rules._claims(n, {}, True)
    assert "SortAggregate" not in logged._jdf.queryExecution().executedPlan().toString()
    assert logged.count() == n.downloads.select("filepath", "start_date", "end_date", "n_records").distinct().count()


def test_keyed_tables_keep_all_partitions(spark):
    """Spark would merge these few rows into one task."""
    from fieldseries.operators import changes, quality

    ports = spark.range(100).selectExpr("cast(id % 10 as string) as sn", "cast(null as timestamp) as valid_to")
    closed = changes.close_ports(ports, spark.sql("select '3' as sn, timestamp'2024-01-01' as closed_at"), ["sn"])
    assert "REPARTITION_BY_NUM" in closed._jdf.queryExecution().executedPlan().toString()
    assert closed.filter("valid_to is not null").count() == 10
    twice = quality.duplicates("D", "t", ports, ["sn"]).violations
    lone = quality.orphans("O", "t", ports, "sn", spark.sql("select explode(array('1', '1', null)) as k"), "k").violations
    assert all("REPARTITION_BY_NUM" in d._jdf.queryExecution().executedPlan().toString() for d in (twice, lone))
    assert twice.count() == 10 and lone.count() == 90
