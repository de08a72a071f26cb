"""Text exports in bulk: files with unknown preambles, with several header rows, and reports; a row a file is parsed in Spark.

A logger's export is small (a few thousand lines), so each file is one row with its whole text, and files are
what is dealt to tasks; their number has no bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.parsing import PROJECT_ZONE, coerce_datetime, parse_raw_filename
from ..functions.units import to_meters
from ..operators.lookups import filtered_view

#: Lines in which a header is looked for.
LOOK = 30
# Names of time columns, in the order in which they are tried.
TIME_NAMES = ("date.*time", "^date$", "^time$", "timestamp")


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of every file under a path, partition columns beside them."""
    return spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path")).withColumnRenamed("value", "text")


def pack_files(files: DataFrame, path: str) -> None:
    """Keep (file, text) as rows of a few large files: a store that opens, commits and lists a file for every export takes longer over that than over what they hold."""
    files.select("file", "text").write.parquet(path)


def packed_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of every file that pack_files() has put under a path, like whole_files()."""
    return spark.read.schema("file string, text string").parquet(path)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(filepath, size, modified, md5) of every file under a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("path").alias("filepath"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.md5("content").alias("md5"))


def _lines(text: Column) -> Column:
    return F.split(F.regexp_replace(F.regexp_replace(text, "^﻿", ""), r"(\r?\n)+\z", ""), r"\r?\n")


def cells(line: Column) -> Column:
    """The fields of a CSV line; commas in quotes part nothing, and quotes around a field go.

    One pass over the line: each field begins with a comma, of which one more stands at the front.  A quote that is never
    closed is a character like others.
    """
    parts = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',((?:[^,"]++|"(?:[^"]++|"")*+"|")*+)'), F.lit(1))
    return F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(F.trim(x), r'^"|"$', ""), '""', '"'))


def _place(values: Column, fits) -> Column:
    """Place (from 0) of the first value that fits; -1 if none does."""
    return F.coalesce(F.array_min(F.filter(F.transform(values, lambda v, i: F.when(fits(v), i)), lambda i: i.isNotNull())), F.lit(-1))


def read_preamble_csv(files: DataFrame, zone: str = PROJECT_ZONE) -> tuple[DataFrame, DataFrame]:
    """(rows, errors) of CSV files with an unknown number of lines above the header.

    files: file, text.  The header is the first of the first 30 lines that has as many fields as most of them have
    (over one).  The time column is found by name, else as the first whose values mostly parse.
    rows: file, line, serial (from the headers), time, values (a map by header).  errors: file, problem.
    """
    base = files.select("file", _lines(F.col("text")).alias("lines"))
    head = F.transform(F.slice("lines", 1, LOOK), cells)
    width = F.transform(head, lambda x: F.size(x))
    wide = F.filter(width, lambda w: w > 1)
    usual = F.array_max(F.transform(F.array_distinct(wide), lambda w: F.struct(F.size(F.filter(wide, lambda v: v == w)).alias("n"), w.alias("w"))))["w"]
    f = base.withColumns({"_w": width, "_usual": usual})
    f = f.withColumn("_at", F.when(F.col("_usual").isNotNull(), F.array_position("_w", F.col("_usual")).cast("int")))
    f = f.withColumn("header", F.when(F.col("_at") > 0, cells(F.element_at("lines", F.col("_at")))))
    body = F.filter(F.slice("lines", F.col("_at") + 1, F.greatest(F.size("lines") - F.col("_at"), F.lit(0))), lambda x: F.trim(x) != "")
    f = f.withColumn("body", F.when(F.col("_at") > 0, F.transform(body, cells)))
    named = F.coalesce(*[F.nullif(_place(F.col("header"), lambda h, p=p: F.lower(h).rlike(p)), F.lit(-1)) for p in TIME_NAMES])
    few = F.slice("body", 1, 20)
    parsed = F.transform(F.col("header"), lambda h, i: F.size(F.filter(few, lambda r: coerce_datetime(F.get(r, i), zone).isNotNull())))
    by_content = F.nullif(_place(parsed, lambda n: (n > 0) & (n * 4 > F.size(few) * 3)), F.lit(-1))
    serial = F.nullif(F.regexp_extract(F.array_join("header", "|"), r"LGR S/N: ([A-Za-z0-9-]+)", 1), F.lit(""))
    f = f.withColumns({"_t": F.coalesce(named, by_content), "serial": serial})
    problem = F.when(F.col("header").isNull(), "no header").when(F.size("body") == 0, "no rows").when(F.col("_t").isNull(), "no time column")
    f = f.withColumn("problem", problem)
    # no filter on what was parsed: Spark would push it below the parsing, and parse for the filter, too, once for every field it looks at
    rows = f.select("file", "serial", "header", "_t", F.posexplode_outer(F.when(F.col("problem").isNull(), F.col("body"))).alias("line", "row")).filter("line is not null")
    padded = F.transform(F.col("header"), lambda h, i: F.get("row", i))
    rows = rows.select("file", "line", "serial", coerce_datetime(F.get("row", F.col("_t")), zone).alias("time"), F.map_from_arrays(F.transform("header", lambda h, i: F.when(F.array_position("header", h) == i + 1, h).otherwise(F.concat(h, F.lit("_"), i.cast("string")))), padded).alias("values"))
    return rows, f.select("file", F.explode_outer(F.array("problem")).alias("problem")).filter("problem is not null")


def profile_exports(rows: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """A row a file: serial, start, end, n and median interval in minutes; and whether the serial is the expected one (file, serial)."""
    before = F.lag("time").over(Window.partitionBy("file").orderBy("time"))
    gap = (F.unix_micros("time") - F.unix_micros(before)) / 6e7
    r = rows.withColumn("_g", gap)
    out = r.groupBy("file").agg(F.first("serial").alias("serial"), F.min("time").alias("start"), F.max("time").alias("end"), F.count("*").alias("n"), F.percentile(F.when(F.col("_g") > 0, F.col("_g")), 0.5).alias("median_min"))
    if expected is None:
        return out
    e = expected.groupBy("file").agg(F.min("serial").alias("_e"))
    return out.join(e, "file", "left").withColumn("serial_agrees", F.col("serial") == F.col("_e")).drop("_e")


def read_multiheader_export(processed: DataFrame, raw: DataFrame) -> DataFrame:
    """Long readings of exports with three header rows (ports, sensors, `unit measurement`).

    processed and raw: device_sn, config, text.  The UTC offset of a row is the one at the same place in the raw file
    of its device and configuration; where there is none, or it is `Not Set`, the stamp is UTC already.  Ports from 7 on are internal.
    """
    p = processed.select("device_sn", "config", _lines(F.col("text")).alias("lines")).filter("size(lines) >= 4")
    heads = [cells(F.element_at("lines", i)) for i in (1, 2, 3)]
    body = F.filter(F.slice("lines", 4, F.size("lines")), lambda x: F.trim(x) != "")
    p = p.select("device_sn", "config", *[h.alias(n) for h, n in zip(heads, ("ports", "sensors", "units"), strict=True)], F.size(body).alias("_n"), F.posexplode(F.transform(body, cells)).alias("row_no", "row"))
    r = raw.select("device_sn", "config", _lines(F.col("text")).alias("lines")).filter("size(lines) >= 4")
    at = _place(cells(F.element_at("lines", 3)), lambda h: F.trim(h) == "UTC Offset")
    below = F.slice("lines", 4, F.size("lines"))
    r = r.withColumn("_at", at).filter("_at >= 0").select("device_sn", "config", F.size(below).alias("_m"), "_at", F.posexplode(F.transform(below, cells)).alias("row_no", "_row"))
    r = r.select("device_sn", "config", "row_no", "_m", F.get("_row", F.col("_at")).alias("utc_offset"))
    j = p.join(r, ["device_sn", "config", "row_no"], "left").withColumn("utc_offset", F.when(F.col("_m") == F.col("_n"), F.col("utc_offset")))
    local = F.try_to_timestamp(F.get("row", F.lit(0)), F.lit("MM/dd/yyyy hh:mm:ss a"))
    hours = F.coalesce(F.nullif(F.regexp_extract(F.coalesce("utc_offset", F.lit("")), r"^UTC([+-][0-9]{2}):", 1), F.lit("")).cast("int"), F.lit(0))
    long = j.withColumns({"datetime": local - F.make_dt_interval(hours=hours), "_c": F.explode(F.sequence(F.lit(1), F.size("ports") - 1))})
    port = F.regexp_extract(F.get("ports", F.col("_c")), r"^Port ?([0-9]+)$", 1).try_cast("int")
    words = F.filter(F.split(F.trim(F.get("units", F.col("_c"))), r"\s+"), lambda w: w != "")
    several = F.size(words) > 1
    return long.select(
        "device_sn", "config", "row_no", port.alias("port"), F.coalesce(port >= 7, F.lit(False)).alias("port_internal"), F.trim(F.get("sensors", F.col("_c"))).alias("sensor"),
        F.when(several, F.array_join(F.slice(words, 2, F.size(words)), " ")).otherwise(F.trim(F.get("units", F.col("_c")))).alias("measurement"), F.when(several, F.get(words, F.lit(0))).alias("unit"),
        "datetime", "utc_offset", F.get("row", F.col("_c")).try_cast("double").alias("value"),
    )


def _unit_code(word: Column) -> Column:
    w = F.lower(F.trim(word))
    return F.when(w.isin("m", "meter", "meters"), "m").when(w.isin("ft", "foot", "feet"), "ft").when(w.isin("yd", "yard", "yards"), "yd")


def read_measure_report(files: DataFrame) -> DataFrame:
    """A row a report (file, text): unit, legs (an array), total, total_m; or a problem, and then no numbers.

    Refused are reports without a known unit or a leg, legs that are no number, zero or less, or in another unit, and
    a number of legs other than the header's.
    """
    lines = F.transform(_lines(F.col("text")), lambda x: F.trim(x))
    after = lambda label: F.transform(F.filter(F.col("_l"), lambda x: x.startswith(label)), lambda x: F.trim(F.substr(x, F.lit(len(label) + 1))))
    f = files.withColumn("_l", lines)
    f = f.withColumns({"_unit": F.get(after("Units:"), F.lit(0)), "_said": F.get(after("Total Measurements:"), F.lit(0)).try_cast("int"), "_legs": after("Horizontal Distance:")})
    f = f.withColumns({"unit": _unit_code(F.col("_unit")), "legs": F.transform("_legs", lambda x: F.regexp_extract(x, r"^([-0-9.]+)", 1).try_cast("double")), "_words": F.transform("_legs", lambda x: _unit_code(F.regexp_replace(x, r"^[-0-9.]+", "")))})
    f = f.withColumn(
        "problem",
        F.when(F.col("_unit").isNull(), "no unit")
        .when(F.col("unit").isNull(), "unknown unit")
        .when(F.size("legs") == 0, "no leg")
        .when(F.exists("legs", lambda x: x.isNull()), "leg without a distance")
        .when(F.exists("legs", lambda x: x <= 0), "leg of zero or less")
        .when(F.exists("_words", lambda w: w.isNull() | (w != F.col("unit"))), "mixed units")
        .when(F.col("_said") != F.size("legs"), "other number of legs than declared"),
    )
    good = F.col("problem").isNull()
    total = F.aggregate("legs", F.lit(0.0), lambda a, x: a + x)
    return f.select("file", "problem", F.when(good, F.col("unit")).alias("unit"), F.when(good, F.col("legs")).alias("legs"), F.when(good, total).alias("total"), F.when(good, to_meters(total, F.col("unit"))).alias("total_m"))


def list_files_by_name(files: DataFrame, device: str | None = None, station: str | None = None) -> DataFrame:
    """Raw files by their names' parts, of one device or station if given, the oldest end first."""
    f = files.select("filepath", parse_raw_filename(F.element_at(F.split("filepath", "/"), -1)).alias("n")).select("filepath", "n.*").filter("start_date is not null")
    f = f.filter(F.col("device_serial") == device) if device else f
    f = f.filter(F.col("station_id") == station) if station else f
    return f.orderBy("end_date", "start_date", "filepath")


def list_partitions(product: DataFrame, station: str | None = None, variable: str | None = None, years: list[int] | None = None) -> DataFrame:
    """(station_id, variable, year) that a partitioned product holds; the filters prune partitions."""
    p = filtered_view(product, {k: v for k, v in (("station_id", station), ("variable", variable)) if v})
    p = p.filter(F.col("year").isin(years)) if years else p
    return p.select("station_id", "variable", "year").distinct()


def candidate_files(files: DataFrame, windows: DataFrame, log: DataFrame, years: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(logged, unlogged) files (station_id, year, filepath) that can hold readings of a station's local year; see marked_candidates()."""
    every = marked_candidates(files, windows, log, years)
    return every.filter("logged").drop("logged"), every.filter("not logged").drop("logged")


def marked_candidates(files: DataFrame, windows: DataFrame, log: DataFrame, years: DataFrame) -> DataFrame:
    """(station_id, year, filepath, logged) of files that can hold readings of a station's local year, in one pass.

    files: filepath, device_serial, start_date, end_date (days in their names).  windows: station_id, device_serial, starts,
    ends.  years: year, y0, y1.  A device counts in years that its windows touch, and a file from a day before the year on.
    """
    from ..operators.windows import devices_in_years

    d = devices_in_years(windows, years).join(years, "year")
    day = F.expr("interval 1 day")
    met = d.join(files, "device_serial").filter((F.col("start_date").cast("timestamp") <= F.col("y1")) & (F.col("end_date").cast("timestamp") >= F.col("y0") - day)).select("station_id", "year", "filepath").distinct()
    named = log.select("filepath").distinct().withColumn("_in_log", F.lit(True))
    return met.join(named, "filepath", "left").select("station_id", "year", "filepath", F.col("_in_log").isNotNull().alias("logged"))
