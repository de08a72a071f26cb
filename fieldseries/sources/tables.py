"""Typed tables from delimited text: exact headers, strict types, bad values reported and never nulled silently."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import PROJECT_ZONE, parse_date_flexible, parse_datetime_flexible

#: Kinds that a column can be declared as.
KINDS = ("text", "integer", "number", "logical", "date", "datetime_local", "datetime_utc")


def _typed(kind: str, raw: Column) -> Column:
    number = raw.try_cast("double")
    if kind == "text":
        return raw
    if kind == "integer":
        return F.when(number == F.rint(number), number.cast("bigint"))
    if kind == "number":
        return number
    if kind == "logical":
        return F.when(F.upper(raw) == "TRUE", True).when(F.upper(raw) == "FALSE", False)
    if kind == "date":
        return parse_date_flexible(raw)
    return parse_datetime_flexible(raw, "UTC" if kind == "datetime_utc" else PROJECT_ZONE)


def _text(raw: DataFrame, schema: dict[str, str]) -> DataFrame:
    if raw.columns != list(schema):
        raise ValueError(f"columns {raw.columns} are not {list(schema)}")
    return raw.select(*[F.when(~F.trim(c).isin("", "NA"), F.trim(c)).alias(c) for c in schema])


def conform(raw: DataFrame, schema: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(typed rows, errors) of an all-text frame; "" and NA are missing.

    errors: row (as text), column, value of every value that cannot be its type.  Other columns, or others' order, are refused.
    """
    text = _text(raw, schema)
    typed = text.select(*[_typed(k, F.col(c)).alias(c) for c, k in schema.items()])
    return typed, _with_errors(text, schema).select(F.to_json("_text").alias("row"), F.explode("_errors").alias("e")).select("row", "e.column", "e.value")


def _with_errors(text: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Typed rows with their text and `_errors`; each value is typed once."""
    both = text.select(F.struct(*schema).alias("_text"), *[_typed(k, F.col(c)).alias(c) for c, k in schema.items()])
    bad = [F.when(F.col("_text")[c].isNotNull() & F.col(c).isNull(), F.struct(F.lit(c).alias("column"), F.col("_text")[c].alias("value"))) for c, k in schema.items() if k != "text"]
    none = F.array().cast("array<struct<column:string,value:string>>")
    return both.withColumn("_errors", F.array_compact(F.array(*bad)) if bad else none)


def conform_whole(raw: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Typed rows with `_errors`, an array of (column, value) of a row's values that cannot be their type: conform() in one pass."""
    return _with_errors(_text(raw, schema), schema).drop("_text")


def read_text_table(spark: SparkSession, path: str, schema: dict[str, str]) -> DataFrame:
    """A CSV file with a header, as text; a missing file is an empty table."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in schema])
    jvm = spark._jvm.org.apache.hadoop.fs
    where = jvm.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], text)
    return spark.read.option("header", True).csv(path)


def read_typed_table(spark: SparkSession, path: str, schema: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """conform() of a CSV file with a header; a missing file is an empty table."""
    return conform(read_text_table(spark, path, schema), schema)


def append_by_name(target: DataFrame, rows: DataFrame) -> DataFrame:
    """rows in the target's columns by name; absent ones are null, unknown ones refused."""
    unknown = set(rows.columns) - set(target.columns)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    return target.limit(0).unionByName(rows, allowMissingColumns=True)


#: `Measure, unit (LGR S/N: n, SEN S/N: n, LBL: x)`
HEADER = r"^\s*(.*?)\s*,\s*([^(]*?)\s*(?:\(LGR S/N:\s*([^,)]+)[^)]*\))?\s*$"
# Headers of counters.
COUNTERS = ("#", "", "no", "no.", "n", "index", "record")


def unpivot_header_coded(wide: DataFrame, ids: list[str], time: str) -> DataFrame:
    """One row a reading and measure of a wide export whose headers carry measure, unit and serial.

    Counters, the time column, headers without a unit and columns without a number are skipped; a text that
    is no number is null.  No measure column is an error.
    """
    coded = [c for c in wide.columns if c not in ids and c != time and c.strip().lower() not in COUNTERS and "," in c]
    if time not in wide.columns or not coded:
        raise ValueError("no time column or no measure column")
    # names with dots or commas are quoted; values are compared as text
    long = wide.select(*ids, F.col(f"`{time}`").alias("time"), F.explode(F.array(*[F.struct(F.lit(c).alias("header"), F.col(f"`{c}`").cast("string").try_cast("double").alias("value")) for c in coded])).alias("m"))
    # a row a column at most, so it goes to every task; it is found out when the plan runs
    real = long.filter("m.value is not null").select(F.col("m.header").alias("header")).distinct()
    out = long.select(*ids, "time", "m.header", "m.value").join(F.broadcast(real), "header", "left_semi")
    part = lambda i: F.nullif(F.regexp_extract("header", HEADER, i), F.lit(""))
    return out.select(*ids, "time", part(1).alias("measurement"), part(2).alias("unit"), part(3).alias("serial"), "value")


def header_offset_hours(header: str) -> float | None:
    """Hours east of UTC that a time header such as `Date Time, GMT-04:00` declares, minutes included."""
    import re

    m = re.search(r"GMT([+-])(\d{1,2}):?(\d{2})?", header)
    return None if not m else (1 if m[1] == "+" else -1) * (int(m[2]) + int(m[3] or 0) / 60)


# The columns that give a raw reading file's shape away.
SHAPES = {
    "zentra": {"port_num", "sensor_name", "measurement", "value"},
    "zentra_export": {"timestamp_utc", "port", "sensor", "measurement", "value"},
    "hobolink": {"datetime", "water_pressure_kpa"},
}


def detect_shape(columns: list[str]) -> str:
    """The shape of a raw file by its columns; a date header with an offset is a logger export; else an error."""
    for name, need in SHAPES.items():
        if need <= set(columns):
            return name
    if any(c.lower().startswith("date time") for c in columns):
        return "hobo"
    raise ValueError(f"unknown shape: {columns}")


def read_readings_long(raw: DataFrame, source_file: str, device_serial: str | None = None, zone: str = PROJECT_ZONE) -> DataFrame:
    """Any of the four shapes in the long form: UTC times, rows without a time dropped, source_file attached."""
    shape = detect_shape(raw.columns)
    null = lambda t: F.lit(None).cast(t)
    if shape == "zentra":
        out = raw.select(F.col("device_id").cast("string").alias("device_serial"), F.col("datetime").cast("timestamp").alias("datetime"), F.lit("zentra").alias("source"), F.col("port_num").cast("int").alias("port"), F.col("sensor_name").alias("sensor"), "measurement", "unit", F.col("value").cast("double").alias("value"), F.col("error_code").cast("int").alias("error_code"))
    elif shape == "zentra_export":
        out = raw.select(F.col("device_sn").cast("string").alias("device_serial"), F.col("timestamp_utc").cast("timestamp").alias("datetime"), F.lit("zentra").alias("source"), F.col("port").cast("int").alias("port"), "sensor", "measurement", "unit", F.col("value").cast("double").alias("value"), null("int").alias("error_code"))
    elif shape == "hobolink":
        measures = [c for c in raw.columns if c not in ("datetime", "line_no")]
        long = raw.unpivot(["datetime"], measures, "measurement", "value")
        when = F.to_utc_timestamp(F.col("datetime").cast("timestamp"), zone)
        out = long.select(F.lit(device_serial).alias("device_serial"), when.alias("datetime"), F.lit("hobolink").alias("source"), null("int").alias("port"), null("string").alias("sensor"), "measurement", null("string").alias("unit"), F.col("value").cast("double").alias("value"), null("int").alias("error_code"))
    else:
        time = next(c for c in raw.columns if c.lower().startswith("date time"))
        hours = header_offset_hours(time)
        local = F.try_to_timestamp("time", F.lit("MM/dd/yy hh:mm:ss a"))
        when = F.to_utc_timestamp(local, zone) if hours is None else local - F.expr(f"interval {round(hours * 3600)} seconds")
        long = unpivot_header_coded(raw, [], time)
        out = long.select(F.coalesce(F.lit(device_serial).cast("string"), "serial").alias("device_serial"), when.alias("datetime"), F.lit("hobo").alias("source"), null("int").alias("port"), null("string").alias("sensor"), "measurement", "unit", "value", null("int").alias("error_code"))
    return out.filter("datetime is not null").withColumn("source_file", F.lit(source_file))


def union_readings(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
