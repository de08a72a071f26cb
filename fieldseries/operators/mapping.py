"""Naming, converting and filtering raw measurements through a variable registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.units import convert_units, normalize_unit


def registry_fallback_join(readings: DataFrame, registry: DataFrame, fields: list[str]) -> DataFrame:
    """readings (source, sensor, measurement) with the registry's fields and `known`: by the exact key, else by the
    key whose sensor is blank.  Spark broadcasts the registry while its size allows."""
    reg = registry.withColumn("sensor", F.coalesce("sensor", F.lit("")))
    exact = reg.select("source", "sensor", "measurement", F.struct(*fields).alias("_e"))
    wild = reg.filter("sensor = ''").select("source", "measurement", F.struct(*fields).alias("_d"))
    out = readings.join(exact, ["source", "sensor", "measurement"], "left").join(wild, ["source", "measurement"], "left")
    pick = F.coalesce("_e", "_d")
    return out.withColumns({"known": pick.isNotNull(), **{f: pick[f] for f in fields}}).drop("_e", "_d")


def count_unmapped(readings: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows by source, sensor and measurement that the registry does not know: removed from a product but never silently."""
    joined = registry_fallback_join(readings, registry, ["keep"])
    return joined.filter("not known").groupBy("source", "sensor", "measurement").agg(F.count("*").alias("rows"))


def map_measurements(readings: DataFrame, registry: DataFrame) -> DataFrame:
    """Known and kept readings with variable, kind and depth, in the registry's unit.

    A missing unit falls back to the registry's source unit, and to `count` for counts.  A reading with a
    nonzero error code keeps its row and loses its value.  A unit without a conversion is an error.
    """
    m = registry_fallback_join(readings, registry.withColumnRenamed("unit", "to_unit"), ["keep", "variable", "to_unit", "kind", "depth", "source_unit"])
    m = m.filter(F.col("known") & F.col("keep"))
    unit = normalize_unit(F.coalesce(F.nullif(F.trim("unit"), F.lit("")), "source_unit"))
    unit = F.when((unit == "") & (F.col("to_unit") == "count"), "count").otherwise(unit)
    value = convert_units(F.col("value"), unit, F.col("to_unit"))
    ok = F.coalesce(F.col("error_code"), F.lit(0)) == 0
    return m.withColumn("value", F.when(ok, value)).withColumn("unit", F.col("to_unit")).drop("known", "keep", "to_unit", "source_unit")


def longest_prefix_join(names: DataFrame, known: DataFrame, name: str = "sensor") -> DataFrame:
    """Each name with `canonical`: the longest known name it begins with (ignoring case), else itself.

    A name's prefixes are joined by equality, so the work grows with the names and not with names times
    known names; distinct names are matched once.
    """
    keys = known.select(F.lower("name").alias("_p"), F.col("name").alias("_known")).filter("_p != ''")
    one = names.select(F.col(name).alias("_n")).filter("_n is not null").distinct()
    heads = one.withColumn("_k", F.explode(F.sequence(F.lit(1), F.greatest(F.length("_n"), F.lit(1))))).withColumn("_p", F.lower(F.substring("_n", F.lit(1), F.col("_k"))))
    best = heads.join(keys, "_p").groupBy("_n").agg(F.max(F.struct("_k", "_known")).alias("b"))
    out = names.join(best.select(F.col("_n").alias(name), F.col("b._known").alias("canonical")), name, "left")
    return out.withColumn("canonical", F.coalesce("canonical", name))
