"""Names and displays of surveys, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .parsing import parse_rod_reading
from .units import to_meters

SURVEY_NAME = r"^[a-z][a-z0-9]*_[a-z0-9]+_(fall|reach)_[a-z0-9]+_[0-9]{8}(_[0-9]+)?\.[a-z]+$"
BLANK = "-"


def survey_filename(surveys: DataFrame, extension: str, order: str) -> DataFrame:
    """surveys (station_id, quantity, method, survey_date) with `name`; the second and later of equal names get a number."""
    stem = F.concat_ws("_", "station_id", "quantity", "method", F.date_format("survey_date", "yyyyMMdd"))
    s = surveys.withColumn("_s", stem).withColumn("_k", F.row_number().over(Window.partitionBy("_s").orderBy(order)))
    suffix = F.when(F.col("_k") > 1, F.concat(F.lit("_"), F.col("_k").cast("string"))).otherwise("")
    return s.withColumn("name", F.concat("_s", suffix, F.lit(f".{extension}"))).drop("_s", "_k")


def is_survey_filename(name: Column) -> Column:
    return name.rlike(SURVEY_NAME)


def rod_table(setups: DataFrame, offsets: DataFrame, key: str) -> DataFrame:
    """Sights and offsets as long rows with what was entered and metres (5 places).

    setups: key, setup, bs, fs, rod_unit.  offsets: key, d_up, up_unit, d_down, down_unit.
    """
    row = lambda sight, place, entered, unit, metres: F.struct(F.lit(sight).alias("sight"), F.lit(place).alias("place"), F.col(entered).alias("entered"), F.col(unit).alias("unit"), F.round(metres, 5).alias("value_m"))
    rod = lambda c: parse_rod_reading(F.col(c), F.col("rod_unit"))["value_m"]
    flat = lambda c, u: to_meters(F.col(c).try_cast("double"), F.col(u))
    sights = setups.select(key, "setup", F.explode(F.array(row("BS", "upstream", "bs", "rod_unit", rod("bs")), row("FS", "downstream", "fs", "rod_unit", rod("fs")))).alias("r"))
    ends = offsets.select(key, F.lit(None).cast(dict(setups.dtypes)["setup"]).alias("setup"), F.explode(F.array(row("offset", "upstream", "d_up", "up_unit", flat("d_up", "up_unit")), row("offset", "downstream", "d_down", "down_unit", flat("d_down", "down_unit")))).alias("r"))
    return sights.unionByName(ends).select(key, "setup", "r.*")


def orthometric_height(ellipsoidal: Column, geoid: Column, point_height: Column | None = None) -> Column:
    """Height over the geoid, and of the ground where the measuring point's height over it is given."""
    h = ellipsoidal - geoid
    return h if point_height is None else h - point_height


def elevation_source_label(ok: Column, provider: Column, resolution: Column) -> Column:
    """Where an elevation comes from; the usual provider with its resolution in metres, null for a failed lookup."""
    usual = F.when(resolution.isNull(), "usgs_3dep").otherwise(F.concat(F.lit("usgs_3dep_"), resolution.cast("string"), F.lit("m")))
    return F.when(ok, F.when(provider.isNull() | (provider == "usgs_3dep"), usual).otherwise(provider))


def show_rod(text: Column, unit: Column) -> Column:
    """Feet, inches and eighths with their marks; other units as they were entered."""
    n = F.filter(F.split(F.trim(text), r"[\s,/-]+"), lambda x: x != "")
    at = lambda i: F.get(n, F.lit(i))
    eighths = F.when(at(2).try_cast("double") == 0, "").otherwise(F.concat(F.lit(" "), at(2), F.lit("/8")))
    return F.when(unit == "ft_in_8", F.concat(at(0), F.lit("' "), at(1), eighths, F.lit('"'))).otherwise(F.concat_ws(" ", F.trim(text), unit))


def show_fall(fall: Column) -> Column:
    """Metres to four places; a negative fall says that it climbs."""
    m = F.format_string("%.4f m", fall)
    return F.when(fall.isNull(), "(none)").when(fall < 0, F.concat(m, F.lit(" (a climb)"))).otherwise(m)


def show_reach(legs: Column, unit: Column) -> Column:
    """Legs, their sum, and the sum in metres where the unit is another; two places, half a hundredth goes up."""
    total = F.aggregate(legs, F.lit(0.0), lambda a, x: a + x)
    two = lambda x: F.round(x.cast("decimal(24,6)"), 2).cast("decimal(24,2)").cast("string")  # noqa: E731  by decimals, as doubles have no exact halves
    line = F.concat(F.array_join(F.transform(legs, two), " + "), F.lit(" = "), two(total), F.lit(" "), unit)
    return F.when(unit == "m", line).otherwise(F.concat(line, F.lit(" = "), two(to_meters(total, unit)), F.lit(" m")))


def shown(value: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(value.cast("string")), F.lit("")), F.lit(BLANK))
