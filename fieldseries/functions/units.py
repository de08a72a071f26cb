"""Unit spellings and conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings and the canonical unit of each.
SPELLINGS = {
    "degC": "degC", "C": "degC", "celsius": "degC", "degree_C": "degC",
    "degF": "degF", "F": "degF", "fahrenheit": "degF",
    "kPa": "kPa", "kpa": "kPa", "psi": "psi", "hPa": "hPa", "mbar": "hPa", "mb": "hPa",
    "m/s": "m/s", "deg": "deg", "degrees": "deg", "W/m2": "W/m2",
    "mm": "mm", "mm/hr": "mm/h", "mm/h": "mm/h", "km": "km",
    "m3/m3": "m3/m3", "mS/cm": "mS/cm", "dS/m": "dS/m",
    "%": "%", "m": "m", "ft": "ft", "mV": "mV", "raw": "raw", "count": "count", "Lightning": "count",
}
# Factor and offset of each conversion, out = (in + offset) * factor.
CONVERSIONS = {
    ("degF", "degC"): (-32.0, 5 / 9),
    ("psi", "kPa"): (0.0, 6.894757),
    ("hPa", "kPa"): (0.0, 0.1),
    ("ft", "m"): (0.0, 0.3048),
    ("mS/cm", "dS/m"): (0.0, 1.0),
}
# Metres in each unit of length.
METRES = {"m": 1.0, "cm": 0.01, "mm": 0.001, "ft": 0.3048, "in": 0.0254, "yd": 0.9144}


def normalize_unit(unit: Column) -> Column:
    """The canonical spelling; an unknown unit without its white space, and "" for null."""
    x = F.trim(F.coalesce(unit, F.lit("")))
    x = F.regexp_replace(x, "Â(?=[°²³])", "")
    x = F.regexp_replace(x, "°|<U\\+00B0>|º", "deg")
    x = F.regexp_replace(x, "²|<U\\+00B2>", "2")
    x = F.regexp_replace(x, "³|<U\\+00B3>", "3")
    x = F.regexp_replace(x, r"\s+", "")
    known = F.create_map(*[F.lit(v) for pair in SPELLINGS.items() for v in pair])
    return F.coalesce(F.try_element_at(known, x), x)


def convert_units(value: Column, source: Column, target: Column) -> Column:
    """The value in the target unit; a pair without a conversion is an error that names it."""
    out = F.when(source == target, value)
    for (a, b), (offset, factor) in CONVERSIONS.items():
        out = out.when((source == a) & (target == b), (value + F.lit(offset)) * F.lit(factor))
    return out.otherwise(F.raise_error(F.concat(F.lit("No conversion from '"), source, F.lit("' to '"), target, F.lit("'"))).cast("double"))


def convertible(source: Column, target: Column) -> Column:
    """Whether convert_units() knows the pair: the check to make before a build."""
    out = source == target
    for a, b in CONVERSIONS:
        out = out | ((source == a) & (target == b))
    return out


def to_meters(value: Column, unit: Column) -> Column:
    """Metres; null for an unknown unit."""
    factors = F.create_map(*[F.lit(v) for pair in METRES.items() for v in pair])
    return value * F.try_element_at(factors, unit)
