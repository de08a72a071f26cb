"""Neighbours and running sums along time, slice by slice.

A window over a whole series would put it into one task.  Here time is cut into slices and the window runs inside each of
them; what a slice needs of the others (the row just beyond its edge, or the sum of all before it) comes in as one
more row, out of an aggregation by slice.  Tasks are as long as a slice, whatever the length of a series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days in a slice.
DAYS = 30


def slice_of(micros: Column) -> Column:
    return F.floor(micros / F.lit(DAYS * 86_400_000_000))


def with_neighbour(rows: DataFrame, keys: list[str], micros: Column, fields: list[str], name: str, ahead: bool = True) -> DataFrame:
    """rows with a struct (at, fields) of the next row of the same keys by time, or of the one before; null at the end.

    micros: the time as a whole number; rows without one are left out.  Nulls are values in keys.
    """
    step, side = (F.lead, F.min) if ahead else (F.lag, F.max)
    d = rows.withColumn("_at", micros.cast("bigint")).filter("_at is not null").withColumns({"_slice": slice_of(F.col("_at")), "_edge": F.lit(False)})
    me = F.struct(F.col("_at").alias("at"), *fields)
    edges = d.groupBy(*keys, "_slice").agg(side(me).alias("_e"))
    beyond = edges.withColumn("_e", step("_e").over(Window.partitionBy(*keys).orderBy("_slice"))).filter("_e is not null")
    beyond = beyond.select(*keys, "_slice", F.col("_e.at").alias("_at"), *[F.col("_e")[f].alias(f) for f in fields if f not in keys], F.lit(True).alias("_edge"))
    every = d.unionByName(beyond, allowMissingColumns=True)
    found = every.withColumn(name, step(me).over(Window.partitionBy(*keys, "_slice").orderBy("_at")))
    return found.filter("not _edge").drop("_at", "_slice", "_edge")


def with_running_sum(rows: DataFrame, keys: list[str], micros: Column, amount: Column, name: str) -> DataFrame:
    """rows with the sum of a whole number over all rows of the same keys up to their time, that time included.

    Rows without a time are left out.
    """
    d = rows.withColumn("_at", micros.cast("bigint")).filter("_at is not null").withColumns({"_slice": slice_of(F.col("_at")), "_edge": F.lit(False), "_add": amount.cast("bigint")})
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = d.groupBy(*keys, "_slice").agg(F.sum("_add").alias("_add")).withColumn("_add", F.sum("_add").over(before)).filter("_add is not null")
    carried = carried.withColumns({"_at": F.lit(-(1 << 62)).cast("bigint"), "_edge": F.lit(True)})
    so_far = Window.partitionBy(*keys, "_slice").orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    every = d.unionByName(carried, allowMissingColumns=True)
    return every.withColumn(name, F.sum("_add").over(so_far)).filter("not _edge").drop("_at", "_slice", "_edge", "_add")
