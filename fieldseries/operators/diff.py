"""Fingerprints and differences of tables and snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: list[str]) -> Column:
    """MD5 of a row's values by meaning; each goes with its length, so none can pass for two, and a null differs from any text."""
    text = lambda c: F.col(c).cast("string")
    return F.md5(F.concat(*[F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in columns]))


def content_fingerprint(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, rows, fingerprint): independent of row order, and pre-aggregated, as row hashes are summed.

    The sum runs over both halves of each row's MD5, so equal rows in other numbers change it too.
    """
    h = row_hash(columns)
    half = lambda a: F.conv(F.substring(h, a, 15), 16, 10).cast("decimal(38,0)")
    agg = df.withColumns({"_a": half(1), "_b": half(16)}).groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    return agg.select(*keys, "rows", F.concat_ws("-", F.col("_a").cast("string"), F.col("_b").cast("string")).alias("fingerprint"))


def changed_rows(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, change): keys that were added, removed or changed between two snapshots with unique keys."""
    a, b = (d.select(*keys, row_hash(columns).alias(h)) for d, h in ((old, "_o"), (new, "_n")))
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(F.col("_o") != F.col("_n"), "changed")
    return a.join(b, keys, "full").withColumn("change", change).filter("change is not null").select(*keys, "change")


def table_diff(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(column, cells, example): cells that differ by column, null-safe, with the smallest key's values; every column has a row."""
    a = old.select(*keys, F.struct(*columns).alias("_o"))
    b = new.select(*keys, F.struct(*columns).alias("_n"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col("_o")[c].cast("string").alias("old"), F.col("_n")[c].cast("string").alias("new"), (~F.col("_o")[c].eqNullSafe(F.col("_n")[c])).alias("differs")) for c in columns])
    one = a.join(b, keys).withColumn("c", F.explode(cells)).select(*keys, "c.*")
    example = F.min(F.when(F.col("differs"), F.struct(*keys, F.concat_ws(" -> ", F.coalesce("old", F.lit("NULL")), F.coalesce("new", F.lit("NULL"))).alias("t"))))
    return one.groupBy("column").agg(F.count_if("differs").alias("cells"), example.alias("_e")).select("column", "cells", F.col("_e.t").alias("example"))


def manifest_compare(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, verdict) of two manifests (content, inputs, built): gone, new, identical, not rebuilt, inputs changed, or
    different although the inputs are the same."""
    b, a = (m.select(*keys, F.struct("content", "inputs", "built").alias(n)) for m, n in ((before, "_b"), (after, "_a")))
    j = b.join(a, keys, "full")
    verdict = (
        F.when(F.col("_a").isNull(), "gone")
        .when(F.col("_b").isNull(), "new")
        .when(F.col("_a.content") == F.col("_b.content"), "identical")
        .when(F.col("_a.built") == F.col("_b.built"), "not rebuilt")
        .when(F.col("_a.inputs") != F.col("_b.inputs"), "inputs changed")
        .otherwise("different with the same inputs")
    )
    return j.select(*keys, verdict.alias("verdict"))


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new replace those of old with their keys; columns that one side lacks are null."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def overlaps(files: DataFrame, proposed: DataFrame) -> DataFrame:
    """Existing spans (file, device_serial, s, e) that touch a proposed one (id, device_serial, s, e) of the same device."""
    p = proposed.select("id", "device_serial", F.col("s").alias("_s"), F.col("e").alias("_e"))
    return files.join(p, (files["device_serial"] == p["device_serial"]) & (files["s"] <= p["_e"]) & (files["e"] >= p["_s"])).select("id", "file", "s", "e")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def spread(df: DataFrame, keys: list[str]) -> DataFrame:
    """df dealt by its keys to all of the session's shuffle partitions.

    Spark merges small partitions by their compressed size, up to one for each core; tables that compress well are then sorted and
    counted by the million in one task.  A number that is asked for is kept.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
