"""Latest-wins removal of overlapping downloads, with conflicts and repeats accounted for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["device_serial", "port", "sensor", "measurement", "datetime"]


def dedupe_latest_wins(readings: DataFrame, key: list[str] = KEY, fetched: str = "fetched_utc", file: str = "source_file", row: str = "row_seq", value: str = "value", accumulated: str | None = None) -> DataFrame:
    """One row a key: of the latest fetch, then the first file, then the first row.

    conflict: some file's first copy differs (null-safe) from the kept value.  repeats: second and
    further copies inside files.  repeat_dropped: the sum of their values where the boolean column
    `accumulated` says so, else null.  Nulls are values in keys.  One shuffle: all windows share the key.
    """
    whole = Window.partitionBy(*key)
    in_file = Window.partitionBy(*key, file).orderBy(row)
    best = whole.orderBy(F.col(fetched).desc_nulls_last(), file, row)
    r = readings.withColumn("_nth", F.row_number().over(in_file)).withColumn("_rank", F.row_number().over(best))
    r = r.withColumn("_kept", F.first(value).over(best))
    again = F.col("_nth") > 1
    r = r.withColumns(
        {
            "conflict": F.max((~again) & ~F.col(value).eqNullSafe(F.col("_kept"))).over(whole),
            "repeats": F.sum(again.cast("int")).over(whole).cast("int"),
            "_dropped": F.sum(F.when(again, F.col(value))).over(whole),
        }
    )
    dropped = F.when(F.col(accumulated), F.col("_dropped")) if accumulated else F.lit(None).cast("double")
    return r.filter("_rank = 1").withColumn("repeat_dropped", dropped).drop("_nth", "_rank", "_kept", "_dropped")


def dedupe_stats(rows_in: DataFrame, deduped: DataFrame) -> DataFrame:
    """rows_in, rows_out, removed, conflicts, repeats: one row, also for empty input."""
    out = deduped.agg(F.lit(1).alias("_one"), F.count("*").alias("rows_out"), F.coalesce(F.sum(F.col("conflict").cast("bigint")), F.lit(0)).cast("bigint").alias("conflicts"), F.coalesce(F.sum("repeats"), F.lit(0)).cast("bigint").alias("repeats"))
    return rows_in.agg(F.lit(1).alias("_one"), F.count("*").alias("rows_in")).join(out, "_one").select("rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("removed"), "conflicts", "repeats")


def first_copy(readings: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in an explicit order."""
    return readings.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_n = 1").drop("_n")
