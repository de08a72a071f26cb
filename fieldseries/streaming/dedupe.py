"""Latest-wins deduplication of a stream of overlapping fetches.

Each micro-batch appends the best copies that it holds; nothing that is there is rewritten, so a retried batch replaces
itself only, a new checkpoint loses nothing, and a late fetch wins or loses by its own time, whatever batch it came in.
Readers take the best copy of each key.  State is bounded: what was delivered is remembered for a while by the time of
its arrival, only to leave out exact repeats; what comes again later is one more row until the log is compacted.

path/log/run=<query>/batch=<number>/day=..    what batches have appended
path/log/run=compacted-<id>/..                the best copies of a set of them
path/compacted                                (into, run, batch): which of them a compaction stands for
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import first_copy
from .landing import run_of

#: Later fetches first, readings without a fetch time last; then by file and row, as dedupe_latest_wins() decides.
FETCHED, FILE, ROW = "fetched_utc", "source_file", "row_seq"


def _order() -> list[Column]:
    return [F.col(FETCHED).desc_nulls_last(), F.col(FILE), F.col(ROW)]


def append_batch(batch: DataFrame, batch_id: int, path: str, keys: list[str], run: str) -> None:
    """The best copy of each key of a batch, into the batch's own partition."""
    best = first_copy(batch, keys, _order()).withColumns({"run": F.lit(run), "batch": F.lit(batch_id), "day": F.to_date("datetime")})
    best.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch", "day").parquet(f"{path}/log")


def stream_dedupe(stream: DataFrame, path: str, checkpoint: str, keys: list[str], remember: str = "7 days") -> StreamingQuery:
    """Append all that is there and stop.  Exact repeats (keys, fetch, file and row) within `remember` of their first arrival
    are dropped by the stream's own state, which forgets them after that."""

    def append(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.drop("_arrived"), batch_id, path, keys, run_of(batch.sparkSession, checkpoint))

    # arrival never goes back, so no reading is ever late for the state
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
    fresh = arrived.dropDuplicatesWithinWatermark([*keys, FETCHED, FILE, ROW])
    return fresh.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(append).start()


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def _live(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the log that no compaction stands for, and those of finished compactions."""
    log = spark.read.option("basePath", f"{path}/log").parquet(f"{path}/log")
    log = log.withColumn("batch", F.col("batch").cast("bigint"))
    if not _exists(spark, f"{path}/compacted"):
        return log.filter(~F.col("run").startswith("compacted-"))
    done = spark.read.parquet(f"{path}/compacted")
    finished = done.select(F.col("into").alias("run")).distinct().withColumn("_done", F.lit(True))
    log = log.join(finished, "run", "left").filter("_done or not startswith(run, 'compacted-')").drop("_done")
    return log.join(done.select("run", "batch"), ["run", "batch"], "left_anti")


def current_readings(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The best copy of each key so far."""
    return first_copy(_live(spark, path), keys, _order()).drop("run", "batch", "day")


def compact(spark: SparkSession, path: str, keys: list[str]) -> str:
    """Write the best copies of all that is there as one run and say what it stands for; the new run.

    Only the last step, one append to a small table, makes readers turn to it, so one that dies half-way changes nothing.
    Batches that arrive meanwhile are not among what it stands for.
    """
    live, into = _live(spark, path), f"compacted-{uuid.uuid4().hex}"
    parts = live.select("run", "batch").distinct().collect()  # names of batches since the last compaction, no rows
    chosen = spark.createDataFrame([(r.run, r.batch) for r in parts], "run string, batch bigint")
    best = first_copy(live.join(F.broadcast(chosen), ["run", "batch"], "left_semi"), keys, _order())
    best.withColumns({"run": F.lit(into), "batch": F.lit(0)}).write.mode("append").partitionBy("run", "batch", "day").parquet(f"{path}/log")
    chosen.withColumn("into", F.lit(into)).coalesce(1).write.mode("append").parquet(f"{path}/compacted")
    return into


def remove_compacted(spark: SparkSession, path: str) -> int:
    """Delete the batches that finished compactions stand for; for when no reader is at work on them.  How many went."""
    n = 0
    for r in spark.read.parquet(f"{path}/compacted").select("run", "batch").distinct().toLocalIterator():
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/log/run={r.run}/batch={r.batch}")
        n += bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True))
    return n
