"""Incremental landing: micro-batches of raw readings appended, their products marked for rebuilding."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.parsing import PROJECT_ZONE


def download_plan(devices: DataFrame, held: DataFrame, now: str) -> DataFrame:
    """Where to resume each device: after its newest held reading, else its backfill time, else its first measurement.

    devices: device_serial, first_measurement, last_measurement, backfill_from; held: device_serial, datetime.
    Devices whose source has nothing newer are left out.
    """
    mark = held.groupBy("device_serial").agg(F.max("datetime").alias("_held"))
    d = devices.join(mark, "device_serial", "left")
    resume = F.coalesce("_held", "backfill_from", "first_measurement")
    start = F.when(F.col("_held").isNotNull(), resume + F.expr("interval 1 second")).otherwise(resume)
    more = F.col("last_measurement").isNull() | (F.col("last_measurement") > F.coalesce("_held", F.timestamp_micros(F.lit(-(1 << 60)))))
    return d.filter(more & resume.isNotNull()).select("device_serial", start.alias("start"), F.least(F.coalesce("last_measurement", F.lit(now).cast("timestamp")), F.lit(now).cast("timestamp")).alias("end"))


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to: the same after a restart, another one for a new checkpoint."""
    text = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()
    return json.loads(text.value)["id"]


def land_batch(batch: DataFrame, batch_id: int, readings_path: str, log_path: str, dirty_path: str, run: str, zone: str = PROJECT_ZONE) -> None:
    """Append readings, then one log row a file, then the (device, local year) keys to rebuild.

    What is landed is known by the run and the batch: a retried batch overwrites its own partition, so nothing is landed
    twice, and a new checkpoint, whose batches count from 0 again, overwrites nothing of an older one.
    """
    b = batch.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)}).persist()
    write = lambda df, path: df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id").parquet(path)
    write(b, readings_path)
    write(b.groupBy("run", "batch_id", "source_file", "device_serial").agg(F.min("datetime").alias("start_date"), F.max("datetime").alias("end_date"), F.count("*").alias("n_records")), log_path)
    write(b.select("run", "batch_id", "device_serial", F.year(F.from_utc_timestamp("datetime", zone)).alias("year")).distinct(), dirty_path)
    b.unpersist()


def stream_land(stream: DataFrame, readings_path: str, log_path: str, dirty_path: str, checkpoint: str) -> StreamingQuery:
    """Land all that is there and stop; a later start goes on where this one ended."""

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, batch_id, readings_path, log_path, dirty_path, run_of(batch.sparkSession, checkpoint))

    return stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(land).start()
