"""Statuses that follow from the last contact, kept as a history of validity intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The status of a logger that reports and of one that does not.
REACHED, LOST = "online", "nonresponsive"


def status_changes(history: DataFrame, contacts: DataFrame, now: str, lost_days: float = 14, back_days: float = 2) -> DataFrame:
    """(unique_id, old_status, new_status, valid_from): what the last contacts change.

    history: unique_id, device_serial, status, valid_from, valid_to (null: holds now).  contacts: device_serial, datetime.
    A reachable logger is lost after `lost_days` without contact; a lost one is back only on a contact of the last
    `back_days`, so that one near the threshold does not go to and fro.  Other statuses, a person's
    decisions among them, stay.  A logger that never had contact counts from when its status began.
    """
    if back_days > lost_days:
        raise ValueError("a logger would be back and lost at once")
    newest = contacts.groupBy("device_serial").agg(F.max("datetime").alias("_seen"))
    at = F.lit(now).cast("timestamp")
    h = history.filter("valid_to is null").join(newest.filter(F.col("_seen") <= at), "device_serial", "left")
    days = (F.unix_micros(at) - F.unix_micros(F.coalesce("_seen", "valid_from"))) / F.lit(86_400_000_000)
    new = F.when((F.col("status") == REACHED) & (days > lost_days), LOST).when((F.col("status") == LOST) & F.col("_seen").isNotNull() & (days <= back_days), REACHED)
    return h.filter(F.col("valid_from") < at).withColumn("new_status", new).filter("new_status is not null").select("unique_id", F.col("status").alias("old_status"), "new_status", at.alias("valid_from"))


def apply_status(history: DataFrame, changes: DataFrame) -> DataFrame:
    """The history with each change: the open row is closed at the time of the change, and one that opens then follows.

    Applied once more, with the changes computed anew at the same time, it stays as it is.
    """
    c = changes.select("unique_id", F.struct("new_status", F.col("valid_from").alias("at")).alias("_c"))
    j = history.join(c, "unique_id", "left").withColumn("_hit", F.col("_c").isNotNull() & F.col("valid_to").isNull())
    closed = j.withColumn("valid_to", F.when(F.col("_hit"), F.col("_c.at")).otherwise(F.col("valid_to")))
    opened = j.filter("_hit").withColumns({"status": F.col("_c.new_status"), "valid_from": F.col("_c.at"), "valid_to": F.lit(None).cast("timestamp")})
    return closed.unionByName(opened).select(*history.columns)
