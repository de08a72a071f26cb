"""A folder that all executors share, for tables that a job writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that the session names in spark.checkpoint.dir.

    In local mode a temporary folder stands in where none is named; on a cluster that is an error, as each
    machine would see files of its own.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="fieldseries-")
    return f"{where.rstrip('/')}/fieldseries/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, and several readers compute it once."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
