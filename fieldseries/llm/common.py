"""Scratch tables, sampling and Arrow helpers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows that one Python call sees at most.
BATCH_ROWS = 512
#: Bytes of text that a sample of labelled documents has at most.
SAMPLE_BYTES = 48 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names.  A temporary one stands in on a single machine (local mode) only."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        held = getattr(spark.sparkContext, "_fieldseries_scratch", None)
        where = held or "file://" + tempfile.mkdtemp(prefix="fieldseries-")
        spark.sparkContext._fieldseries_scratch = where
    return where.rstrip("/")


def materialise(df: DataFrame, name: str, keep: list[str] | None = None) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends here, lost executors cost nothing before it.

    keep: a list that gets the path, for drop_scratch().
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/fieldseries/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    release(spark)
    if keep is not None:
        keep.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more: it does so when both sides collect garbage."""
    gc.collect()
    spark._jvm.System.gc()


def drop_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    paths.clear()


def fold(key: str | Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; -1, which is no fold, for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(key.cast("string")) % n, F.lit(-1))


def bounded_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows with the smallest key hashes: the same rows for any partitioning."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(n)


def small_batches(spark: SparkSession) -> None:
    """Texts are long: no more than 1024 of them cross to Python at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= 1024:
        spark.conf.set(name, 1024)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType) -> DataFrame:
    """mapInArrow over slices of BATCH_ROWS rows, so that memory follows the texts and not the batch setting."""

    small_batches(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                out = work(batch.slice(at, BATCH_ROWS))
                if out is not None and out.num_rows:
                    yield out
        give_back()

    return df.mapInArrow(task, schema)


def give_back() -> None:
    """At the end of a task: free memory goes back to the system, as the worker process stays for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


class Bloom:
    """A filter over well-mixed 64-bit keys: it never misses one, and lets some others by.

    It only saves moving rows that an exact join drops afterwards; when full it saves nothing and is still right.
    """

    #: Its size as a power of two of bits: 1 MB at least and 32 MB at most, some 16 bits a key in between.
    LEAST, MOST = 23, 28

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64) if keys.dtype == np.int64 else keys
        mask = np.uint64((1 << self.bits) - 1)
        ok = np.ones(len(keys), bool)
        for shift in (0, self.bits):
            at = (keys >> np.uint64(shift)) & mask
            ok &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0
        return ok


def bloom(df: DataFrame, key: str) -> Bloom:
    """Built by Spark from a written table; at most 2**22 words come to the driver, whatever the number of keys."""
    bits = min(Bloom.MOST, max(Bloom.LEAST, (16 * df.count()).bit_length()))
    at = F.explode(F.array(*[F.shiftrightunsigned(F.col(key), s).bitwiseAND(F.lit((1 << bits) - 1)) for s in (0, bits)])).alias("at")
    rows = df.select(at).groupBy(F.shiftright("at", 6).cast("int").alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("word")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[rows["slot"].to_numpy()] = rows["word"].to_numpy().view(np.uint64)
    return Bloom(words, bits)


def within_bytes(rows: DataFrame, key: str, size: str, most: int) -> DataFrame:
    """The first rows of a bounded sample, by the hash of their keys, whose sizes add up to `most`."""
    so_far = F.sum(size).over(Window.orderBy(F.xxhash64(F.col(key)), F.col(key)).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_total", so_far).filter(F.col("_total") <= most).drop("_total", size)


def sampled_texts(docs: DataFrame, chosen: DataFrame, n: int, most: int = SAMPLE_BYTES) -> list[tuple[str, object]]:
    """(text, y) of at most n of the chosen (k, y), and of `most` bytes of text, by the hash of their ids.

    A repeated id counts once (its smallest text).  The sample is bounded in rows and bytes; so is what the driver holds.
    """
    few = F.broadcast(bounded_sample(chosen, "k", n))
    texts = docs.select(F.col("doc_id").alias("k"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sizes = texts.join(few, "k").groupBy("k").agg(F.min("y").alias("y"), F.max(F.octet_length("text")).cast("bigint").alias("size"))
    held = F.broadcast(within_bytes(sizes, "k", "size", most))
    rows = texts.join(held, "k").groupBy("k").agg(F.min(F.struct("text", "y")).alias("x")).select("k", "x.*").collect()
    return [(r.text, r.y) for r in sorted(rows, key=lambda r: r.k)]


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, train: Column, n: int) -> list[tuple[str, int]]:
    """(text, label) of at most n labelled training documents, chosen by the hash of their ids.

    Null ids and labels are never learned from; a repeated id counts once (its smallest text and label).
    """
    known = labels.select(F.col("doc_id").alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y in (0, 1)")
    return sampled_texts(docs, known.groupBy("k").agg(F.min("y").alias("y")).filter(train), n)
