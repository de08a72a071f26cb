"""From raw documents to packed training sequences, a stage an operator.

Each stage takes what its predecessor kept, written as Parquet and read again, and all but the last
return the columns of documents.  Nulls, repeated rows and ids, empty tables and further columns are
handled as the operators' docstrings say.  A stage's last argument collects the scratch tables that what it returns is read
from; run() drops them, and the table of the stage before, once the stage is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldseries.llm import decontamination, ngram_join, packing, suffix_dedup, toxicity
from fieldseries.llm.common import drop_scratch, materialise, table


Scratch = list[str] | None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, used: Scratch = None) -> DataFrame:
    """Documents that the toxicity lexicon rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str, used: Scratch = None) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) one document stays."""
    return ngram_join.keep_one(docs, used=used)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str, used: Scratch = None) -> DataFrame:
    """Strings of 200 bytes or more that stand elsewhere too are cut out of the texts."""
    return suffix_dedup.cut_repeats(docs, scratch=used)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str, used: Scratch = None) -> DataFrame:
    """Documents with benchmark passages beyond the contamination rule go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), used)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str, used: Scratch = None) -> DataFrame:
    """What is left is packed into sequences of at most 2048 tokens; a row a piece."""
    return packing.op10(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", keep_one_of_near_copies),
    ("suffix_dedup", cut_repeated_strings),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: The stages are not SQL; tests/llm hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs, held = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        used, before = [], held
        docs = materialise(stage(spark, docs, sf_dir, used), name, held := [])
        drop_scratch(spark, used + before)
    out = STAGES[-1][1](spark, docs, sf_dir)  # a written table of its own
    drop_scratch(spark, held)
    return out
