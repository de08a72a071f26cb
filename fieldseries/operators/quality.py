"""Data-quality rules over tables: each a name and a frame of violations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parsing import PROJECT_ZONE
from .diff import spread, union_all
from .windows import end_of_day, is_terminal

# The states a deployment can be in.
STATUSES = ("online", "local", "manual", "nonresponsive", "defunct", "removed", "replaced", "relocated", "decommissioned")


@dataclass(frozen=True)
class Rule:
    """Violating rows, each with its key and a detail."""

    name: str
    table: str
    violations: DataFrame


def where(name: str, table: str, df: DataFrame, key: Column, bad: Column, detail: Column) -> Rule:
    return Rule(name, table, df.filter(bad).select(key.cast("string").alias("key"), detail.cast("string").alias("detail")))


def duplicates(name: str, table: str, df: DataFrame, keys: list[str]) -> Rule:
    # most keys stand alone, so that counting before rows move would gather nearly all of them in the tasks that read
    n = spread(df.select(*keys), keys).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return Rule(name, table, n.select(F.concat_ws("|", *keys).alias("key"), F.col("n").cast("string").alias("detail")))


def orphans(name: str, table: str, df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> Rule:
    known = spread(parent.select(F.col(parent_key).alias(key)), [key])
    gone = spread(df.filter(F.col(key).isNotNull()).select(key), [key]).join(known, key, "left_anti")
    return Rule(name, table, gone.select(F.col(key).cast("string").alias("key"), F.lit("no parent").alias("detail")))


def all_terminal(deployments: DataFrame, key: str = "device_serial") -> DataFrame:
    """Keys whose every row is terminal."""
    return deployments.groupBy(key).agg(F.bool_and(is_terminal(F.col("status"))).alias("t")).filter("t").select(key)


def with_end(deployments: DataFrame, zone: str = PROJECT_ZONE) -> DataFrame:
    """deployments with `_end`: of terminal rows the earlier of the serial's next start and the last visit's end, which is
    the end of that day in the project's zone.  Rows without a serial follow nobody."""
    alone = F.coalesce(F.col("device_serial").cast("string"), F.concat(F.lit("\0"), F.col("unique_id").cast("string")))  # a window of its own
    nxt = F.lead("deploy_datetime").over(Window.partitionBy("_own").orderBy("deploy_datetime", "unique_id"))
    d = deployments.withColumn("_own", alone)
    return d.withColumn("_end", F.when(is_terminal(F.col("status")), F.least(F.when(F.col("device_serial").isNotNull(), nxt), end_of_day(F.col("last_visit"), zone)))).drop("_own")


def outside() -> Column:
    """Whether the last record of a row of with_end() lies before its start, or after its end."""
    late = F.col("_end").isNotNull() & (F.col("last_record") > F.col("_end"))
    return F.col("device_serial").isNotNull() & ((F.col("last_record") < F.col("deploy_datetime")) | late)


def outside_deployment(deployments: DataFrame, zone: str = PROJECT_ZONE) -> DataFrame:
    """Rows (with a serial) whose last record lies before their start, or (terminal ones) after the earlier of the serial's next
    start and the last visit's end."""
    return with_end(deployments, zone).filter(outside()).drop("_end")


def violations(rules: list[Rule]) -> DataFrame:
    """rule, table, key, detail of all rules."""
    return union_all([r.violations.select(F.lit(r.name).alias("rule"), F.lit(r.table).alias("table"), "key", "detail") for r in rules])


def rule_summary(rules: list[Rule]) -> DataFrame:
    """rule, n, passed: a row for every rule, also for those without violations."""
    return union_all([r.violations.agg(F.count("*").alias("n")).select(F.lit(r.name).alias("rule"), "n", (F.col("n") == 0).alias("passed")) for r in rules])
