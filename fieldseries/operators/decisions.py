"""Decisions about values: flags over spans of time, the later decision over the earlier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import spans

# The flags that a value can carry, from a plain measurement to none at all.
FLAGS = ("observed", "interpolated", "substituted", "estimated", "manual", "suspect", "missing")
#: Flags under which a decision may bring a value of its own.
WITH_VALUE = ("interpolated", "substituted", "estimated", "manual")


def severity(flag: Column) -> Column:
    """Place of a flag in FLAGS; null for an unknown one."""
    return F.nullif(F.array_position(F.array(*[F.lit(f) for f in FLAGS]), flag), F.lit(0))


def worse(*flags: Column) -> Column:
    """The flag that is furthest from a plain measurement."""
    return F.element_at(F.array(*[F.lit(f) for f in FLAGS]), F.greatest(*[severity(f) for f in flags]).cast("int"))


def split_decisions(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, refused with a problem).

    decisions: decision_id, series, starts, ends (null: open), flag, value (null: the recorded one), decided_at.
    """
    problem = (
        F.when(F.col("starts").isNull() | F.col("decided_at").isNull(), "no start or no time of decision")
        .when(F.col("ends") <= F.col("starts"), "ends before it starts")
        .when(severity(F.col("flag")).isNull(), "unknown flag")
        .when(F.col("value").isNotNull() & ~F.col("flag").isin(*WITH_VALUE), "a value under a flag that has none")
    )
    d = decisions.withColumn("problem", problem)
    return d.filter("problem is null").drop("problem"), d.filter("problem is not null")


def cut_spans(decisions: DataFrame, keys: list[str]) -> DataFrame:
    """Disjoint spans (keys, starts, ends, decision_id, flag, value): where valid decisions overlap, the one decided later
    holds, and the earlier one goes on after it.  A null end is open.

    A decision goes on where a piece of it follows another.  See spans.pieces(): decisions never meet each other, however many
    hold at once.
    """
    cut = spans.pieces(decisions, keys, F.struct("decided_at", "decision_id", F.col("starts").alias("_starts"), F.col("ends").alias("_ends"), "flag", "value"))
    cut = cut.select(*keys, "starts", "ends", "best.decision_id", "best.flag", "best.value")
    by = Window.partitionBy(*keys, "decision_id").orderBy("starts")
    goes_on = F.coalesce(F.col("starts") == F.lag("ends").over(by), F.lit(False))
    runs = cut.withColumn("_goes_on", goes_on).withColumn("_run", F.count_if(~F.col("_goes_on")).over(by))
    ends = F.when(~F.bool_or(F.col("ends").isNull()), F.max("ends"))
    return runs.groupBy(*keys, "decision_id", "_run").agg(F.min("starts").alias("starts"), ends.alias("ends"), F.first("flag").alias("flag"), F.first("value").alias("value")).drop("_run")


def apply_flags(series: DataFrame, decisions: DataFrame, keys: list[str], when: str = "datetime") -> DataFrame:
    """series with value, flag, decision_id and recorded (the value as it was), under the decision that holds at each moment.

    A decision's own value replaces the recorded one; `missing` takes the value away; a moment without a value stays
    missing under any decision that brings none.  Decisions are taken as split_decisions() lets them through.
    """
    cut = spans.pieces(decisions, keys, F.struct("decided_at", "decision_id", F.col("flag").alias("_flag"), F.col("value").alias("_value")))
    j = spans.at_moments(series, cut, keys, when, "_best").select(*series.columns, "_best.decision_id", "_best._flag", "_best._value")
    value = F.when(F.col("_flag") == "missing", F.lit(None)).otherwise(F.coalesce("_value", "value"))
    flag = F.when(value.isNull(), "missing").otherwise(F.coalesce("_flag", "flag"))
    return j.withColumns({"recorded": F.col("value"), "value": value, "flag": flag}).drop("_flag", "_value")
