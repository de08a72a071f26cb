"""Spans that overlap: cut into pieces that do not, the best span of each piece, and the piece that holds a moment.

Moments at which a span of a key starts or ends are numbered along time.  A span from number i to number j is the union of two
blocks of 2^k numbers; what covers the same block is compared once, and the blocks that are left are dealt to nodes of a
binary tree over the numbers.  A piece then looks at the log2(n) nodes above it.  No span meets another span, so a key with
many spans at once costs no more than as many rows, and no key is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequences import slice_of

#: Micros in a slice of readings that look for their piece.
DAY = 86_400_000_000


def _log2(n: Column) -> Column:
    """Whole part of the binary logarithm of a whole number over zero."""
    return F.length(F.bin(n)) - 1


def _numbered_moments(spans: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, t, to, i, n): each moment of a key at which a span starts or ends, the next one, its number from 0, and their count."""
    t = spans.select(*keys, F.explode(F.array("starts", "ends")).alias("t")).filter("t is not null").distinct().withColumn("_slice", slice_of(F.unix_micros("t")))
    by, inside = Window.partitionBy(*keys).orderBy("_slice"), Window.partitionBy(*keys, "_slice").orderBy("t")
    per = t.groupBy(*keys, "_slice").agg(F.count("*").alias("_count"), F.min("t").alias("_first"))
    per = per.select(*keys, "_slice", F.coalesce(F.sum("_count").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(by).alias("_next"), F.sum("_count").over(Window.partitionBy(*keys)).alias("n"))
    own = t.withColumns({"_i": F.row_number().over(inside), "_to": F.lead("t").over(inside)})
    return own.join(per, [*keys, "_slice"]).select(*keys, "t", F.coalesce("_to", "_next").alias("to"), (F.col("_before") + F.col("_i") - 1).alias("i"), "n")


def pieces(spans: DataFrame, keys: list[str], best: Column) -> DataFrame:
    """(keys, starts, ends, best): between neighbouring moments the greatest `best` of the spans that hold; where none does, no row.

    spans: keys, starts, ends (null: open), and the columns of `best`, a struct.  Spans that end before they start, or have no
    start, hold nowhere.
    """
    s = spans.filter("starts is not null and (ends is null or starts < ends)").select(*keys, "starts", "ends", best.alias("best"))
    m = _numbered_moments(s, keys)
    a = m.select(*keys, F.col("t").alias("starts"), F.col("i").alias("_a"), "n")
    b = m.select(*keys, F.col("t").alias("ends"), F.col("i").alias("_b"))
    s = s.join(a, [*keys, "starts"]).join(b, [*keys, "ends"], "left").select(*keys, "best", "_a", F.coalesce("_b", "n").alias("_b"))
    top = lambda d, *by: d.groupBy(*keys, *by).agg(F.max("best").alias("best"))
    s = s.withColumn("_k", _log2(F.col("_b") - F.col("_a")))
    s = s.withColumn("_a", F.explode(F.array_distinct(F.array("_a", F.expr("_b - shiftleft(1L, _k)")))))
    blocks = top(s, "_k", "_a").withColumn("_level", F.explode(F.sequence(F.lit(0), F.col("_k"))))
    # at each level the block begins at the first node that lies inside it and goes up to the last; odd ends have no parent inside
    blocks = blocks.withColumns({"_l": F.expr("shiftright(_a + shiftleft(1L, _level) - 1, _level)"), "_r": F.expr("shiftright(_a + shiftleft(1L, _k), _level)")}).filter("_l < _r")
    nodes = blocks.withColumn("_node", F.explode(F.array_distinct(F.array_compact(F.array(F.when(F.col("_l") % 2 == 1, F.col("_l")), F.when(F.col("_r") % 2 == 1, F.col("_r") - 1))))))
    up = m.withColumn("_level", F.explode(F.sequence(F.lit(0), _log2(F.col("n"))))).withColumn("_node", F.expr("shiftright(i, _level)"))
    found = up.join(top(nodes, "_level", "_node"), [*keys, "_level", "_node"])
    return top(found, "t", "to").withColumnsRenamed({"t": "starts", "to": "ends"})


def at_moments(readings: DataFrame, cut: DataFrame, keys: list[str], when: str, name: str = "best") -> DataFrame:
    """readings with the `best` of the piece that holds `when`, as `name`; null where none does.  No reading is left out or doubled.

    cut: what pieces() returns.  Readings and pieces run past each other day by day; a day takes the last piece of the days before it.
    """
    micros = lambda c: F.unix_micros(F.col(c))
    day = lambda d: d.withColumn("_day", F.floor(F.col("_t") / F.lit(DAY)))
    p = cut.select(*[F.col(k).cast(readings.schema[k].dataType).alias(k) for k in keys], micros("starts").alias("_t"), F.struct(micros("starts").alias("a"), micros("ends").alias("b"), F.col("best").alias("best")).alias("_p"))
    p, r = day(p), day(readings.withColumn("_t", micros(when).cast("bigint")))
    last = p.groupBy(*keys, "_day").agg(F.max("_p").alias("_p")).unionByName(r.select(*keys, "_day").distinct(), allowMissingColumns=True).groupBy(*keys, "_day").agg(F.max("_p").alias("_p"))
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_p", F.last("_p", ignorenulls=True).over(before)).filter("_p is not null").withColumn("_t", F.col("_p.a"))
    every = r.withColumn("_own", F.lit(True)).unionByName(p.unionByName(carried).withColumn("_own", F.lit(False)), allowMissingColumns=True)
    so_far = Window.partitionBy(*keys, "_day").orderBy("_t", "_own").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = every.withColumn("_p", F.last("_p", ignorenulls=True).over(so_far)).filter("_own")
    holds = F.col("_p.b").isNull() | (F.col("_t") < F.col("_p.b"))
    return found.withColumn(name, F.when(holds, F.col("_p.best"))).drop("_t", "_day", "_own", "_p")
