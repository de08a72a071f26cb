"""Levelling surveys: falls, slopes and the two setups that agree best."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import scratch


def fall(bs: Column, fs: Column, d_up: Column, d_down: Column) -> Column:
    """Fall between two points from back and fore sight, each with its offset."""
    return (fs + d_down) - (bs + d_up)


def slope(fall: Column, reach: Column) -> Column:
    """abs(fall) / reach; null without a positive reach."""
    return F.when(reach > 0, F.abs(fall) / reach)


def select_agreeing_pair(falls: DataFrame, tolerance: float = 0.010) -> DataFrame:
    """(pair, setup_a, setup_b, fall, agrees) of falls (pair, setup, fall).

    The two setups closest to each other (the first such pair on a tie) give their mean if they differ by at most
    the tolerance, rounded to 6 digits; a single setup is taken unchecked.  A survey has a handful of setups,
    which are compared inside its row.
    """
    s = falls.groupBy("pair").agg(F.array_sort(F.collect_list(F.struct("setup", "fall"))).alias("s"))
    two = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b["setup"] > a["setup"]), lambda b: F.struct(F.round(F.abs(a["fall"] - b["fall"]), 6).alias("d"), a["setup"].alias("a"), b["setup"].alias("b"), ((a["fall"] + b["fall"]) / 2).alias("m")))))
    p = s.withColumn("p", F.array_min(two))
    one = F.size("s") == 1
    ok = F.col("p.d") <= tolerance
    first = F.get("s", F.lit(0))
    return p.select("pair", F.when(one, first["setup"]).otherwise(F.col("p.a")).alias("setup_a"), F.col("p.b").alias("setup_b"), F.when(one, first["fall"]).when(ok, F.col("p.m")).alias("fall"), F.when(~one, ok).alias("agrees"))


def latest_surveys(surveys: DataFrame) -> DataFrame:
    """The newest row of each deployment and quantity (unique_id, quantity, measured_on, value, relative_to); equal days by value."""
    best = F.max(F.struct("measured_on", "value", "relative_to"))
    return surveys.filter("value is not null and relative_to is not null").groupBy("unique_id", "quantity").agg(best.alias("_x")).select("unique_id", "quantity", "_x.*")


def _shortening():
    """A function on batches: every node's chain as far as it goes on inside its batch, as node, what it reaches, height and hops;
    `around` where it goes round there.  Being made here it needs no module of ours where it runs."""

    def shortened(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            parent, value = b.column("parent"), b.column("value")
            to = pc.index_in(parent, value_set=b.column("node"), skip_nulls=True).fill_null(-1).to_numpy(zero_copy_only=False).astype("int64")
            height, unknown = value.fill_null(0.0).to_numpy(zero_copy_only=False).copy(), value.is_null().to_numpy(zero_copy_only=False).copy()
            hops, last = np.ones(len(to), "int64"), np.arange(len(to))
            for _ in range(len(to).bit_length()):
                on = np.flatnonzero(to >= 0)
                if not len(on):
                    break
                t = to[on]
                h, u, n, far, further = height[t], unknown[t], hops[t], last[t], to[t]
                height[on] += h
                unknown[on] |= u
                hops[on] += n
                last[on], to[on] = far, further
            around = to >= 0
            reached = pc.if_else(pa.array(around), b.column("node"), parent.take(pa.array(last)))
            yield pa.RecordBatch.from_arrays([b.column("node"), reached, pa.array(height, mask=unknown), pa.array(hops), pa.array(around)], ["node", "reached", "height", "hops", "around"])

    return shortened


def chain_heights(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(heights, cyclic): every node's height above the root that its chain of links ends at.

    links: node, parent, value (how far the node is above its parent); one row a node.  heights: node, root, height, hops.
    A parent without a link of its own is a root.  cyclic: node, for nodes whose chain goes round.

    Nodes are laid in order and each batch of neighbours shortens its chains by itself.  Only nodes that another batch reaches
    are still to be chained: few where ids follow the surveys, at worst all of them.  Their chains are doubled: each step joins
    the pairs (node, reached) that are still under way to what their `reached` has reached, so a chain of n links takes
    about log2(n) joins.  Every step is a written table, so lineage does not grow.
    """
    links = links.select("node", "parent", F.col("value").cast("double").alias("value"))
    kind = links.schema["node"].dataType.simpleString()
    near = links.repartitionByRange("node").sortWithinPartitions("node")
    near = scratch.written(near.mapInArrow(_shortening(), f"node {kind}, reached {kind}, height double, hops bigint, around boolean"), "chains")
    exits = near.filter("not around").select(F.col("reached").alias("node")).distinct()
    state = near.join(exits, "node", "left_semi")
    more = state.select(F.col("node").alias("reached"), F.lit(True).alias("_more"))
    state = scratch.written(state.join(more, "reached", "left").select("node", "reached", "height", "hops", F.col("_more").isNull().alias("ends")), "chains")
    under_way = state.filter("not ends").count()
    while under_way:
        onward = state.select(F.col("node").alias("reached"), F.struct("reached", "height", "hops", "ends").alias("_o"))
        step = state.filter("not ends").join(onward, "reached")
        step = step.select("node", F.col("_o.reached").alias("reached"), (F.col("height") + F.col("_o.height")).alias("height"), (F.col("hops") + F.col("_o.hops")).alias("hops"), F.col("_o.ends").alias("ends"))
        state = scratch.written(state.filter("ends").unionByName(step), "chains")
        left = state.filter("not ends").count()
        if left == under_way:
            break
        under_way = left
    onward = state.select(F.col("node").alias("reached"), F.struct("reached", "height", "hops", "ends").alias("_o"))
    whole, lone = near.join(onward, "reached", "left"), F.col("_o").isNull()
    ends = ~F.col("around") & (lone | F.col("_o.ends"))
    root, height, hops = F.when(lone, F.col("reached")).otherwise(F.col("_o.reached")), F.when(lone, F.col("height")).otherwise(F.col("height") + F.col("_o.height")), F.col("hops") + F.coalesce("_o.hops", F.lit(0))
    return whole.filter(ends).select("node", root.alias("root"), height.alias("height"), hops.alias("hops")), whole.filter(~ends).select("node")


def relative_heights(surveys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(heights, cyclic, second look) from long surveys: one row a number measured.

    surveys: unique_id, measured_on, quantity, value, relative_to.  heights: unique_id, rebar_above_bed_m,
    sensor_above_bed_m, overflow_above_bed_m, rebar_above_root_m, root.  What is measured from this logger's rebar is chained over the rebar's
    own height above the bed; rebar tops are chained from deployment to deployment along relative_to.  A number whose
    link is missing is null.  second look: newest rows with a negative value, as every quantity is positive where things are as usual.
    """
    new = latest_surveys(surveys)
    of = lambda quantity, place: F.max(F.when((F.col("quantity") == quantity) & (F.col("relative_to") == place), F.col("value")))
    own = new.groupBy("unique_id").agg(
        (of("rebar_offset_cm", "bed") / 100).alias("rebar_above_bed_m"),
        (of("sensor_height_cm", "bed") / 100).alias("_sensor"),
        (of("sensor_height_cm", "rebar") / 100).alias("_from_rebar"),
        (of("gzf_offset_cm", "rebar") / 100).alias("_gzf"),
        (of("gzf_offset_cm", "bed") / 100).alias("_gzf_bed"),
    )
    links = new.filter("quantity = 'elev_rel_m'").select(F.col("unique_id").alias("node"), F.col("relative_to").alias("parent"), "value")
    chained, cyclic = chain_heights(links)
    tops = chained.select(F.col("node").alias("unique_id"), F.col("height").alias("rebar_above_root_m"), "root")
    heights = own.join(tops, "unique_id", "left").select(
        "unique_id",
        "rebar_above_bed_m",
        F.coalesce("_sensor", F.col("rebar_above_bed_m") + F.col("_from_rebar")).alias("sensor_above_bed_m"),
        F.coalesce(F.col("rebar_above_bed_m") - F.col("_gzf"), -F.col("_gzf_bed")).alias("overflow_above_bed_m"),
        "rebar_above_root_m",
        "root",
    )
    return heights, cyclic, new.filter("value < 0")
