"""Bulk changes: tables of changes applied to tables of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import scratch
from .diff import spread
from .windows import is_terminal


def scd2_apply_configs(configs: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Validity intervals from full port configurations at change times.

    configs: sn, port, change_time, sensor, type, depth_cm, status.  Only ports whose sensor, type, status or depth
    (beyond a tolerance) changes open a new interval and close the last; a port that was empty and stays
    empty is not recorded.  One row a (sn, port, change_time) is assumed.
    """
    w = Window.partitionBy("sn", "port").orderBy("change_time")
    c = configs.withColumn("sensor", F.coalesce("sensor", F.lit("none")))
    was = F.lag(F.struct("sensor", "type", "depth_cm", "status")).over(w)
    c = c.withColumn("_w", was)
    depth = F.coalesce(F.abs(F.col("depth_cm") - F.col("_w.depth_cm")) > tolerance, F.col("depth_cm").isNull() != F.col("_w.depth_cm").isNull())
    changed = F.col("_w").isNull() | ~F.col("sensor").eqNullSafe(F.col("_w.sensor")) | ~F.col("type").eqNullSafe(F.col("_w.type")) | ~F.col("status").eqNullSafe(F.col("_w.status")) | depth
    blank = (F.col("sensor") == "none") & (F.col("_w").isNull() | (F.col("_w.sensor") == "none"))
    kept = c.filter(changed & ~blank).drop("_w")
    return kept.withColumn("valid_to", F.lead("change_time").over(w)).withColumnRenamed("change_time", "valid_from")


def close_ports(ports: DataFrame, closures: DataFrame, keys: list[str]) -> DataFrame:
    """valid_to of open ports set to closed_at where a closure names them; closures: keys (the device, or device and port) and closed_at."""
    c = closures.groupBy(*keys).agg(F.min("closed_at").alias("_at"))
    return spread(ports, keys).join(c, keys, "left").withColumn("valid_to", F.coalesce("valid_to", "_at")).drop("_at")


def update_active_rows(rows: DataFrame, updates: DataFrame, keys: list[str], fields: list[str], status: str = "status") -> DataFrame:
    """Fields of rows that are not terminal, replaced where an update (one a key) has a value; others stay."""
    u = updates.select(*keys, F.struct(*fields).alias("_u"))
    out = rows.join(u, keys, "left")
    live = ~is_terminal(F.col(status))
    new = {f: F.when(live, F.coalesce(F.col("_u")[f], F.col(f))).otherwise(F.col(f)) for f in fields}
    return out.withColumns(new).drop("_u")


def retire_deployments(deployments: DataFrame, retired: DataFrame, status: str = "removed") -> DataFrame:
    """Deployments named by retired (unique_id, at) get a terminal status and that day as their last visit."""
    r = retired.groupBy("unique_id").agg(F.min("at").alias("_at"))
    out = deployments.join(r, "unique_id", "left")
    hit = F.col("_at").isNotNull()
    return out.withColumns({"status": F.when(hit, status).otherwise(F.col("status")), "last_visit": F.when(hit, F.col("_at").cast("date")).otherwise(F.col("last_visit"))}).drop("_at")


def supersede_deployments(deployments: DataFrame, moves: DataFrame, cleared: dict[str, Column]) -> DataFrame:
    """Active rows of moved stations become `relocated`; a copy of each with a new id, place and start follows.

    moves: station_id, new_station_id, at, id_offset.  cleared: columns of the copies that no longer hold.
    """
    m = moves.select("station_id", F.struct("new_station_id", "at", "id_offset").alias("_m"))
    hit = deployments.join(m, "station_id", "left").withColumn("_hit", F.col("_m").isNotNull() & ~is_terminal(F.col("status")))
    old = hit.withColumns({"status": F.when(F.col("_hit"), "relocated").otherwise(F.col("status")), "last_visit": F.when(F.col("_hit"), F.col("_m.at").cast("date")).otherwise(F.col("last_visit"))})
    new = hit.filter("_hit").withColumns({"unique_id": F.col("unique_id") + F.col("_m.id_offset"), "station_id": F.col("_m.new_station_id"), "deploy_datetime": F.col("_m.at"), "last_visit": F.lit(None).cast("date"), **cleared})
    return old.drop("_m", "_hit").unionByName(new.drop("_m", "_hit"))


def delete_latest(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The log without the last row of each key; order must decide."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return log.withColumn("_n", F.row_number().over(w)).filter("_n > 1").drop("_n")


def next_ids(new: DataFrame, existing: DataFrame, prefix: Column, order: list[str], id_col: str = "unique_id") -> DataFrame:
    """new with ids `<prefix>-0001` that go on after the highest number of each prefix among the existing ones."""
    shape = r"^([a-z]+)-([0-9]+)$"
    last = existing.select(F.regexp_extract(id_col, shape, 1).alias("_p"), F.regexp_extract(id_col, shape, 2).try_cast("bigint").alias("_k")).filter("_k is not null").groupBy("_p").agg(F.max("_k").alias("_last"))
    # rows are dealt to ranges of (prefix, order) and written, so that a row's place is the same whenever it is read; a range
    # counts its own rows and needs of the others only how many of its prefix come before it
    dealt = new.withColumn("_p", prefix).repartitionByRange("_p", *order).sortWithinPartitions("_p", *order)
    dealt = scratch.written(dealt.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "numbered")
    counts = dealt.filter("_p is not null").groupBy("_p", "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_p").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = counts.join(last, "_p", "left").select("_p", "_part", (F.coalesce("_last", F.lit(0)) + F.coalesce(before, F.lit(0))).alias("_before"))
    number = F.col("_before") + F.row_number().over(Window.partitionBy("_p", "_part").orderBy("_at"))
    n = dealt.join(first, ["_p", "_part"], "left").withColumn("_k", number)
    padded = F.lpad(F.col("_k").cast("string"), F.greatest(F.lit(4), F.length(F.col("_k").cast("string"))), F.lit("0"))
    return n.withColumn(id_col, F.when(F.col("_p").isNotNull(), F.concat(F.col("_p"), F.lit("-"), padded))).drop("_p", "_part", "_at", "_before", "_k")


def next_station(wanted: DataFrame, stations: DataFrame) -> DataFrame:
    """wanted (site, station_type) with the station_id to take next: `<site>_<type>`, numbered where that is the custom.

    After numbered stations of the same site and type comes the next number, after a plain one number 2; a site's
    first gets number 1 where stations of that type elsewhere are numbered.
    """
    known = stations.select(F.regexp_extract("station_id", r"^(.*?)([0-9]*)$", 1).alias("base"), F.regexp_extract("station_id", r"([0-9]*)$", 1).try_cast("bigint").alias("k")).distinct()
    own = known.groupBy("base").agg(F.max("k").alias("_last"), F.lit(True).alias("_has"))
    custom = known.filter("k is not null").select(F.regexp_extract("base", r"_([^_]+)$", 1).alias("_type")).distinct().withColumn("_numbered", F.lit(True))
    w = wanted.withColumns({"base": F.concat_ws("_", F.lower("site"), F.lower("station_type")), "_type": F.lower("station_type")})
    out = w.join(own, "base", "left").join(custom, "_type", "left")
    suffix = F.when(F.col("_has").isNull(), F.when(F.col("_numbered"), "1").otherwise("")).otherwise(F.coalesce((F.col("_last") + 1).cast("string"), F.lit("2")))
    return out.withColumn("station_id", F.concat("base", suffix)).drop("base", "_type", "_last", "_has", "_numbered")


def add_deployments(deployments: DataFrame, new: DataFrame, prefix: Column, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(all deployments, refused): new rows with generated ids; refused are those whose device is active in the same type.

    Columns that new lacks are null.
    """
    d = deployments.filter(~is_terminal(F.col("status"))).select("device_serial", F.lower("station_type").alias("_type")).distinct()
    n = new.withColumn("_type", F.lower("station_type"))
    refused = n.join(d, ["device_serial", "_type"], "left_semi").drop("_type")
    taken = n.join(d, ["device_serial", "_type"], "left_anti").drop("_type")
    return deployments.unionByName(next_ids(taken, deployments, prefix, order), allowMissingColumns=True), refused


def decommission(deployments: DataFrame, stations: DataFrame, ports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deployments, ports) after stations (station_id, at) close: their active rows become `decommissioned`, and where
    there is none, the removed rows of the device that was visited last.  Ports close of devices that are then nowhere active."""
    s = stations.groupBy("station_id").agg(F.min("at").alias("_at"))
    d = deployments.join(s, "station_id", "left").withColumn("_live", ~is_terminal(F.col("status")))
    at = Window.partitionBy("station_id")
    removed = F.lower("status") == "removed"
    d = d.withColumns({"_any": F.bool_or("_live").over(at), "_last": F.max(F.when(removed & F.col("last_visit").isNotNull(), F.struct("last_visit", "device_serial"))).over(at)})
    hit = F.col("_at").isNotNull() & F.when(F.col("_any"), F.col("_live")).otherwise(F.coalesce(removed & (F.col("device_serial") == F.col("_last.device_serial")), F.lit(False)))
    after = d.withColumns({"_hit": hit, "status": F.when(hit, "decommissioned").otherwise(F.col("status"))})
    idle = after.filter("device_serial is not null").groupBy(F.col("device_serial").alias("sn")).agg(F.max(F.when(F.col("_hit") & F.col("_live"), F.col("_at"))).alias("closed_at"), F.bool_and(is_terminal(F.col("status"))).alias("_gone"))
    closures = idle.filter("closed_at is not null and _gone").select("sn", "closed_at")
    return after.drop("_at", "_live", "_any", "_last", "_hit"), close_ports(ports, closures, ["sn"])


def apply_survey(deployments: DataFrame, surveys: DataFrame, shifts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Surveyed elevations: by id, partners shifted by the same amount, and pairs.

    surveys: unique_id, elev, elev_source (null leaves a value), sensor_height_cm.  shifts: unique_id, shift_by.
    pairs: station_id, primary_serial, secondary_serial, primary_elev, primary_source, difference, reach.  A pair's secondary stands
    at primary + difference (source surveyed_relative); reach is the secondary's.  Active rows only, for pairs.
    """
    s = surveys.select("unique_id", F.struct("elev", "elev_source", "sensor_height_cm").alias("_s"))
    d = deployments.join(s, "unique_id", "left").join(shifts.select("unique_id", F.col("shift_by").alias("_by")), "unique_id", "left")
    own = F.col("_s.elev").isNotNull()
    d = d.withColumns({"elev": F.when(own, F.col("_s.elev")).otherwise(F.col("elev")), "elev_source": F.when(own, F.col("_s.elev_source")).otherwise(F.col("elev_source")), "sensor_height_cm": F.when(F.col("_s").isNotNull(), F.col("_s.sensor_height_cm")).otherwise(F.col("sensor_height_cm"))})
    d = d.withColumn("elev", F.when(F.col("_by").isNotNull(), F.round(F.col("elev") + F.col("_by"), 4)).otherwise(F.col("elev")))
    # a pair applies where both of its devices have an active row at the station
    live = d.filter(~is_terminal(F.col("status"))).groupBy("station_id").agg(F.collect_set("device_serial").alias("_here"))
    both = pairs.join(live, "station_id").filter(F.array_contains("_here", F.col("primary_serial")) & F.array_contains("_here", F.col("secondary_serial")))
    lower = both.select("station_id", F.col("primary_serial").alias("device_serial"), F.struct(F.col("primary_elev").alias("e"), F.col("primary_source").alias("s"), F.col("difference").alias("d"), F.lit(None).cast("double").alias("r")).alias("_p"))
    upper = both.select("station_id", F.col("secondary_serial").alias("device_serial"), F.struct((F.col("primary_elev") + F.col("difference")).alias("e"), F.lit("surveyed_relative").alias("s"), F.col("difference").alias("d"), F.col("reach").alias("r")).alias("_p"))
    out = d.join(lower.unionByName(upper), ["station_id", "device_serial"], "left")
    hit = F.col("_p").isNotNull() & ~is_terminal(F.col("status"))
    raised = hit & F.col("_p.d").isNotNull()
    return out.withColumns({"elev": F.when(raised, F.col("_p.e")).otherwise(F.col("elev")), "elev_source": F.when(raised, F.coalesce("_p.s", "elev_source")).otherwise(F.col("elev_source")), "reach_length_m": F.when(hit, F.coalesce("_p.r", "reach_length_m")).otherwise(F.col("reach_length_m"))}).drop("_s", "_by", "_p")


def invalidate_geometry(deployments: DataFrame, moved: DataFrame) -> DataFrame:
    """Elevations, their sources and reach lengths that a moved device (station_id, device_serial, role) makes wrong, cleared.

    Only hydro stations with a secondary or tertiary among their active rows count: a moved primary clears all of them,
    another device only its own.  A null role is another device.
    """
    m = moved.groupBy("station_id").agg(F.bool_or(F.coalesce(F.lower("role") == "primary", F.lit(False))).alias("_all"), F.collect_set("device_serial").alias("_own"))
    live = ~is_terminal(F.col("status"))
    paired = F.bool_or(live & F.coalesce(F.lower("device_role").isin("secondary", "tertiary"), F.lit(False))).over(Window.partitionBy("station_id"))
    d = deployments.withColumn("_pair", paired).join(m, "station_id", "left")
    hit = live & F.col("_pair") & (F.lower("station_type") == "hydro") & F.coalesce(F.col("_all") | F.array_contains("_own", F.col("device_serial")), F.lit(False))
    keep = lambda c: F.when(~F.coalesce(hit, F.lit(False)), F.col(c))
    return d.withColumns({c: keep(c) for c in ("elev", "elev_source", "reach_length_m")}).drop("_pair", "_all", "_own")


def upsert_keeping(old: DataFrame, new: DataFrame, keys: list[str], kept: list[str]) -> DataFrame:
    """Rows of new replace those of old with their keys, but `kept` columns (such as the time of creation) stay as they were."""
    was = old.select(*keys, F.struct(*kept).alias("_was"))
    merged = new.join(was, keys, "left").withColumns({c: F.coalesce(F.col("_was")[c], F.col(c)) for c in kept}).drop("_was")
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(merged, allowMissingColumns=True)


def update_stages(pending: DataFrame, updates: DataFrame, cleared: DataFrame, stages: tuple[str, ...]) -> DataFrame:
    """Pending work after stage updates (station_id, device_serial, stage, updated) and removals; an unknown stage is an error."""
    keys = ["station_id", "device_serial"]
    known = F.when(F.col("stage").isin(*stages), F.col("stage")).otherwise(F.raise_error(F.concat(F.lit("unknown stage "), F.coalesce("stage", F.lit("(none)")))).cast("string"))
    u = updates.select(*keys, F.struct(known.alias("stage"), "updated").alias("_u"))
    out = pending.join(cleared.select(*keys).distinct(), keys, "left_anti").join(u, keys, "left")
    return out.withColumns({"stage": F.coalesce("_u.stage", "stage"), "updated": F.coalesce("_u.updated", "updated")}).drop("_u")


def replace_deployments(deployments: DataFrame, replacements: DataFrame, prefix: Column) -> DataFrame:
    """Replaced rows (unique_id, new_serial, at) become `replaced` on that day; a copy with the new device and a new id starts then.

    At hydro stations the copy's elevation and its source are cleared.  Rows that are terminal already are not replaced.
    """
    r = replacements.groupBy("unique_id").agg(F.min(F.struct("at", "new_serial")).alias("_r"))
    hit = deployments.join(r, "unique_id", "left").withColumn("_hit", F.col("_r").isNotNull() & ~is_terminal(F.col("status")))
    old = hit.withColumns({"status": F.when(F.col("_hit"), "replaced").otherwise(F.col("status")), "last_visit": F.when(F.col("_hit"), F.col("_r.at").cast("date")).otherwise(F.col("last_visit"))})
    hydro = F.lower("station_type") == "hydro"
    clear = lambda c: F.when(~F.coalesce(hydro, F.lit(False)), F.col(c))
    new = hit.filter("_hit").withColumns({"device_serial": F.col("_r.new_serial"), "deploy_datetime": F.col("_r.at"), "last_visit": F.col("_r.at").cast("date"), "elev": clear("elev"), "elev_source": clear("elev_source")})
    fresh = next_ids(new.drop("_r", "_hit").withColumnRenamed("unique_id", "_old"), deployments, prefix, ["_old"]).drop("_old")
    return old.drop("_r", "_hit").unionByName(fresh)


def delete_deployments(deployments: DataFrame, ids: DataFrame, ports: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deployments, ports) without the rows of these ids; a serial's ports go only if no other row has that serial."""
    gone = deployments.join(ids.select("unique_id").distinct(), "unique_id", "left_semi").select("device_serial").distinct()
    left = deployments.join(ids.select("unique_id").distinct(), "unique_id", "left_anti")
    lost = gone.join(left.select("device_serial").distinct(), "device_serial", "left_anti").select(F.col("device_serial").alias("sn"))
    return left, ports.join(lost, "sn", "left_anti")


def correct_fields(deployments: DataFrame, corrections: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(deployments, log): fields overridden by id on any row, terminal ones too, where a correction has a value.

    log: unique_id, field, old, new of every value that differs from what stood there.
    """
    c = corrections.select("unique_id", F.struct(*fields).alias("_c"))
    d = deployments.join(c, "unique_id", "left")
    changes = F.array(*[F.when(F.col("_c")[f].isNotNull() & ~F.col("_c")[f].eqNullSafe(F.col(f)), F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("old"), F.col("_c")[f].cast("string").alias("new"))) for f in fields])
    log = d.select("unique_id", F.explode(F.array_compact(changes)).alias("x")).select("unique_id", "x.*")
    return d.withColumns({f: F.coalesce(F.col("_c")[f], F.col(f)) for f in fields}).drop("_c"), log


def retire_with_ports(deployments: DataFrame, retired: DataFrame, ports: DataFrame, status: str = "removed") -> tuple[DataFrame, DataFrame]:
    """retire_deployments(), and the open ports of the retired rows' devices closed at that moment."""
    closures = deployments.join(retired, "unique_id").select(F.col("device_serial").alias("sn"), F.col("at").alias("closed_at"))
    return retire_deployments(deployments, retired, status), close_ports(ports, closures, ["sn"])
