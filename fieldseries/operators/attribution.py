"""Temporal attribution: which deployment, port and station a reading belonged to.

Time is cut into slices.  A window is dealt to the slices that it touches, the windows of a key and slice are
gathered into one ordered array, and readings meet that array by key and slice; the window of a reading is picked
inside the row.  Readings are never multiplied and need no id, a key's readings are spread over its
slices, and no array grows with a key's history.  Nothing assumes a small side.

Windows are dealt to slices between the readings' first and last.  Where readings come out of a join, `moments` names rows
that hold at least their times and are read without it; slices that no reading is in change no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Days in a slice.
SLICE = 365


def covers(w: Column, t: Column) -> Column:
    """Half-open containment; a null end is open."""
    return (w["starts"] <= t) & (w["ends"].isNull() | (t < w["ends"]))


def slice_of(t: Column) -> Column:
    return F.floor(F.unix_micros(t) / F.lit(SLICE * 86_400_000_000))


def sliced(windows: DataFrame, readings: DataFrame, when: str) -> DataFrame:
    """Each window once for every slice that it shares with the readings' span."""
    return _dealt(windows.filter(F.col("starts").isNotNull()), _span(readings, when))


def _span(readings: DataFrame, when: str) -> DataFrame:
    """A single row: the readings' first and last slice."""
    return readings.agg(F.min(slice_of(F.col(when))).alias("_a"), F.max(slice_of(F.col(when))).alias("_b")).withColumn("_one", F.lit(1))


def _dealt(windows: DataFrame, span: DataFrame) -> DataFrame:
    """Rows dealt to the slices of the span that they touch; a null start or end is open."""
    w = windows.withColumn("_one", F.lit(1)).join(F.broadcast(span), "_one")  # a single row
    first, last = F.greatest(slice_of(F.col("starts")), F.col("_a")), F.least(F.coalesce(slice_of(F.col("ends")), F.col("_b")), F.col("_b"))
    return w.filter(first <= last).withColumn("_slice", F.explode(F.sequence(first, last))).drop("_one", "_a", "_b")


def gather(windows: DataFrame, keys: list[str], order: list[str], fields: list[str], name: str = "_ws") -> DataFrame:
    """One row a key and slice with its windows in order; fields that are also in order are not doubled."""
    cols = [*order, *(f for f in fields if f not in order)]
    return windows.groupBy(*keys, "_slice").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))


def _pick(windows: Column, which: str) -> Column:
    return F.when(F.size(windows) > 0, F.try_element_at(windows, F.lit(-1 if which == "last" else 1)))


def interval_join(readings: DataFrame, windows: DataFrame, keys: list[str], when: str, fields: list[str], order: list[str], pick: str = "last", moments: DataFrame | None = None) -> DataFrame:
    """readings with the fields of the window that holds `when`; null where none does.

    Among several the last (or first) in `order` wins.  Columns of windows other than fields stay out.
    """
    ws = gather(sliced(windows, moments or readings, when), keys, order, [*fields, "starts", "ends"])
    joined = readings.withColumn("_slice", slice_of(F.col(when))).join(ws, [*keys, "_slice"], "left")
    out = joined.withColumn("_w", _pick(F.filter("_ws", lambda w: covers(w, F.col(when))), pick)).drop("_ws", "_slice")
    return out.withColumns({f: F.col("_w")[f] for f in fields}).drop("_w")


def resolve_by_device(readings: DataFrame, windows: DataFrame, when: str = "datetime", moments: DataFrame | None = None) -> DataFrame:
    """Station and deployment by device and time only; the last window in (type, start, id) order wins."""
    return interval_join(readings, windows, ["device_serial"], when, ["station_id", "station_type", "unique_id"], ["station_type", "starts", "unique_id"], moments=moments)


def _numbered(ports: DataFrame) -> DataFrame:
    return ports if "win_seq" in ports.columns else ports.withColumn("win_seq", F.row_number().over(Window.partitionBy("device_serial", "port").orderBy("starts", "sensor")))


def resolve_by_port(readings: DataFrame, windows: DataFrame, ports: DataFrame, when: str = "datetime", moments: DataFrame | None = None) -> DataFrame:
    """Sensor, depth and type by port and time, then the station by device, type and time."""
    moments = moments or readings
    on_port = interval_join(readings, _numbered(ports), ["device_serial", "port"], when, ["sensor", "depth_cm", "type"], ["win_seq"], moments=moments)
    typed = windows.withColumnRenamed("station_type", "type")
    return interval_join(on_port, typed, ["device_serial", "type"], when, ["station_id", "unique_id"], ["starts", "unique_id"], moments=moments)


_FIELDS = ("station_id", "station_type", "unique_id")


def _ranked(windows: DataFrame, first_type: str) -> DataFrame:
    return windows.withColumn("rank", F.when(F.col("station_type") == first_type, 0).otherwise(1))


def _at_device(windows: Column, ports: Column, when: str) -> Column:
    """Windows that hold the time and whose type the device has a port of open then (any type, if it has no ports at all)."""
    return F.filter(windows, lambda x: covers(x, F.col(when)) & (~F.col("_has") | F.exists(F.coalesce(ports, F.array()), lambda p: (p["type"] == x["station_type"]) & covers(p, F.col(when)))))


def resolve_device_level(readings: DataFrame, windows: DataFrame, ports: DataFrame | None = None, first_type: str = "weather", when: str = "datetime", moments: DataFrame | None = None) -> DataFrame:
    """Device-level measures: deployments of first_type come first, then by station; the first that holds wins.

    With ports, the device must also have a port of the deployment's type open at that time, unless
    it has no ports at all.
    """
    moments = moments or readings
    ws = gather(sliced(_ranked(windows, first_type), moments, when), ["device_serial"], ["rank", "station_id", "starts", "unique_id"], ["station_type", "ends"])
    joined = readings.withColumn("_slice", slice_of(F.col(when))).join(ws, ["device_serial", "_slice"], "left")
    hold = F.filter("_ws", lambda x: covers(x, F.col(when)))
    if ports is not None:
        ps = gather(sliced(ports, moments, when), ["device_serial"], ["type", "starts"], ["ends"], "_ps")
        joined = with_ports(joined, ports).join(ps, ["device_serial", "_slice"], "left")
        hold = _at_device(F.col("_ws"), F.col("_ps"), when)
    out = joined.withColumn("_w", _pick(hold, "first")).drop("_ws", "_ps", "_slice", "_has")
    return out.withColumns({f: F.col("_w")[f] for f in _FIELDS}).drop("_w")


def with_ports(readings: DataFrame, ports: DataFrame) -> DataFrame:
    """readings with `_has`: whether the device has any port."""
    has = ports.select("device_serial").distinct().withColumn("_has", F.lit(True))
    return readings.join(has, "device_serial", "left").withColumn("_has", F.coalesce("_has", F.lit(False)))


def depth_label(depth: Column) -> Column:
    """30 for 30.0 and 12.5 for 12.5."""
    return F.regexp_replace(depth.cast("string"), r"\.0$", "")


def _known_of_devices(windows: DataFrame, ports: DataFrame, moments: DataFrame, when: str) -> DataFrame:
    """One row a device and slice: `_ws`, its windows in order of precedence, `_ps`, its port configurations, and `_has`,
    whether it has a port at any time.  All three come out of one aggregation, so readings meet them in one join."""
    starts = F.col("starts").isNotNull()
    w = _ranked(windows, "weather").filter(starts).select("device_serial", "starts", "ends", F.struct("rank", "station_id", "starts", "unique_id", "station_type", "ends").alias("_w"))
    p = _numbered(ports).filter(starts).select("device_serial", "starts", "ends", F.struct("win_seq", "sensor", "depth_cm", "type", "starts", "ends", "port").alias("_p"))
    always = F.lit(None).cast("timestamp")
    has = ports.select("device_serial").distinct().withColumns({"starts": always, "ends": always, "_h": F.lit(True)})
    rows = w.unionByName(p, allowMissingColumns=True).unionByName(has, allowMissingColumns=True)
    # by hand, as lists that are begun before a shuffle are longer than their rows
    dealt = _dealt(rows, _span(moments, when)).repartition("device_serial", "_slice").groupBy("device_serial", "_slice")
    return dealt.agg(F.sort_array(F.collect_list("_w")).alias("_ws"), F.sort_array(F.collect_list("_p")).alias("_ps"), F.max("_h").alias("_has"))


def attribute_readings(readings: DataFrame, windows: DataFrame, ports: DataFrame, per_deployment: tuple[str, ...] = ("hydro", "pond"), moments: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(resolved, unattributed) readings with station_id, station_type, unique_id and the series name.

    readings: device_serial, port, datetime, variable, depth (whether the variable needs one), device_level.
    Device-level variables take the prioritised path, devices with ports the port path, others the device path.
    """
    at, t = "datetime", F.col("datetime")
    # every reading meets the arrays once, whichever path it takes
    r = readings.withColumn("_slice", slice_of(t)).join(_known_of_devices(windows, ports, moments or readings, at), ["device_serial", "_slice"], "left")
    r = r.withColumn("_has", F.coalesce("_has", F.lit(False)))
    r = r.withColumn("_p", F.when(~F.col("device_level") & F.col("_has"), _pick(F.filter("_ps", lambda w: (w["port"] == F.col("port")) & covers(w, t)), "last")))
    now = F.filter("_ws", lambda w: covers(w, t))
    last = lambda ws, *by: F.array_max(F.transform(ws, lambda w: F.struct(*[w[c].alias(c) for c in by], w["station_id"].alias("station_id"), w["station_type"].alias("type"))))
    flat = lambda w, kind, key: F.struct(w["station_id"].alias("station_id"), kind.alias("station_type"), key.alias("unique_id"))
    by_type = last(F.filter(now, lambda w: w["station_type"] == F.col("_p.type")), "starts", "unique_id")
    by_device = last(now, "station_type", "starts", "unique_id")
    level = _pick(_at_device(F.col("_ws"), F.col("_ps"), at), "first")
    whole, has = F.col("device_level"), F.col("_has")
    r = r.withColumns({"_t": F.when(~whole & has, by_type), "_d": F.when(~whole & ~has, by_device), "_l": F.when(whole, level)})
    chosen = F.when(F.col("device_level"), flat(F.col("_l"), F.col("_l.station_type"), F.col("_l.unique_id"))).when(F.col("_has"), flat(F.col("_t"), F.col("_p.type"), F.col("_t.unique_id"))).otherwise(flat(F.col("_d"), F.col("_d.station_type"), F.col("_d.unique_id")))
    r = r.withColumn("_w", chosen)
    every = r.withColumns({"sensor": F.col("_p.sensor"), "depth_cm": F.col("_p.depth_cm"), **{f: F.col("_w")[f] for f in _FIELDS}}).drop("_ps", "_ws", "_p", "_t", "_d", "_l", "_w", "_slice", "_has")
    short = F.col("depth") & F.col("depth_cm").isNull()
    name = F.when(F.col("depth"), F.concat(F.col("variable"), F.lit("_"), depth_label(F.col("depth_cm")), F.lit("cm"))).otherwise(F.col("variable"))
    name = F.when(F.col("station_type").isin(*per_deployment), F.concat_ws("_", name, "unique_id")).otherwise(name)
    every = every.withColumn("series", name)
    known = F.col("station_id").isNotNull() & ~short
    return every.filter(known), every.filter(~known)


def _stations_of_devices(windows: DataFrame, ports: DataFrame, moments: DataFrame, when: str) -> DataFrame:
    """`_known_of_devices` with no more than tells whether a reading has a station: `ok` says that a window has one,
    `n` is its place among those of its device and type.  A start or end outside the slice is null, as it decides nothing there."""
    starts = F.col("starts").isNotNull()
    place = F.row_number().over(Window.partitionBy("device_serial", "station_type").orderBy("starts", "unique_id", "station_id"))
    w = windows.filter(starts).select("device_serial", "starts", "ends", F.lit(False).alias("_port"), place.alias("n"), F.col("station_id").isNotNull().alias("ok"), F.col("station_type").alias("type"))
    p = _numbered(ports).filter(starts).select("device_serial", "starts", "ends", F.lit(True).alias("_port"), "win_seq", "sensor", "depth_cm", "type", "port")
    has = ports.select("device_serial").distinct()  # at all times
    rows = w.unionByName(p, allowMissingColumns=True).unionByName(has, allowMissingColumns=True)
    inside = lambda c: F.when(slice_of(F.col(c)) == F.col("_slice"), F.col(c)).alias(c)
    dealt = _dealt(rows, _span(moments, when)).select("device_serial", "_slice", "_port", "n", "ok", "type", "win_seq", "sensor", "depth_cm", "port", inside("starts"), inside("ends"))
    of = lambda kind, *fields: F.collect_list(F.when(kind, F.struct(*fields)))
    ws, ps = of(~F.col("_port"), "type", "n", "ok", "starts", "ends"), of(F.col("_port"), "win_seq", "sensor", "depth_cm", "type", "starts", "ends", "port")
    return dealt.repartition("device_serial", "_slice").groupBy("device_serial", "_slice").agg(ws.alias("_ws"), ps.alias("_ps"), F.bool_or(F.coalesce("_port", F.lit(True))).alias("_has"))


def unattributed_readings(readings: DataFrame, windows: DataFrame, ports: DataFrame, moments: DataFrame | None = None) -> DataFrame:
    """The readings that `attribute_readings` finds no station for, in their own columns."""
    t, whole, has = F.col("datetime"), F.col("device_level"), F.col("_has")
    r = readings.withColumn("_slice", slice_of(t)).join(_stations_of_devices(windows, ports, moments or readings, "datetime"), ["device_serial", "_slice"], "left")
    r = r.withColumn("_has", F.coalesce("_has", F.lit(False)))
    holds = lambda w: (w["starts"].isNull() | (w["starts"] <= t)) & (w["ends"].isNull() | (t < w["ends"]))
    r = r.withColumn("_p", F.when(~whole & has, F.array_max(F.filter("_ps", lambda p: (p["port"] == F.col("port")) & holds(p)))))
    last = lambda only, *by: F.array_max(F.transform(F.filter("_ws", lambda w: only(w) & holds(w)), lambda w: F.struct(*[w[c] for c in by])))["ok"]
    open_ = lambda w: ~has | F.exists("_ps", lambda p: (p["type"] == w["type"]) & holds(p))
    first = lambda w: F.struct(F.when(w["type"] == "weather", 0).otherwise(1).alias("rank"), w["ok"].alias("ok"))
    level = F.array_min(F.transform(F.filter("_ws", lambda w: holds(w) & open_(w)), first))["ok"]
    by_type, by_device = last(lambda w: w["type"] == F.col("_p.type"), "n", "ok"), last(lambda w: F.lit(True), "type", "n", "ok")
    station = F.when(whole, level).when(has, by_type).otherwise(F.when(~whole, by_device))
    short = F.col("depth") & F.col("_p.depth_cm").isNull()
    return r.filter(~(F.coalesce(station, F.lit(False)) & ~short)).select(readings.columns)


def summarize_unattributed(unattributed: DataFrame) -> DataFrame:
    """Rows, first and last time by device, port (null is a group) and variable."""
    return unattributed.groupBy("device_serial", "port", "variable").agg(F.count("*").alias("rows"), F.min("datetime").alias("first"), F.max("datetime").alias("last"))
