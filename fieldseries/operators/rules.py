"""The data-quality rules of a station network: what single rows show and what all rows of a key show, over its tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import PROJECT_ZONE, RAW_NAME
from ..sources import scratch
from .diff import union_all
from .monitor import STAGES
from .quality import STATUSES, Rule, outside, with_end
from .windows import is_terminal

# Fields that a deployment and a maintenance entry must have.
REQUIRED = ("station_id", "device_serial", "status", "deploy_datetime", "lat", "lon", "timezone", "mfger")
MAINTENANCE_REQUIRED = ("field_visit_date", "station_id", "device_serial", "action_type", "logged_by")
# States of a device that is in the field and not read by hand.
IN_FIELD = ("online", "local", "nonresponsive", "defunct")
# What a maintenance entry can be about.
ACTIONS = (
    "battery cleaning device_added device_removal device_renamed device_replacement download elevation_survey inspection logger_relaunch "
    "maintenance metadata_correction metadata_deletion port_config_change station_decommissioned station_established station_reactivated station_relocation"
).split()
ISO_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}(:[0-9]{2})?)?$"
EPOCH = r"^[0-9]{9,13}$"


@dataclass(frozen=True)
class Network:
    """The tables that rules look at.

    deployments: unique_id, device_serial, station_id, station_type, device_role, status, lat, lon, elev, elev_source,
    reach_length_m, timezone, mfger, deploy_datetime, last_visit, last_record, metadata_approved, last_reviewed, and
    the text columns named in `texts`.  ports: sn, port, sensor, type, valid_to.  downloads: filepath, station,
    device_serial, start_date, end_date, n_records.  files: filepath.  maintenance: the required fields.  pending:
    station_id, stage.  profiles (a row a raw file, as read): filepath, readable, has_time, parsed_times, zoned, rows,
    first, last, measures.
    """

    deployments: DataFrame
    ports: DataFrame
    downloads: DataFrame
    files: DataFrame
    maintenance: DataFrame
    pending: DataFrame
    profiles: DataFrame
    texts: tuple[str, ...] = ()


def blank(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | (F.trim(c.cast("string")) == "")


Cell = tuple[Column, Column, Column]


@dataclass(frozen=True)
class RowRule:
    """What a row alone shows: `cells` are (whether it is a violation, its key, its detail), one or more a row."""

    table: str
    cells: Callable[[Network], list[Cell]]


@dataclass(frozen=True)
class Side:
    """Rows of a table that have something to say about a key: `n` counts the rows that are judged, `m` those that they are held
    against, and `t` the ones of either that have a property.  Rows whose key is null are left out unless `nulls`."""

    table: str
    keys: tuple[str | Column, ...]
    when: Column | None = None
    judged: bool = True
    marked: Column | None = None
    nulls: bool = False


@dataclass(frozen=True)
class KeyRule:
    """What all rows of a key show together: a violation where `broken` holds for its n, m and t."""

    table: str
    sides: tuple[Side, ...]
    broken: str
    detail: str = "n"


def _row(table: str, bad: Callable[[], Column], key: str, detail: Callable[[], Column]) -> RowRule:
    return RowRule(table, lambda _: [(bad(), F.col(key), detail())])


def _repeated(table: str, *keys: str, when: Column | None = None) -> KeyRule:
    return KeyRule(table, (Side(table, keys, when, nulls=True),), "n > 1")


def _unknown(table: str, column: str, known: str, known_column: str, when: Column | None = None) -> KeyRule:
    """Values of a column, each once, that another table does not have; the detail is how many rows have it."""
    return KeyRule(table, (Side(table, (column,), when), Side(known, (known_column,), judged=False)), "n > 0 and m = 0")


def _required(n: Network) -> list[Cell]:
    return [(blank(f), F.col("unique_id"), F.lit(f)) for f in REQUIRED if f in n.deployments.columns]


def _texts(bad: Callable[[Column], Column]) -> Callable[[Network], list[Cell]]:
    return lambda n: [(~blank(c) & (F.col(c) != "NA") & bad(F.col(c)), F.concat_ws("|", F.col("unique_id").cast("string"), F.lit(c)), F.col(c)) for c in n.texts]


_day = lambda c: F.date_format(F.from_utc_timestamp(c, PROJECT_ZONE), "yyyyMMdd")
_local_day = lambda c: F.from_utc_timestamp(c, PROJECT_ZONE).cast("date")


def _span_mismatch(_: Network) -> list[Cell]:
    """Logged files whose names give other local days than the log."""
    name = F.element_at(F.split("filepath", "/"), -1)
    logged = F.concat_ws("-", _day("start_date"), _day("end_date"))
    named = F.concat_ws("-", F.regexp_extract(name, RAW_NAME, 2), F.regexp_extract(name, RAW_NAME, 3))
    return [(name.rlike(RAW_NAME) & F.col("start_date").isNotNull() & F.col("end_date").isNotNull() & (named != logged), F.col("filepath"), logged)]


#: What was logged about a file, beside its profile.
LOG = "_log"


_terminal = lambda: is_terminal(F.col("status"))
_open_port = lambda: F.col("valid_to").isNull() & F.col("sensor").isNotNull() & (F.lower("sensor") != "none")


def _rules() -> dict[str, RowRule | KeyRule]:
    c, no = F.col, lambda x: F.coalesce(~x, F.lit(True))
    readable = c("readable")
    return {
        "UNIQUE_ID_DUPLICATES": _repeated("deployments", "unique_id"),
        "MULTIPLE_ACTIVE_SERIAL_SAME_TYPE": _repeated("deployments", "device_serial", "station_type", when=c("status").isin(*IN_FIELD)),
        "REQUIRED_FIELD_NA": RowRule("deployments", _required),
        "INVALID_COORDINATES": _row("deployments", lambda: F.expr("lat not between -90 and 90 or lon not between -180 and 180"), "unique_id", lambda: F.concat_ws(",", "lat", "lon")),
        "INVALID_STATUS": _row("deployments", lambda: no(c("status").isin(*STATUSES)), "unique_id", lambda: c("status")),
        "APPROVED_WITHOUT_DATE": _row("deployments", lambda: ~_terminal() & c("metadata_approved") & c("last_reviewed").isNull(), "unique_id", lambda: c("status")),
        "MULTIPLE_ACTIVE_PORT_CONFIGS": _repeated("ports", "sn", "port", when=c("valid_to").isNull()),
        "INVALID_PORT_NUMBER": _row("ports", lambda: F.expr("port is null or port not between 1 and 6"), "sn", lambda: c("port")),
        "ORPHAN_PORT_SERIAL": _unknown("ports", "sn", "deployments", "device_serial"),
        "TERMINAL_DEVICE_ACTIVE_PORTS": KeyRule("ports", (Side("ports", ("sn",), _open_port()), Side("deployments", ("device_serial",), judged=False, marked=_terminal())), "n > 0 and m > 0 and t = m"),
        "REACH_LENGTH_ON_PRIMARY": _row("deployments", lambda: F.expr("station_type = 'hydro' and reach_length_m is not null and coalesce(device_role, 'primary') = 'primary'"), "unique_id", lambda: c("reach_length_m")),
        "ELEVATION_WITHOUT_SOURCE": _row("deployments", lambda: c("elev").isNotNull() & blank("elev_source"), "unique_id", lambda: c("elev")),
        "EPOCH_IN_DATETIME_FIELD": RowRule("deployments", _texts(lambda v: v.rlike(EPOCH))),
        "UNPARSEABLE_DATETIME": RowRule("deployments", _texts(lambda v: ~v.rlike(ISO_TIME) & ~v.rlike(EPOCH))),
        "ORPHAN_MAINT_STATION": _unknown("maintenance", "station_id", "deployments", "station_id"),
        "MAINT_FIELD_NA": KeyRule("maintenance", tuple(Side("maintenance", (F.lit(f),), marked=blank(f)) for f in MAINTENANCE_REQUIRED), "t / n > 0.5", "round(t / n, 4)"),
        "UNKNOWN_ACTION_TYPE": KeyRule("maintenance", (Side("maintenance", ("action_type",), ~c("action_type").isin(*ACTIONS)),), "n > 0"),
        "MISSING_ARCHIVED_FILE": _unknown("downloads", "filepath", "files", "filepath"),
        "UNKNOWN_DOWNLOAD_STATION": _unknown("downloads", "station", "deployments", "station_id", ~blank("station")),
        "ORPHANED_RAW_FILES": _unknown("files", "filepath", "downloads", "filepath"),
        "DOWNLOAD_ROW_UNIDENTIFIED": _row("downloads", lambda: blank("station") & blank("device_serial"), "filepath", lambda: F.lit("no station and no device")),
        "FILENAME_SPAN_MISMATCH": RowRule("downloads", _span_mismatch),
        "RECORD_DATE_OUTSIDE_DEPLOYMENT": _row("deployments", outside, "unique_id", lambda: c("last_record").cast("timestamp_ntz")),
        "PENDING_UNKNOWN_STATION": _unknown("pending", "station_id", "deployments", "station_id"),
        "PENDING_UNKNOWN_STAGE": KeyRule("pending", (Side("pending", ("stage",), no(c("stage").isin(*STAGES)), nulls=True),), "n > 0"),
        "UNREADABLE_PRODUCT1_FILE": _row("profiles", lambda: F.expr("not readable or rows = 0"), "filepath", lambda: c("rows")),
        "NO_DATETIME_COLUMN": _row("profiles", lambda: F.expr("readable and not has_time"), "filepath", lambda: c("rows")),
        "TIMESTAMPS_UNPARSEABLE": _row("profiles", lambda: F.expr("readable and has_time and parsed_times < rows"), "filepath", lambda: c("rows") - c("parsed_times")),
        "TIMESTAMPS_WITHOUT_ZONE": _row("profiles", lambda: F.expr("readable and has_time and not zoned"), "filepath", lambda: c("rows")),
        "READING_COUNT_MISMATCH": _row("profiles", lambda: readable & (c("rows") != c(f"{LOG}.n_records")), "filepath", lambda: c("rows")),
        "SPAN_MISMATCH": _row("profiles", lambda: readable & ((_local_day("first") != _local_day(f"{LOG}.start_date")) | (_local_day("last") != _local_day(f"{LOG}.end_date"))), "filepath", lambda: c("rows")),
        "NO_MEASUREMENT_COLUMNS": _row("profiles", lambda: F.expr("readable and measures = 0"), "filepath", lambda: c("rows")),
        "SPAN_REVERSED": _row("profiles", lambda: F.expr("readable and first > last"), "filepath", lambda: c("rows")),
    }


#: The names of all rules, each with its table, in the order in which they are told.
RULES = {
    "UNIQUE_ID_DUPLICATES": "deployments",
    "MULTIPLE_ACTIVE_SERIAL_SAME_TYPE": "deployments",
    "REQUIRED_FIELD_NA": "deployments",
    "INVALID_COORDINATES": "deployments",
    "INVALID_STATUS": "deployments",
    "APPROVED_WITHOUT_DATE": "deployments",
    "MULTIPLE_ACTIVE_PORT_CONFIGS": "ports",
    "INVALID_PORT_NUMBER": "ports",
    "ORPHAN_PORT_SERIAL": "ports",
    "TERMINAL_DEVICE_ACTIVE_PORTS": "ports",
    "REACH_LENGTH_ON_PRIMARY": "deployments",
    "ELEVATION_WITHOUT_SOURCE": "deployments",
    "EPOCH_IN_DATETIME_FIELD": "deployments",
    "UNPARSEABLE_DATETIME": "deployments",
    "ORPHAN_MAINT_STATION": "maintenance",
    "MAINT_FIELD_NA": "maintenance",
    "UNKNOWN_ACTION_TYPE": "maintenance",
    "MISSING_ARCHIVED_FILE": "downloads",
    "UNKNOWN_DOWNLOAD_STATION": "downloads",
    "ORPHANED_RAW_FILES": "files",
    "DOWNLOAD_ROW_UNIDENTIFIED": "downloads",
    "FILENAME_SPAN_MISMATCH": "downloads",
    "RECORD_DATE_OUTSIDE_DEPLOYMENT": "deployments",
    "PENDING_UNKNOWN_STATION": "pending",
    "PENDING_UNKNOWN_STAGE": "pending",
    "UNREADABLE_PRODUCT1_FILE": "profiles",
    "NO_DATETIME_COLUMN": "profiles",
    "TIMESTAMPS_UNPARSEABLE": "profiles",
    "TIMESTAMPS_WITHOUT_ZONE": "profiles",
    "READING_COUNT_MISMATCH": "profiles",
    "SPAN_MISMATCH": "profiles",
    "NO_MEASUREMENT_COLUMNS": "profiles",
    "SPAN_REVERSED": "profiles",
}
#: What is logged about a file, with the types in which it is held against the file.
_LOG = {"start_date": "timestamp", "end_date": "timestamp", "n_records": "bigint"}


def _claims(n: Network, chosen: dict[str, RowRule | KeyRule], log: bool) -> DataFrame:
    """(rule, id, key, n, m, t): what each key comes to in each rule, from one pass over each table and one aggregation.

    With `log`, each different log entry of a file is a row too (rule LOG, with the file as its id).

    All that is gathered is a sum, so Spark aggregates by hashes; a greatest key or a struct beside the sums would make it sort
    every claim, before and after they move.  A key is told apart only where it differs from its id.
    """
    by_table: dict[str, list[Column]] = {}
    entry = list(_LOG) if log else []
    blank_entry = [F.lit(None).cast(_LOG[c]).alias(c) for c in entry]
    zero, one, same = F.lit(0).cast("bigint"), F.lit(1).cast("bigint"), F.lit(None).cast("string")
    for name, r in chosen.items():
        for s in r.sides if isinstance(r, KeyRule) else ():
            keys = [F.col(k) if isinstance(k, str) else k for k in s.keys]
            marked = F.coalesce(s.marked, F.lit(False)).cast("bigint") if s.marked is not None else zero
            several = len(keys) > 1
            key = F.concat_ws("|", *[k.cast("string") for k in keys]) if several else same
            id_ = F.to_json(F.struct(*[k.cast("string").alias(f"k{i}") for i, k in enumerate(keys)])) if several else keys[0].cast("string")
            claim = F.struct(F.lit(name).alias("rule"), id_.alias("id"), key.alias("key"), (one if s.judged else zero).alias("n"), (zero if s.judged else one).alias("m"), marked.alias("t"), *blank_entry)
            when = (F.lit(True) if s.when is None else s.when) & (F.lit(True) if s.nulls else keys[0].isNotNull())
            by_table.setdefault(s.table, []).append(F.when(when, claim))
    if log:
        by_table.setdefault("downloads", []).append(F.struct(F.lit(LOG).alias("rule"), F.col("filepath").alias("id"), same.alias("key"), zero.alias("n"), zero.alias("m"), zero.alias("t"), *[F.col(c).cast(_LOG[c]).alias(c) for c in entry]))
    parts = [_told(getattr(n, t), claims) for t, claims in by_table.items()]
    sums = union_all(parts).groupBy("rule", "id", "key", *entry).agg(F.sum("n").alias("n"), F.sum("m").alias("m"), F.sum("t").alias("t"))
    return sums.withColumn("key", F.coalesce("key", "id"))


def _told(df: DataFrame, cells: list[Column]) -> DataFrame:
    """A row for each cell (a struct with a rule) that is not null."""
    return df.select(F.inline(F.array(*cells))).filter("rule is not null")


def _logged(claims: DataFrame) -> DataFrame:
    """(filepath, what was logged about it); the first entry wins where a file is logged twice."""
    return claims.filter(F.col("rule") == LOG).groupBy(F.col("id").alias("filepath")).agg(F.min(F.struct(*_LOG)).alias(LOG))


def _broken(claims: DataFrame, chosen: dict[str, RowRule | KeyRule]) -> DataFrame:
    """(rule, key, detail) of the keys that break their rule."""
    text = F.lit(None).cast("string")
    for name, r in chosen.items():
        if isinstance(r, KeyRule):
            text = F.when((F.col("rule") == name) & F.expr(r.broken), F.expr(r.detail).cast("string")).otherwise(text)
    return claims.withColumn("detail", text).filter("detail is not null").select("rule", "key", "detail")


def _by_row(n: Network, chosen: dict[str, RowRule | KeyRule], log: DataFrame | None) -> list[DataFrame]:
    """(rule, key, detail) of the rows that break their rule, from one pass over each table."""
    by_table: dict[str, list[Column]] = {}
    for name, r in chosen.items():
        for bad, key, detail in r.cells(n) if isinstance(r, RowRule) else ():
            by_table.setdefault(r.table, []).append(F.when(bad, F.struct(F.lit(name).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))))
    out = []
    for t, cells in by_table.items():
        df = getattr(n, t)
        if "RECORD_DATE_OUTSIDE_DEPLOYMENT" in chosen and t == "deployments":
            df = with_end(df)
        if t == "profiles" and log is not None:
            df = df.join(log, "filepath", "left")
        out.append(_told(df, cells))
    absent = [f for f in REQUIRED if f not in n.deployments.columns] if "REQUIRED_FIELD_NA" in chosen else []
    if absent:
        out.append(n.deployments.sparkSession.createDataFrame([("REQUIRED_FIELD_NA", None, f) for f in absent], "rule string, key string, detail string"))
    return out


_LOGGED = ("READING_COUNT_MISMATCH", "SPAN_MISMATCH")


def violations(n: Network, names: list[str] | None = None) -> DataFrame:
    """(rule, table, key, detail) of all rules, or of those named.

    Whatever the number of rules, each table is read at most twice: once for what its rows show alone and once for its keys.
    What the keys come to is a written table where files are also held against their log rows.
    """
    every = _rules()
    chosen = {name: every[name] for name in (RULES if names is None else names)}
    log = any(name in chosen for name in _LOGGED)
    claims = None
    if log or any(isinstance(r, KeyRule) for r in chosen.values()):
        claims = _claims(n, chosen, log)
        claims = scratch.written(claims, "claims") if log else claims
    parts = _by_row(n, chosen, _logged(claims) if log else None)
    if any(isinstance(r, KeyRule) for r in chosen.values()):
        parts.append(_broken(claims, chosen))
    tables = F.create_map(*[F.lit(x) for pair in RULES.items() for x in pair])
    return union_all(parts).select("rule", tables[F.col("rule")].alias("table"), "key", "detail")


def summary(n: Network) -> DataFrame:
    """rule, n, passed: a row for every rule, also for those without violations."""
    spark = n.deployments.sparkSession
    names = spark.createDataFrame([(name,) for name in RULES], "rule string")
    found = violations(n).groupBy("rule").agg(F.count("*").alias("n"))
    return names.join(found, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("n"), F.col("n").isNull().alias("passed"))


def rule(n: Network, name: str) -> Rule:
    return Rule(name, RULES[name], violations(n, [name]).select("key", "detail"))


def load_errors(errors: dict[str, DataFrame]) -> DataFrame:
    """LOAD_<table> for every value that a typed read could not take: (rule, key, detail) from each table's error frame."""
    parts = [e.select(F.lit(f"LOAD_{t.upper()}").alias("rule"), F.col("column").alias("key"), F.col("value").alias("detail")) for t, e in errors.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
