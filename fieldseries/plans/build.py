"""The whole build: raw long readings to station products, with reports, and the rebuilding of what is stale."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import PROJECT_ZONE, station_type_of
from ..operators import attribution, diff, mapping, unattributed
from ..operators import windows as deployed
from ..sources import scratch
from ..sources.files import candidate_files
from . import products

KEYS = ["station_id", "variable", "year"]


#: Candidate files up to this number go to every task, which lets Spark prune the folders of readings before it reads.
FEW_FILES = 50_000


@dataclass(frozen=True)
class Build:
    series: DataFrame
    manifest: DataFrame
    unmapped: DataFrame
    unattributed: DataFrame
    problems: DataFrame
    deduped: DataFrame
    unlogged: DataFrame


def read_file_set(long: DataFrame, registry: DataFrame, log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mapped readings with their files' fetch times, unmapped measurements, unlogged files).

    long: filepath and the columns of map_measurements().  The log is the record of what was fetched: a file that it lacks,
    an old name beside a renamed one most often, is left out and listed, and stops nothing.
    """
    times = log.groupBy("filepath").agg(F.min("timestamp_utc").alias("fetched_utc"))
    logged = long.join(times, "filepath")
    unlogged = long.select("filepath").distinct().join(times, "filepath", "left_anti")
    return mapping.map_measurements(logged, registry), mapping.count_unmapped(logged, registry), unlogged


def fingerprints(station_years: DataFrame, metadata: DataFrame, ports: DataFrame, columns: list[str], port_columns: list[str]) -> DataFrame:
    """(station_id, year, metadata_fingerprint, ports_fingerprint) of the loggers at each station in each year.

    station_years: station_id, year, device_serial (see windows.devices_in_years()).  columns and port_columns are those that
    decide a product, so that a battery reading changes neither.  A station-year without rows has the fingerprint `none`.
    """
    keys = ["station_id", "year"]

    def of(rows: DataFrame, cols: list[str], name: str) -> DataFrame:
        own = rows.select("device_serial", *[F.col(c).alias(f"_{c}") for c in cols])
        return diff.content_fingerprint(station_years.join(own, "device_serial"), keys, [f"_{c}" for c in cols]).select(*keys, F.col("fingerprint").alias(name))

    both = station_years.select(*keys).distinct().join(of(metadata, columns, "metadata_fingerprint"), keys, "left").join(of(ports, port_columns, "ports_fingerprint"), keys, "left")
    return both.select(*keys, *[F.coalesce(c, F.lit("none")).alias(c) for c in products.FINGERPRINTS])


METADATA = ["unique_id", "station_id", "station_type", "starts", "ends"]
PORTS = ["port", "sensor", "type", "depth_cm", "starts", "ends"]


def wanted_station_years(windows: DataFrame, ports: DataFrame, candidates: DataFrame, years: DataFrame) -> DataFrame:
    """(station_id, year, inputs, metadata_fingerprint, ports_fingerprint): what each station-year with a candidate file would be built from.

    candidates: station_id, year, filepath (the logged ones of files.candidate_files()); years: year, y0, y1.
    """
    marks = fingerprints(deployed.devices_in_years(windows, years), windows, ports, METADATA, PORTS)
    inputs = candidates.groupBy("station_id", "year").agg(F.array_sort(F.collect_set("filepath")).alias("inputs"))
    return inputs.join(marks, ["station_id", "year"], "left")


def local_years(spark: SparkSession, first: int, last: int, zone: str = PROJECT_ZONE) -> DataFrame:
    """(year, y0, y1): local years and the instants at which they begin and end."""
    start = lambda y: F.to_utc_timestamp(F.make_timestamp(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)), zone)
    y = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return y.withColumns({"y0": start(F.col("year")), "y1": start(F.col("year") + 1)})


def build_products(long: DataFrame, registry: DataFrame, windows: DataFrame, ports: DataFrame, log: DataFrame, stations: list[str] | None = None, years: list[int] | None = None, zone: str = PROJECT_ZONE, names: DataFrame | None = None, candidates: DataFrame | None = None, built: str | None = None) -> Build:
    """All products of the readings in one plan: map, attribute, dedupe, align, lay stints by local year, with their manifest.

    stations and years choose what is kept.  names: unique_id, device_name.  candidates: station_id, year, filepath, the files
    that were chosen for each station-year; the manifest's inputs.  Files that the log lacks are listed in `unlogged`.
    """
    mapped, unmapped, unlogged = read_file_set(long, registry, log)
    ready = mapped.withColumns({"depth": F.coalesce("depth", F.lit(False)), "device_level": F.col("variable") == "logger_pressure", "source_file": F.col("filepath")})
    resolved, lost = attribution.attribute_readings(ready.drop("sensor"), windows, ports)
    named = resolved.withColumns({"variable": F.col("series"), "sensor": F.coalesce("sensor", F.lit(""))})
    if stations is not None:
        named = named.filter(F.col("station_id").isin(stations))
    series, clean, problems = products.build_series(named, zone)
    span = series.agg(F.min("year"), F.max("year")).first()  # of a written table
    marks = fingerprints(deployed.devices_in_years(windows, local_years(long.sparkSession, *span, zone)), windows, ports, METADATA, PORTS) if span[0] is not None else None
    manifest = products.manifest(series, clean, zone, problems, names, marks, candidates, built)
    if years is not None:
        series, manifest = (d.filter(F.col("year").isin(years)) for d in (series, manifest))
    return Build(series, manifest, unmapped, lost, problems, clean, unlogged)


def product_path(station: str, variable: str, year: int, product: int = 2) -> str:
    """Where a product of one station, variable and year lies; levels 2 to 9."""
    if not 2 <= product <= 9:
        raise ValueError("products have levels 2 to 9")
    kind = station.rsplit("_", 1)[-1].rstrip("0123456789")
    return f"p{product}/{kind}/{station}/{variable}/{station}_{variable}_p{product}_{year}.csv.gz"


def with_layout(df: DataFrame, product: int = 2) -> DataFrame:
    """df with station_type and the path that product_path() gives, as columns."""
    kind = station_type_of(F.col("station_id"))
    name = F.concat_ws("_", "station_id", "variable", F.lit(f"p{product}"), F.col("year").cast("string"))
    return df.withColumns({"station_type": kind, "product_path": F.concat_ws("/", F.lit(f"p{product}"), kind, "station_id", "variable", F.concat(name, F.lit(".csv.gz")))})


def write_product_text(series: DataFrame, path: str, zone: str = PROJECT_ZONE) -> None:
    """Products as gzipped CSV with local times; exactly the partitions that series holds are replaced."""
    local = F.date_format(F.from_utc_timestamp("datetime", zone), "yyyy-MM-dd HH:mm:ss").alias("datetime")
    out = series.withColumn("station_type", station_type_of(F.col("station_id"))).select("station_type", *KEYS, local, "value", "flag", "device_serial", "source_file", "conflict")
    out.repartition(*KEYS).sortWithinPartitions(*KEYS, "datetime").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).option("compression", "gzip").partitionBy("station_type", *KEYS).csv(path)


PRODUCT = "datetime string, value double, flag string, device_serial string, source_file string, conflict boolean, station_type string, station_id string, variable string, year int"


def read_product(spark: SparkSession, path: str, zone: str = PROJECT_ZONE) -> DataFrame:
    """Products that write_product_text() wrote, with forced types and instants again."""
    d = spark.read.schema(PRODUCT).option("header", True).csv(path)
    return d.withColumn("datetime", F.to_utc_timestamp(F.col("datetime").cast("timestamp"), zone))


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The manifest as text; None where there is none yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return None
    m = spark.read.parquet(path)
    return m.select(*[(F.array_join(c, ", ") if t.startswith("array") else F.col(c).cast("string")).alias(c) for c, t in m.dtypes])


def drop_stale_partitions(existing: DataFrame, written: DataFrame) -> DataFrame:
    """(station_id, variable, year) that a rebuilt station-year no longer makes: they exist, the station-year was rebuilt, and
    it was not written.  A VersionedProducts table leaves them out as it publishes the rebuilding."""
    scope = written.select("station_id", "year").distinct()
    return existing.select(*KEYS).distinct().join(scope, ["station_id", "year"], "left_semi").join(written.select(*KEYS).distinct(), KEYS, "left_anti")


def retired_partitions(here: DataFrame, replica: DataFrame, manifest_here: DataFrame, manifest_there: DataFrame, most: float = 0.25) -> DataFrame:
    """Product files (filepath) of a replica that are neither here nor in the manifest (product_path).

    Refused as a whole where the manifests differ, or where more than a share `most` of the replica would go.
    """
    shaped = replica.filter(F.col("filepath").rlike(r"^p[2-9]/[a-z]+/[^/]+/[^/]+/[^/]+_p[2-9]_[0-9]{4}\.csv\.gz$"))
    gone = shaped.join(here.select("filepath"), "filepath", "left_anti").join(manifest_here.select(F.col("product_path").alias("filepath")), "filepath", "left_anti")
    differ = manifest_here.select("product_path").exceptAll(manifest_there.select("product_path")).unionByName(manifest_there.select("product_path").exceptAll(manifest_here.select("product_path")))
    if not differ.isEmpty():
        raise ValueError("the manifests differ")
    if gone.count() > most * replica.count():
        raise ValueError("more of the replica would go than is allowed")
    return gone.select("filepath").distinct()


def code_version_changed(manifest: DataFrame, logic_version: str = products.LOGIC_VERSION) -> DataFrame:
    """Manifest rows that other logic than today's built."""
    return manifest.filter(~F.col("logic_version").eqNullSafe(F.lit(logic_version)))


def needed_readings(stale: DataFrame, long: DataFrame, windows: DataFrame, files: DataFrame, log: DataFrame, zone: str = PROJECT_ZONE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(readings, candidates, unlogged) for stale station-years (station_id, year).

    files: filepath, device_serial, start_date, end_date.  Only files of devices that stood at a stale station in that year
    and that touch the year are read, and of them the rows of the year and a day around it, so that what lies just over
    an edge is there to interpolate.  With readings in a folder a file, Spark skips the other folders before it reads.
    """
    spark, keys = long.sparkSession, stale.select("station_id", F.col("year").cast("int").alias("year")).distinct()
    span = keys.agg(F.min("year"), F.max("year")).first()
    years = local_years(spark, *(span if span[0] is not None else (1, 0)), zone)
    logged, unlogged = candidate_files(files, windows, log, years)
    mine = lambda d: d.join(keys, ["station_id", "year"], "left_semi")
    candidates = scratch.written(mine(logged), "candidates")
    day = F.expr("interval 1 day")
    spans = candidates.join(years, "year").groupBy("filepath").agg(F.min(F.col("y0") - day).alias("_lo"), F.max(F.col("y1") + day).alias("_hi")).filter(F.col("_lo") < F.col("_hi"))
    few = candidates.select("filepath").distinct().limit(FEW_FILES + 1).count() <= FEW_FILES
    near = (F.col("datetime") >= F.col("_lo")) & (F.col("datetime") <= F.col("_hi"))
    return long.join(F.broadcast(spans) if few else spans, "filepath").filter(near).drop("_lo", "_hi"), candidates, mine(unlogged).select("filepath").distinct()


def rebuild_stale(stale: DataFrame, long: DataFrame, registry: DataFrame, windows: DataFrame, ports: DataFrame, log: DataFrame, files: DataFrame, zone: str = PROJECT_ZONE, names: DataFrame | None = None, built: str | None = None) -> Build:
    """The build of exactly the stale station-years (station_id, year), from the files that they need; equal to their part of a full build."""
    keys = stale.select("station_id", F.col("year").cast("int").alias("year")).distinct()
    readings, candidates, unlogged = needed_readings(keys, long, windows, files, log, zone)
    b = build_products(readings, registry, windows, ports, log, zone=zone, names=names, candidates=candidates, built=built)
    only = lambda d: d.join(keys, ["station_id", "year"], "left_semi")
    return Build(only(b.series), only(b.manifest), b.unmapped, b.unattributed, b.problems, b.deduped, unlogged)


def report_totals(manifest: DataFrame) -> DataFrame:
    """One row: products, readings, missing, conflicts, repeats, and the products that need a look."""
    return manifest.agg(F.count("*").alias("products"), F.sum("rows").alias("rows"), F.sum("missing").alias("missing"), F.sum("conflicts").alias("conflicts"), F.coalesce(F.sum("repeats"), F.lit(0)).cast("bigint").alias("repeats"), F.count_if(F.col("conflicts") > 0).alias("to_look_at"))


def build_report(b: Build, windows: DataFrame, known: DataFrame, now: str, recent_days: int = 365) -> dict[str, DataFrame]:
    """A build's summaries: totals, products with conflicts or problems, unmapped measurements, files that the log lacks,
    and unattributed episodes, recent ones apart.  Episodes are written once (a scratch table that stays), as both
    parts of them are read."""
    starts = windows.groupBy("device_serial").agg(F.min("starts").alias("starts"))
    episodes = scratch.written(unattributed.unattributed_episodes(unattributed.classify_unattributed(b.unattributed, starts, known)), "episodes")
    recent = F.col("last") >= F.lit(now).cast("timestamp") - F.make_dt_interval(days=F.lit(recent_days))
    return {"totals": report_totals(b.manifest), "look": b.manifest.filter("conflicts > 0"), "problems": b.problems, "unmapped": b.unmapped, "recent": episodes.filter(recent), "older": episodes.filter(~recent), "unlogged": b.unlogged}
