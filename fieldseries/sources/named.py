"""The network's own tables: their declared columns, their loaders with what each one does on top, and guarded writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import PROJECT_ZONE, format_datetime
from ..operators.diff import content_fingerprint
from .tables import conform_whole, read_text_table, read_typed_table

#: Columns and kinds of each table.
SCHEMAS: dict[str, dict[str, str]] = {
    "deployments": {"unique_id": "text", "station_id": "text", "station_type": "text", "device_serial": "text", "device_role": "text", "lat": "number", "lon": "number", "interval_min": "integer", "deploy_datetime": "datetime_local", "status": "text", "battery": "integer", "last_visit": "date", "expiry_date": "date", "metadata_approved": "logical", "last_reviewed": "datetime_utc"},
    "ports": {"sn": "text", "port": "integer", "type": "text", "sensor": "text", "depth_cm": "number", "status": "text", "valid_from": "datetime_local", "valid_to": "datetime_local"},
    "downloads": {"timestamp_utc": "datetime_utc", "station": "text", "device_serial": "text", "start_date": "datetime_local", "end_date": "datetime_local", "n_records": "integer", "filepath": "text"},
    "maintenance": {"field_visit_date": "date", "station_id": "text", "device_serial": "text", "action_type": "text", "logged_by": "text"},
    "known_unattributed": {"device_serial": "text", "device_name": "text", "port": "integer", "from": "datetime_local", "to": "datetime_local", "reason": "text"},
}
REGISTRY = ["source", "sensor", "measurement", "keep", "variable", "unit", "kind", "depth", "source_unit", "note"]
#: From when records are confirmed where no row says so.
CONFIRMED_FROM = "2026-09-01"


def load_named_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, tuple[DataFrame, DataFrame]]:
    """name -> (typed rows, errors) of the tables under a folder; a table that is not there is empty."""
    return {n: read_typed_table(spark, f"{root}/{n}", SCHEMAS[n]) for n in names or SCHEMAS}


def load_whole_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """load_named_tables() with a row's errors beside it (`_errors`, see tables.conform_whole()), for those who need both of large tables."""
    return {n: conform_whole(read_text_table(spark, f"{root}/{n}", SCHEMAS[n]), SCHEMAS[n]) for n in names or SCHEMAS}


def load_pending(raw: DataFrame) -> DataFrame:
    """Pending work as text: missing values are empty, rows without any value go."""
    text = raw.select(*[F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).alias(c) for c in raw.columns])
    return text.filter(F.concat(*text.columns) != "")


def load_confirmed_dates(table: DataFrame) -> DataFrame:
    """(station_id, confirmed_from) with the default row, which is added where the table has none."""
    own = table.select("station_id", F.col("confirmed_from").cast("date").alias("confirmed_from"))
    seed = own.sparkSession.range(1).select(F.lit("(default)").alias("station_id"), F.lit(CONFIRMED_FROM).cast("date").alias("confirmed_from"))
    return own.unionByName(seed.join(own, "station_id", "left_anti").select("station_id", "confirmed_from"))


def load_variable_registry(spark: SparkSession, path: str) -> DataFrame:
    """The registry of measurements: keep and depth as logicals, a blank sensor as the wildcard."""
    r = spark.read.option("header", True).csv(path).select(*REGISTRY)
    yes = lambda c: F.upper(F.trim(F.col(c))).isin("TRUE", "T", "1")
    return r.withColumns({"sensor": F.coalesce(F.trim("sensor"), F.lit("")), "keep": F.coalesce(yes("keep"), F.lit(False)), "depth": F.coalesce(yes("depth"), F.lit(False))})


def table_state(df: DataFrame) -> str:
    """A fingerprint of a whole table, whatever the order of its rows."""
    r = content_fingerprint(df.withColumn("_all", F.lit(0)), ["_all"], df.columns).first()
    return f"{r.rows}:{r.fingerprint}" if r else "0:"


def as_text(df: DataFrame, schema: dict[str, str], zone: str = PROJECT_ZONE) -> DataFrame:
    """Columns in the declared order as the text that the table holds; missing or further columns are refused."""
    if set(df.columns) != set(schema):
        raise ValueError(f"columns {sorted(set(df.columns) ^ set(schema))} are missing or not declared")

    def one(c: str, kind: str):
        if kind == "logical":
            value = F.upper(F.col(c).cast("string"))
        elif kind.startswith("datetime"):
            value = format_datetime(F.col(c), "UTC" if kind == "datetime_utc" else zone)
        else:
            value = F.col(c).cast("string")
        return F.coalesce(value, F.lit("NA")).alias(c)

    return df.select(*[one(c, k) for c, k in schema.items()])


def write_typed_table(df: DataFrame, path: str, schema: dict[str, str], base: str | None = None) -> str:
    """Replace a table as a whole; the state that it has then, for the next writer's `base`.

    With base, the table must still be as it was when that state was taken; else nothing is written.
    """
    spark, text = df.sparkSession, as_text(df, schema)
    if base is not None:
        now = table_state(as_text(read_typed_table(spark, path, schema)[0], schema))
        if now != base:
            raise ValueError("the table was changed since it was read")
    text.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)
    return table_state(as_text(read_typed_table(spark, path, schema)[0], schema))
