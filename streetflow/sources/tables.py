"""Reading of the stored tables."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.operators.contracts import (
    CCTV_INFERRED, GPS, PREDICTIONS, SENSORS, WEATHER, Contract,
)
from streetflow.sinks.tables import TXN, has_delta, path_exists

logger = logging.getLogger(__name__)

# The tables an explorer can choose from.
EXPLORER_TABLES = ["sensor_speeds", "cv_vehicle_counts", "gps_trips", "weather", "speed_predictions",
                   "rerouting_alerts", "sensor_metadata", "dlq_sensors", "pipeline_latency"]


def _ddl(contract: Contract, *more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in contract.schema] + list(more))


# Declared columns of the stored tables: reading one never opens file footers to learn them.
TABLE_COLUMNS = {
    "sensor_speeds": _ddl(SENSORS, "event_date date"),
    "dlq_sensors": _ddl(SENSORS, "value string, dlq_errors array<string>, dlq_reason string, dlq_at timestamp, batch_id bigint"),
    "rerouting_alerts": "id string, sensor_id string, speed float, distances map<string,int>, batch_id bigint",
    "pipeline_latency": "topic string, batch_id bigint, valid_count bigint, invalid_count bigint, alerts_count bigint,"
                        " batch_seconds double, batch_finished_at double",
    "gps_trips": _ddl(GPS, "event_date date"),
    "cv_vehicle_counts": _ddl(CCTV_INFERRED, "event_date date"),
    "speed_predictions": _ddl(PREDICTIONS, "event_date date"),
    "weather": _ddl(WEATHER),
    "graph_pagerank": "id string, pagerank float",
    "graph_shortest_paths": "id string, distances map<string,int>",
    "sensor_metadata": "sensor_id string, sensor_index int, lat double, lon double",
}


def load_table(spark: SparkSession, path: str, columns: str | None = None) -> DataFrame | None:
    """The table at `path`, or None when there is none.

    Columns a file lacks read as null. Without declared `columns` they are merged from the
    footers of all files, which takes long on a table of many files.
    """
    if not path_exists(spark, path):
        return None
    try:
        if has_delta(spark):
            return spark.read.format("delta").load(path)
        reader = spark.read.option("mergeSchema", "true") if columns is None else spark.read.schema(columns)
        return reader.parquet(path).drop(TXN)
    except AnalysisException as error:
        # A folder in which nothing has been stored yet.
        if error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"):
            return None
        raise


def read_table(spark: SparkSession, root: str, name: str, limit: int | None = None,
               sort_col: str | None = None, tie: str | None = None,
               days: tuple[str, str] | None = None) -> DataFrame:
    """First rows of a table, newest first when `sort_col` exists (S2); a missing table is empty.

    `days` (first and last, inclusive) reads only those days of a table partitioned by day.
    """
    df = load_table(spark, f"{root.rstrip('/')}/{name}", TABLE_COLUMNS.get(name))
    if df is None:
        return spark.createDataFrame([], "value string").drop("value")
    if days is not None:
        df = df.filter(F.col("event_date").between(*[F.lit(d).cast("date") for d in days]))
    if sort_col in df.columns:
        df = df.orderBy(*[F.col(c).desc_nulls_last() for c in (sort_col, tie) if c])
    return df if limit is None else df.limit(limit)


def load_static(spark: SparkSession, path: str) -> DataFrame | None:
    """Lookup table of a stream; None with a warning switches the feature off (S3)."""
    df = load_table(spark, path, TABLE_COLUMNS.get(path.rstrip("/").rsplit("/", 1)[-1]))
    if df is None:
        logger.warning("no table at %s: enrichment is off", path)
    return df


def explore(spark: SparkSession, root: str, name: str, limit: int | None = 200) -> DataFrame:
    """Raw rows of a table of the catalogue."""
    if name not in EXPLORER_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return read_table(spark, root, name, limit)
