"""Sensor matrices and sensor places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streetflow.operators.blocks import row_index
from streetflow.sinks.tables import path_exists

# Header aliases, grid corners, placeholder names.
ID_ALIASES = ("sensor_id", "id")
LAT_ALIASES = ("latitude", "lat")
LON_ALIASES = ("longitude", "lng", "lon")
LAT_RANGE = (33.95, 34.20)
LON_RANGE = (-118.50, -118.10)
PLACEHOLDER = "synth_%03d"
PLACEHOLDERS = 207


def matrix_to_long(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Wide matrix, one column per sensor, to `(timestamp, sensor_id, sensor_index, speed)`.

    The index is the column position. Nulls and NaN are left out.
    """
    names = [c for c in df.columns if c != ts_col]
    cells = df.select(F.col(ts_col).alias("timestamp"),
                      F.posexplode(F.array(*[F.col(f"`{c}`").cast("double") for c in names])).alias("sensor_index", "speed"))
    ids = F.array(*[F.lit(c) for c in names])
    return (cells.filter(F.col("speed").isNotNull() & ~F.isnan("speed"))
            .select("timestamp", F.get(ids, F.col("sensor_index")).alias("sensor_id"), "sensor_index", "speed"))


def adjacency_to_edges(df: DataFrame, row: str = "row", weights: str = "weights") -> tuple[DataFrame, DataFrame]:
    """Matrix rows `(row, weights array)` to `(vertices, edges)`.

    An edge is a positive weight off the diagonal; vertices without edges stay vertices.
    """
    cells = df.select(F.col(row).alias("src"), F.posexplode(weights).alias("dst", "weight"))
    edges = cells.filter((F.col("src") != F.col("dst")) & (F.col("weight") > 0))
    return (df.select(F.col(row).cast("string").alias("id")),
            edges.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"),
                         F.col("weight").cast("double").alias("weight")))


def location_grid(ids: DataFrame, order: Sequence[str] = ("sensor_id",)) -> DataFrame:
    """Place ids row by row on a square grid over the city.

    `order` is the total order the ids are numbered in; an existing `sensor_index` is kept.
    """
    if "sensor_index" not in ids.columns:
        ids = row_index(ids, order, "sensor_index")
    side = F.col("_side")
    total = ids.select(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("bigint")).scalar()

    def spread(step, bounds):
        low, high = bounds
        return F.lit(low) + step * (high - low) / F.greatest(side - 1, F.lit(1))

    return ids.withColumn("_side", total).select(
        "sensor_id", F.col("sensor_index").cast("int").alias("sensor_index"),
        spread(F.floor(F.col("sensor_index") / side), LAT_RANGE).alias("lat"),
        spread(F.pmod(F.col("sensor_index"), side), LON_RANGE).alias("lon"))


def placeholder_ids(spark: SparkSession, n: int = PLACEHOLDERS) -> DataFrame:
    return spark.range(n).select(F.format_string(PLACEHOLDER, "id").alias("sensor_id"),
                                 F.col("id").alias("sensor_index"))


def _pick(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    lower = {c.lower(): c for c in columns}
    return next((lower[a] for a in aliases if a in lower), None)


def read_locations(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Sensor places from the first CSV that has latitude and longitude columns.

    Rows are numbered in file order, which a splittable read does not promise to keep by
    itself: the order is that of file and row position inside the file.
    """
    for path in paths:
        if not path_exists(spark, path):
            continue
        df = spark.read.option("header", "true").csv(path)
        lat, lon = _pick(df.columns, LAT_ALIASES), _pick(df.columns, LON_ALIASES)
        if not lat or not lon:
            continue
        sensor = _pick(df.columns, ID_ALIASES) or df.columns[0]
        placed = df.select(
            F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"),
            F.monotonically_increasing_id().alias("_row"), F.col(f"`{sensor}`").cast("string").alias("sensor_id"),
            F.col(f"`{lat}`").try_cast("double").alias("lat"), F.col(f"`{lon}`").try_cast("double").alias("lon"))
        numbered = row_index(placed, ["_file", "_at", "_row"], "sensor_index")
        return numbered.select("sensor_id", F.col("sensor_index").cast("int").alias("sensor_index"), "lat", "lon")
    return None


def sensor_metadata(spark: SparkSession, csv_paths: Sequence[str], ids: DataFrame | None = None) -> DataFrame:
    """Places from CSV, else known ids on the grid, else placeholders on the grid."""
    found = read_locations(spark, csv_paths)
    if found is not None:
        return found
    return location_grid(placeholder_ids(spark) if ids is None else ids)
