"""Taxi trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the public trip files and the names and types used here.
TRIP_COLUMNS = {
    "tpep_pickup_datetime": ("pickup_time", "string"),
    "tpep_dropoff_datetime": ("dropoff_time", "string"),
    "PULocationID": ("pickup_zone", "int"),
    "DOLocationID": ("dropoff_zone", "int"),
    "trip_distance": ("distance_miles", "double"),
}


def trip_columns(df: DataFrame) -> DataFrame:
    """The five used columns, renamed and cast (S7, V13); the scan reads no others."""
    return df.select(*[F.col(c).cast(kind).alias(name) for c, (name, kind) in TRIP_COLUMNS.items()])


def read_trips(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    trips = trip_columns(spark.read.parquet(path))
    return trips if limit is None else trips.orderBy("pickup_time", "dropoff_time", "pickup_zone", "dropoff_zone",
                                                     "distance_miles").limit(limit)
