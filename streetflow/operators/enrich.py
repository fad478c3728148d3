"""Joins of readings, metadata and offsets.

Which side is small depends on the data, so unless a side has been counted the size check is
left to the adaptive optimizer, which broadcasts a side it has measured and otherwise
sorts and merges, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.functions.display import CONGESTION_MPH, band, radius
from streetflow.operators.validate import congested


def rerouting_alerts(readings: DataFrame, paths: DataFrame, threshold: float = CONGESTION_MPH,
                     batch_id: int | None = None, few: bool = False) -> DataFrame:
    """Congested readings with the landmark distances of their vertex.

    Readings without an index, vertices without a row and empty distance maps give no alert.
    `few` says that the readings have been counted and are few, as in a micro-batch: then they
    are broadcast, and the vertex table, of whatever size, is scanned without a shuffle.
    """
    batch = F.lit(batch_id) if "batch_id" not in readings.columns else F.col("batch_id")
    slow = (congested(readings, threshold).filter(F.col("sensor_index").isNotNull())
            .select(F.col("sensor_index").cast("string").alias("id"), "sensor_id", "speed", batch.cast("bigint").alias("batch_id")))
    known = paths.select("id", "distances").filter(F.size("distances") > 0)
    alerts = known.join(F.broadcast(slow) if few else slow, "id")
    return alerts.select("id", "sensor_id", "speed", "distances", "batch_id")


def on_map(latest: DataFrame, metadata: DataFrame) -> DataFrame:
    """Latest readings with their place, colour band and marker radius."""
    placed = latest.join(metadata.select("sensor_id", "lat", "lon"), "sensor_id")
    return placed.withColumns({"band": band(F.col("speed")), "radius": radius(F.col("speed"))})


def with_images(labels: DataFrame, files: DataFrame) -> DataFrame:
    """Keep label rows whose image file exists.

    `files` has `sequence` and `frame` columns, one row per image.
    """
    return labels.join(files.select("sequence", "frame"), ["sequence", "frame"], "left_semi")


def partition_lag(ends: DataFrame, committed: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Lag per group, topic and partition; a missing or negative commit counts as 0.

    `ends(topic, partition, end_offset)`, `committed(group, topic, partition, offset)`. `groups(group, topic)` lists who reads what, so that a
    group which never committed has its lag too; without it, groups are those with a commit.
    """
    readers = (committed if groups is None else groups).select("group", "topic").distinct()
    expected = ends.join(readers, "topic")
    joined = expected.join(committed, ["group", "topic", "partition"], "left")
    done = F.greatest(F.coalesce(F.col("offset"), F.lit(0)), F.lit(0))
    return (joined.withColumn("committed", done)
            .withColumn("lag", F.greatest(F.lit(0), F.col("end_offset") - F.col("committed")))
            .select("group", "topic", "partition", "end_offset", "committed", "lag"))


def consumer_lag(ends: DataFrame, committed: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Total lag per group and topic."""
    return partition_lag(ends, committed, groups).groupBy("group", "topic").agg(F.sum("lag").alias("lag"))
