"""Topics to tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from streetflow.functions.display import CONGESTION_MPH
from streetflow.functions.time import event_date, parse_event_time
from streetflow.operators.contracts import (
    CCTV_INFERRED, GPS, PREDICTIONS, SENSORS, WEATHER, Contract, validate,
)
from streetflow.operators.enrich import rerouting_alerts
from streetflow.operators.validate import dead_letter, decode, require, split, valid_reading
from streetflow.sinks.tables import append_once


@dataclass(frozen=True)
class Feed:
    """How a topic becomes a table."""

    table: str
    contract: Contract
    required: tuple[str, ...] = ()
    time: str | None = None
    epoch_seconds: bool = False
    trigger: str = "5 seconds"


# Tables, required columns, day columns and triggers of the plain topics.
FEEDS = {
    "gps": Feed("gps_trips", GPS, ("pickup_time", "dropoff_time"), "pickup_time"),
    "cctv": Feed("cv_vehicle_counts", CCTV_INFERRED, ("camera_id", "frame_id"), "timestamp", epoch_seconds=True),
    "weather": Feed("weather", WEATHER, trigger="30 seconds"),
    "speed_predictions": Feed("speed_predictions", PREDICTIONS, ("sensor_id", "predicted_speed"), "timestamp"),
}
SENSOR_TOPIC = "topic_sensors"

# A batch of up to this many readings is sent to the vertex table instead of the other way round.
FEW_ROWS = 100_000


def _trigger(every: str | None) -> dict:
    """A processing-time trigger, or everything available once when `every` is None."""
    return {"processingTime": every} if every else {"availableNow": True}


def feed_rows(messages: DataFrame, feed: Feed) -> DataFrame:
    """Decoded rows of a feed, as a batch or as a stream.

    Weather has no required columns; messages that are not JSON at all are kept out of it.
    """
    if not feed.required:
        messages = messages.filter(F.try_parse_json("value").isNotNull())
    rows = require(decode(messages, feed.contract.schema), *feed.required)
    if feed.time:
        rows = rows.withColumn("event_date", event_date(F.col(feed.time), feed.epoch_seconds))
    return rows


def stream_run(batch: DataFrame) -> str:
    """The id of the stream that a batch belongs to: kept by its checkpoint, another on a new one; empty outside streams."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def start_append(df: DataFrame, path: str, checkpoint: str, every: str | None = None,
                 partition_by: Sequence[str] = (), app_id: str = "streetflow") -> StreamingQuery:
    """Append a stream to a table, one replayable batch at a time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_once(batch, path, batch_id, app_id, partition_by, stream_run(batch))

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def start_feed(messages: DataFrame, kind: str, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run one of FEEDS."""
    feed = FEEDS[kind]
    return start_append(feed_rows(messages, feed), f"{root.rstrip('/')}/{feed.table}", checkpoint, every,
                        ("event_date",) if feed.time else (), f"stream-{kind}")


def sensor_rows(messages: DataFrame) -> DataFrame:
    """Decoded readings with their raw text and parsed time."""
    rows = decode(messages, SENSORS.schema, keep=("value",))
    return rows.withColumn("ts", parse_event_time(F.col("timestamp")))


def good_reading() -> Column:
    """Valid, and its time can be read."""
    return valid_reading() & F.col("ts").isNotNull()


def sensor_outputs(rows: DataFrame, paths: DataFrame | None, batch_id: int, threshold: float = CONGESTION_MPH,
                   distinct_invalid: bool = False, few: bool = False) -> dict[str, tuple[DataFrame, tuple[str, ...]]]:
    """The tables fed by one batch of `sensor_rows`, with their partition columns (K2).

    By default every bad message is kept with its text and broken rules; `distinct_invalid`
    keeps one row per distinct bad reading instead.
    """
    readings = [f.name for f in SENSORS.schema]
    good, bad = split(rows, good_reading())
    speeds = good.select(*readings, F.to_date("ts").alias("event_date"))
    if distinct_invalid:
        letters = bad.select(*readings).distinct()
    else:
        letters = validate(bad.select(*readings, "value"), SENSORS, out="dlq_errors")
    outputs = {"sensor_speeds": (speeds, ("event_date",)), "dlq_sensors": (dead_letter(letters, batch_id), ())}
    if paths is not None:
        outputs["rerouting_alerts"] = (rerouting_alerts(good, paths, threshold, batch_id, few), ())
    return outputs


def write_batch(outputs: dict[str, tuple[DataFrame, Sequence[str]]], root: str, batch_id: int) -> dict[str, int]:
    """Write the outputs of a batch and return their row counts, taken while writing."""
    counts = {}
    for name, (df, partition_by) in outputs.items():
        seen = Observation()
        append_once(df.observe(seen, F.count(F.lit(1)).alias("n")), f"{root.rstrip('/')}/{name}", batch_id,
                    f"stream-sensors-{name}", partition_by, stream_run(df))
        counts[name] = seen.get["n"]
    return counts


def batch_summary(batch: DataFrame, topic: str, batch_id: int, counts: dict[str, int], seconds: float) -> DataFrame:
    """One row about a finished batch."""
    row = (topic, batch_id, counts.get("sensor_speeds", 0), counts.get("dlq_sensors", 0),
           counts.get("rerouting_alerts", 0), seconds, time.time())
    return batch.sparkSession.createDataFrame(
        [row], "topic string, batch_id bigint, valid_count bigint, invalid_count bigint, alerts_count bigint,"
               " batch_seconds double, batch_finished_at double")


def sensor_batch(root: str, paths: DataFrame | None, threshold: float = CONGESTION_MPH,
                 distinct_invalid: bool = False) -> Callable[[DataFrame, int], None]:
    """The batch function of the sensor job: readings, dead letters, alerts and latency."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = batch.count()
            if not rows:
                return
            outputs = sensor_outputs(batch, paths, batch_id, threshold, distinct_invalid, rows <= FEW_ROWS)
            counts = write_batch(outputs, root, batch_id)
            summary = batch_summary(batch, SENSOR_TOPIC, batch_id, counts, time.time() - started)
            append_once(summary.coalesce(1), f"{root.rstrip('/')}/pipeline_latency", batch_id, "stream-sensors-latency", run=stream_run(batch))
        finally:
            batch.unpersist()

    return handle


def start_sensors(messages: DataFrame, root: str, checkpoint: str, paths: DataFrame | None = None,
                  every: str | None = None, threshold: float = CONGESTION_MPH,
                  distinct_invalid: bool = False) -> StreamingQuery:
    """Run the sensor job."""
    handle = sensor_batch(root, paths, threshold, distinct_invalid)
    return (sensor_rows(messages).writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start())
