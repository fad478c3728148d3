"""Online jobs of messages: check, state, result, check again, publish.

A job is one stream. Every message leaves it once: as a published record, or with the first reason that held
against it. A batch has three outputs, written under the batch's number so that a repeated batch replaces all of them:
keyed messages, skipped messages with their reasons, and counts of both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from streetflow.functions.media import decode_base64, object_key, object_url
from streetflow.functions.time import parse_event_time
from streetflow.operators.contracts import CCTV_INFERRED, CCTV_RAW, PREDICTIONS, SENSORS, Contract, broken, validate
from streetflow.operators.model import MODEL_VERSION, output_records
from streetflow.operators.validate import decode, is_stale, skip_reason
from streetflow.operators.windows import FEATURES, UNIQUE_WINDOW_SEC
from streetflow.sinks.tables import append_once, publish_once, to_keyed_json
from streetflow.streaming.ingest import _trigger, stream_run
from streetflow.streaming.state import stream_counts, tagged_features

# Reasons of skipped messages, tables of the jobs.
NOT_JSON, INVALID, BAD_TIME, STALE = "json_decode_error", "schema_invalid", "bad_timestamp", "stale"
NOT_DECODED, OUTPUT_INVALID = "decode_error", "output_invalid"
PROCESSED, SKIPPED = "processed", "skipped"

Step = Callable[[DataFrame], DataFrame]


def _read(messages: DataFrame, contract: Contract, facts: dict[str, Column], *rules: tuple[str, Column]) -> DataFrame:
    """Messages as columns, with the reason of those that are skipped (V1, V7, V9)."""
    rows = validate(messages.select("value"), contract, out="_errors")
    rows = decode(rows, contract.schema, keep=("value", "_errors")).withColumns(facts)
    reason = skip_reason((NOT_JSON, F.array_contains("_errors", "not_json")), (INVALID, F.size("_errors") > 0), *rules)
    return rows.withColumn("reason", reason).drop("_errors")


def checked_readings(messages: DataFrame) -> DataFrame:
    """`(sensor_id, ts, speed, timestamp, reason)` of sensor messages; timestamp is the text of a skipped one without."""
    rows = _read(messages, SENSORS, {"ts": parse_event_time(F.col("timestamp"))}, (BAD_TIME, F.col("ts").isNull()))
    text = F.when(F.col("reason").isNull(), F.col("timestamp")).otherwise(F.coalesce("timestamp", "value"))
    return rows.select("sensor_id", "ts", F.col("speed").cast("double").alias("speed"), text.alias("timestamp"), "reason")


def judged(records: DataFrame, contract: Contract, names: list[str]) -> DataFrame:
    """The records with `reason` output_invalid where they break the contract."""
    return records.withColumn("reason", F.when(broken(records.select(*names).schema, contract), F.lit(OUTPUT_INVALID)))


def scored(rows: DataFrame, score: Step, version: str = MODEL_VERSION) -> DataFrame:
    """Prediction records of tagged readings, and the reasons of those without.

    `score` adds `prediction` to rows with the seven features.
    """
    ready = score(rows.where("reason is null"))
    records = output_records(ready.drop("ts").withColumnRenamed("timestamp", "ts"), version)
    names = [f.name for f in PREDICTIONS.schema]
    skipped = rows.where("reason is not null").select("sensor_id", "timestamp", "reason")
    return judged(records, PREDICTIONS, names).unionByName(skipped, allowMissingColumns=True)


def counts(rows: DataFrame, key: str) -> DataFrame:
    """(outcome, key, n): processed messages by entity, skipped ones by reason (A10)."""
    outcome = F.when(F.col("reason").isNull(), PROCESSED).otherwise(SKIPPED)
    return rows.groupBy(outcome.alias("outcome"), F.coalesce("reason", key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def _outputs(rows: DataFrame, names: list[str], key: str, place: str, root: str, job: str, batch_id: int, where: str, topic: str | None, run: str) -> None:
    """Write what a batch gives: messages, skipped ones, counts."""
    root = root.rstrip("/")
    sent = rows.where("reason is null").select(*names)
    publish_once(to_keyed_json(sent, key), where, batch_id, topic, f"{job}-messages", run)
    skipped = rows.where("reason is not null").select(key, place, "reason", F.lit(batch_id).cast("bigint").alias("batch_id"))
    append_once(skipped, f"{root}/{job}_skipped", batch_id, f"{job}-skipped", run=run)
    totals = counts(rows, key).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    append_once(totals.coalesce(1), f"{root}/{job}_counts", batch_id, f"{job}-counts", run=run)


def _start(rows: DataFrame, finish: Step, names: list[str], key: str, place: str, root: str, job: str, checkpoint: str, where: str,
           topic: str | None, every: str | None) -> StreamingQuery:
    def handle(batch: DataFrame, batch_id: int) -> None:
        # kept before anything looks at it, so that the state is worked on once
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        done = finish(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.count():
                _outputs(done, names, key, place, root, job, batch_id, where, topic, stream_run(batch))
        finally:
            done.unpersist()
            batch.unpersist()

    return rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()


def start_scoring(messages: DataFrame, score: Step, root: str, checkpoint: str, where: str, topic: str | None = None,
                  warm: DataFrame | None = None, every: str | None = None, version: str = MODEL_VERSION) -> StreamingQuery:
    """Score sensor messages as they come (E3, R4): contract, time, features of the sensor's past, score, output contract, message by sensor.

    Messages go to `topic` at the servers `where`, or as text below the folder `where`. Tables `scoring_skipped` and `scoring_counts` below
    `root` tell what was skipped and why. `warm` primes the state of a new checkpoint.
    """
    tagged = tagged_features(checked_readings(messages), warm).select("sensor_id", "timestamp", "ts", "speed", "reason", *FEATURES)
    return _start(tagged, lambda batch: scored(batch, score, version), [f.name for f in PREDICTIONS.schema], "sensor_id", "timestamp", root, "scoring",
                  checkpoint, where, topic, every)


def checked_frames(messages: DataFrame, max_age: float, now: Column | None = None) -> DataFrame:
    """Camera messages with their image bytes, and the reason of those that are skipped; `now` is a column of epoch seconds."""
    return _read(messages, CCTV_RAW, {"image": decode_base64(F.col("frame_b64"))}, (STALE, is_stale(F.col("timestamp"), max_age, now)),
                 (NOT_DECODED, F.col("image").isNull()))


def start_cameras(messages: DataFrame, detect: Step, root: str, checkpoint: str, where: str, topic: str | None = None, every: str | None = None,
                  max_age: float = 10.0, now: Column | None = None, seconds: float = UNIQUE_WINDOW_SEC, version: str = "detector_v1",
                  parts: int | None = None) -> StreamingQuery:
    """Count the vehicles of camera frames as they come (E4, R3): contract, age, decoding, detections, counts, output contract, message by camera.

    `detect` adds `track_ids` and `inference_ms` to frames with `image` bytes; a null list is a frame it could not decode either. Outputs
    as those of `start_scoring`, in `cameras_skipped` and `cameras_counts`.
    """
    rows = checked_frames(messages, max_age, now)
    found = detect(rows.withColumn("image", F.when(F.col("reason").isNull(), F.col("image"))))
    # detections that are missing say so here, so that no frame is counted for them
    reason = F.coalesce("reason", F.when(F.col("track_ids").isNull(), F.lit(NOT_DECODED)))
    carried = F.to_json(F.struct(F.col("frame_id"), F.col("track_ids"), F.col("inference_ms"), F.col("timestamp"), reason.alias("reason")))
    skipped = reason.isNotNull()
    # skipped messages travel as frames of no camera, which are spread over the parts of a camera without a name
    frames = found.select(F.when(~skipped, F.col("camera_id")).alias("camera_id"), carried.alias("frame_id"),
                          F.timestamp_micros(F.round(F.coalesce("timestamp", F.lit(0.0)) * 1_000_000).cast("bigint")).alias("ts"),
                          F.when(~skipped, F.col("track_ids")).alias("track_ids"))
    counted = stream_counts(frames, seconds, **({} if parts is None else {"parts": parts}))
    names = [f.name for f in CCTV_INFERRED.schema if f.name != "worker_id"]

    def finish(batch: DataFrame) -> DataFrame:
        what = F.from_json("frame_id", "frame_id string, track_ids array<bigint>, inference_ms double, timestamp double, reason string")
        # a camera's frames come from one task; the rest of the work is spread again
        spread = batch.repartition("camera_id", "frame_id")
        rows = spread.select("camera_id", "unique_count_5min", "unique_count_session", what.alias("f")).select(
            "camera_id", "unique_count_5min", "unique_count_session", "f.*")
        key = object_key(F.col("camera_id"), F.col("frame_id"))
        records = rows.where("reason is null").select(
            "camera_id", "frame_id", "timestamp", "unique_count_5min", "unique_count_session", "track_ids", object_url(key).alias("frame_url"),
            "inference_ms", F.lit(version).alias("model_version"), (F.unix_micros(F.current_timestamp()) / 1e6).alias("processed_at"))
        skipped = rows.where("reason is not null").select("camera_id", "frame_id", "reason")
        return judged(records, CCTV_INFERRED, names).unionByName(skipped, allowMissingColumns=True)

    return _start(counted, finish, names, "camera_id", "frame_id", root, "cameras", checkpoint, where, topic, every)
