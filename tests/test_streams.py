"""Streams: same results as batches, replays, restarts, empty batches."""

import json
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from streetflow.operators import model
from streetflow.operators.validate import decode
from streetflow.operators.windows import frame_counts, speed_features
from streetflow.sinks.tables import publish, to_keyed_json
from streetflow.sources.streams import stream_source
from streetflow.sources.tables import load_table, read_table
from streetflow.streaming import ingest, scoring, state

PATHS = [("1", {"0": 2}), ("2", {})]


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def message(i, speed, **more):
    return json.dumps({"timestamp": "2022-01-01 00:00:00", "sensor_id": f"s{i}", "sensor_index": i, "speed": speed, "ingested_at": 1.0, **more})


@pytest.fixture
def job(spark, tmp_path):
    """Run the sensor job over everything in the inbox; returns a reader of its tables."""
    (tmp_path / "in").mkdir()
    paths = spark.createDataFrame(PATHS, "id string, distances map<string,int>")

    def run(lines=None, name="0", **how):
        if lines is not None:
            (tmp_path / "in" / f"{name}.txt").write_text("\n".join(lines) + "\n")
        source = stream_source(spark, "text", str(tmp_path / "in"))
        finish(ingest.start_sensors(source, str(tmp_path / "out"), str(tmp_path / "ckpt"), paths, **how))
        return lambda table: read_table(spark, str(tmp_path / "out"), table)

    return run


BATCH = [message(1, 10.0), message(2, 10.0), message(1, 60.0), message(1, 151.0), message(1, 151.0), "{broken", "[1]",
         message(1, 5.0, timestamp="yesterday"), message(1, 15.0, timestamp="1330560000000000000")]


def test_sensor_job(job):
    table = job(BATCH)
    assert table("sensor_speeds").count() == 4
    assert {str(r.event_date) for r in table("sensor_speeds").collect()} == {"2022-01-01", "2012-03-01"}
    letters = table("dlq_sensors").collect()
    assert sorted((r.value[:7], tuple(r.dlq_errors)) for r in letters if r.value[0] != "{") == [("[1]", ("not_object",))]
    assert len(letters) == 5 and {r.dlq_reason for r in letters} == {"failed_validation"} and {r.batch_id for r in letters} == {0}
    assert sorted((r.id, r.sensor_id, r.speed, tuple(r.distances.items())) for r in table("rerouting_alerts").collect()) == [
        ("1", "s1", 10.0, (("0", 2),)), ("1", "s1", 15.0, (("0", 2),))]
    latency = table("pipeline_latency").first()
    assert (latency.topic, latency.valid_count, latency.invalid_count, latency.alerts_count) == ("topic_sensors", 4, 5, 2)


def test_equal_bad_readings_collapse_on_request(job):
    # two readings of 151 become one, the two texts that are no objects become one, one has no time
    assert job(BATCH, distinct_invalid=True)("dlq_sensors").count() == 3


def test_restart_goes_on_where_it_stopped(job):
    job([message(1, 10.0)])
    table = job([message(1, 12.0), message(1, 200.0)], name="1")
    assert sorted(r.speed for r in table("sensor_speeds").collect()) == [10.0, 12.0]
    table = job()
    assert table("pipeline_latency").count() == 2


def test_repeated_batch_changes_nothing(spark, tmp_path):
    handle = ingest.sensor_batch(str(tmp_path), spark.createDataFrame(PATHS, "id string, distances map<string,int>"))
    batch = ingest.sensor_rows(spark.createDataFrame([(m,) for m in BATCH], "value string"))
    for _ in range(2):
        handle(batch, 3)
    assert read_table(spark, str(tmp_path), "sensor_speeds").count() == 4
    assert read_table(spark, str(tmp_path), "dlq_sensors").count() == 5
    assert read_table(spark, str(tmp_path), "pipeline_latency").count() == 1
    # The same batch, now without bad rows: its old dead letters go.
    handle(batch.filter("speed < 20 and ts is not null"), 3)
    assert read_table(spark, str(tmp_path), "dlq_sensors").count() == 0


def test_empty_batch_writes_nothing(spark, tmp_path):
    handle = ingest.sensor_batch(str(tmp_path), None)
    handle(ingest.sensor_rows(spark.createDataFrame([], "value string")), 0)
    assert list(tmp_path.iterdir()) == []


def test_without_paths_there_are_no_alerts(spark, tmp_path):
    handle = ingest.sensor_batch(str(tmp_path), None)
    handle(ingest.sensor_rows(spark.createDataFrame([(message(1, 5.0),)], "value string")), 0)
    assert not (tmp_path / "rerouting_alerts").exists()
    assert read_table(spark, str(tmp_path), "pipeline_latency").first().alerts_count == 0


FEED_MESSAGES = {
    "gps": ([{"pickup_time": "2022-01-01 10:00:00", "dropoff_time": "2022-01-01 11:00:00", "pickup_zone": 1, "dropoff_zone": 2, "distance_miles": 3.5},
             {"pickup_time": "2022-01-01 10:00:00", "pickup_zone": 1}], ["2022-01-01"]),
    "cctv": ([{"camera_id": "c", "frame_id": "f", "timestamp": 1640995200.5, "track_ids": [1]}, {"camera_id": "c"}], ["2022-01-01"]),
    "speed_predictions": ([{"sensor_id": "s", "timestamp": "2022-01-01T00:00:00", "predicted_speed": 50.0}, {"sensor_id": "s", "timestamp": "2022-01-01"}],
                          ["2022-01-01"]),
    "weather": ([{"city": "x", "timestamp": 5.0}, {"temp_c": 1.0}], [None, None]),
}


@pytest.mark.parametrize("kind", list(FEED_MESSAGES))
def test_feeds(spark, tmp_path, kind):
    messages, days = FEED_MESSAGES[kind]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(json.dumps(m) for m in messages) + "\nnot json\n")
    finish(ingest.start_feed(stream_source(spark, "text", str(tmp_path / "in")), kind, str(tmp_path), str(tmp_path / "ckpt")))
    got = read_table(spark, str(tmp_path), ingest.FEEDS[kind].table)
    assert [str(r.event_date) if "event_date" in got.columns else None for r in got.collect()] == days


def send(spark, path, df):
    publish(to_keyed_json(df), str(path))


def collect(spark, stream, tmp_path):
    finish(ingest.start_append(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")))
    return load_table(spark, str(tmp_path / "out"))


def readings(spark, sensors=3, n=40):
    return spark.range(sensors * n).select(
        (F.col("id") % sensors).cast("string").alias("sensor_id"), F.timestamp_seconds(F.floor(F.col("id") / sensors) * 300).alias("ts"),
        (F.col("id") * 37 % 90).cast("double").alias("speed"), "id")


READING = "sensor_id string, ts timestamp, speed double, id bigint"
OUT = ["sensor_id", "ts", "speed", "hour", "dow", "is_weekend", "lag_5min", "lag_15min", "lag_1h", "r"]


def shown(df):
    return df.withColumn("r", F.round("rolling_mean_30min", 6)).select(OUT)


def test_online_features_equal_window_features(spark, tmp_path):
    """Three runs with a restart between them; inside each the rows come in any order."""
    df = readings(spark)
    got = None
    for low, high in ((0, 10), (10, 11), (11, 40)):
        part = df.filter((F.col("id") >= low * 3) & (F.col("id") < high * 3)).orderBy(F.col("id").desc())
        send(spark, tmp_path / "in", part.repartition(3))
        stream = state.stream_features(decode(stream_source(spark, "text", str(tmp_path / "in")), READING), "id")
        got = collect(spark, stream, tmp_path)
    want = shown(speed_features(df, order=("ts", "id")))
    assert got.count() == want.count() == 3 * 28
    assert shown(got).exceptAll(want).count() == 0


def test_warm_start_over_several_batches(spark, tmp_path):
    df = readings(spark)
    warm = state.warm_state(df.filter("id < 60"), minutes=60)
    assert {len(r.speeds) for r in warm.collect()} == {12}
    for low, high in ((60, 63), (63, 120)):
        send(spark, tmp_path / "in", df.filter((F.col("id") >= low) & (F.col("id") < high)).coalesce(1))
    source = stream_source(spark, "text", str(tmp_path / "in"), max_per_trigger=1)
    got = collect(spark, state.stream_features(decode(source, READING), "id", warm), tmp_path)
    want = shown(speed_features(df, order=("ts", "id")).filter("id >= 60"))
    assert got.count() == 60 and shown(got).exceptAll(want).count() == 0


def test_half_an_hour_is_too_short_to_warm_up(spark):
    assert {len(r.speeds) for r in state.warm_state(readings(spark), minutes=30).collect()} == {7}


FRAME = "camera_id string, frame_id string, ts timestamp, track_ids array<bigint>"


def test_online_counts_equal_window_counts(spark, tmp_path):
    frames = spark.range(240).select(
        F.concat(F.lit("c"), F.col("id") % 2).alias("camera_id"), F.format_string("%05d", "id").alias("frame_id"),
        F.timestamp_seconds(F.floor(F.col("id") / 3) * 50).alias("ts"),
        F.when(F.col("id") % 5 == 0, F.array().cast("array<bigint>")).otherwise(F.array(F.col("id") * 7 % 23, F.col("id") % 3)).alias("track_ids"))
    got = None
    for low, high in ((0, 60), (60, 240)):
        send(spark, tmp_path / "in", frames.filter((F.col("frame_id") >= f"{low:05d}") & (F.col("frame_id") < f"{high:05d}")))
        stream = state.stream_counts(decode(stream_source(spark, "text", str(tmp_path / "in")), FRAME))
        got = collect(spark, stream, tmp_path)
    names = ["camera_id", "frame_id", "unique_count_5min", "unique_count_session"]
    want = frame_counts(frames).select(names)
    assert got.count() == want.count() == 240 and got.select(names).exceptAll(want).count() == 0


def test_streamed_scores_equal_batch_scores(spark, tmp_path):
    df = readings(spark, sensors=4, n=60)
    features = speed_features(df, order=("ts", "id"))
    fitted = model.train_speed(features, ("sensor_id", "ts"), rounds=2, depth=2)
    model.save_model(fitted, str(tmp_path / "model"))
    model.save_model(fitted, str(tmp_path / "model"))
    fitted = model.load_model(str(tmp_path / "model"))
    send(spark, tmp_path / "in", df)
    stream = state.stream_features(decode(stream_source(spark, "text", str(tmp_path / "in")), READING), "id")
    got = collect(spark, model.keep_valid(model.output_records(fitted.transform(stream))), tmp_path)
    assert sorted(got.columns) == sorted(["sensor_id", "timestamp", "actual_speed", "predicted_speed", "horizon_minutes", "model_version",
                                          "inference_us", "processed_at"])

    def pairs(records):
        return records.select("sensor_id", "timestamp", F.round("predicted_speed", 6))

    want = pairs(model.output_records(fitted.transform(features)))
    assert got.count() == 4 * 48 and pairs(got).exceptAll(want).count() == 0


def test_throughput_of_a_stream(spark, tmp_path):
    from streetflow.operators.aggregates import throughput
    send(spark, tmp_path / "in", readings(spark))
    rows = decode(stream_source(spark, "text", str(tmp_path / "in")), READING).withWatermark("ts", "10 minutes")
    got = collect(spark, throughput(rows, "sensor_id"), tmp_path)
    want = throughput(readings(spark), "sensor_id").filter(F.col("window_start") < F.timestamp_seconds(F.lit(39 * 300 - 600 - 60)))
    assert want.count() == got.select(want.columns).exceptAll(want).count() + got.select(want.columns).intersectAll(want).count() > 0


def test_kafka_source_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_source(spark, "kafka", "localhost:1", "topic_sensors", 5000)
    with pytest.raises(ValueError):
        stream_source(spark, "carrier pigeon", "x")


def test_a_missing_speed_gives_the_same_features_as_in_batch(spark, tmp_path):
    df = readings(spark).withColumn("speed", F.when(F.col("id") % 50 != 49, F.col("speed")))
    send(spark, tmp_path / "in", df)
    got = collect(spark, state.stream_features(decode(stream_source(spark, "text", str(tmp_path / "in")), READING), "id"), tmp_path)
    want = shown(speed_features(df, order=("ts", "id")))
    assert got.count() == want.count() < 3 * 28
    assert shown(got).exceptAll(want).count() == 0


def test_one_camera_with_all_the_traffic(spark, tmp_path):
    """Its vehicles are kept in many tasks; late and repeated sightings across batches included."""
    frames = spark.range(1500).select(
        F.when(F.col("id") % 3 == 0, F.lit("quiet")).otherwise("busy").alias("camera_id"), F.format_string("%05d", "id").alias("frame_id"),
        F.timestamp_seconds(F.floor(F.col("id") / 4) * 20).alias("ts"),
        F.transform(F.sequence(F.lit(0), F.col("id") % 4), lambda i: F.pmod(F.xxhash64("id", i), F.lit(400))).alias("track_ids"))
    got = None
    for low, high in ((0, 500), (500, 504), (504, 1500)):
        send(spark, tmp_path / "in", frames.filter((F.col("frame_id") >= f"{low:05d}") & (F.col("frame_id") < f"{high:05d}")).repartition(3))
        got = collect(spark, state.stream_counts(decode(stream_source(spark, "text", str(tmp_path / "in")), FRAME), parts=4), tmp_path)
    names = ["camera_id", "frame_id", "unique_count_5min", "unique_count_session"]
    want = frame_counts(frames).select(names)
    assert got.count() == 1500 and got.select(names).exceptAll(want).count() == 0


def test_a_late_sighting_leaves_no_trace(spark, tmp_path):
    def frame(name, t, ids):
        return spark.createDataFrame([("c", name, t, ids)], "camera_id string, frame_id string, t bigint, track_ids array<bigint>").withColumn(
            "ts", F.timestamp_seconds("t")).drop("t")

    got = None
    for batch in (frame("a", 1000, [1]), frame("b", 900, [1, 2]), frame("c", 1250, []), frame("d", 2000, [2])):
        send(spark, tmp_path / "in", batch)
        got = collect(spark, state.stream_counts(decode(stream_source(spark, "text", str(tmp_path / "in")), FRAME), parts=2), tmp_path)
    assert {r.frame_id: (r.unique_count_5min, r.unique_count_session) for r in got.collect()} == {"a": (1, 1), "b": (2, 2), "c": (1, 2), "d": (1, 2)}


def test_many_readings_of_one_sensor_in_a_batch(spark, tmp_path):
    df = spark.range(400_000).select(F.lit("s").alias("sensor_id"), F.timestamp_seconds(F.col("id") * 60).alias("ts"),
                                     (F.col("id") * 37 % 90).cast("double").alias("speed"), "id")
    send(spark, tmp_path / "in", df.repartition(4))
    got = collect(spark, state.stream_features(decode(stream_source(spark, "text", str(tmp_path / "in")), READING), "id"), tmp_path)
    want = shown(speed_features(df, order=("ts", "id")))
    assert got.count() == 400_000 - 12 and shown(got).exceptAll(want).count() == 0


def test_pieces_carry_the_past(monkeypatch):
    import numpy as np
    speeds = np.arange(100.0) ** 2
    whole = list(state._pieces(np.zeros(0), speeds))
    monkeypatch.setattr(state, "PIECE_ROWS", 7)
    pieces = list(state._pieces(np.zeros(0), speeds))
    assert [short for _, short, _ in pieces[:3]] == [7, 5, 0]
    for name in whole[0][2]:
        assert (np.concatenate([lags[name] for *_, lags in pieces]) == whole[0][2][name]).all()


def test_warm_start_reports_its_rows(spark):
    from pyspark.sql import Observation
    used = Observation()
    warm = state.warm_state(readings(spark), minutes=60, used=used)
    assert warm.count() == 3 and used.get == {"rows": 36, "sensors": 3}


def stamp(i):
    return f"2022-01-01 00:{i:02d}:00"


def test_scoring_job(spark, tmp_path):
    """Every message ends as one record or one skip; a second run goes on with the sensors' state."""
    bad = ["{broken", "[1]", message(1, 500.0), message(1, 50.0, timestamp="yesterday")]
    first = [message(1, float(i), timestamp=stamp(i)) for i in range(14)] + bad
    score = lambda rows: rows.withColumn("prediction", F.when(F.col("lag_5min") != 13, F.col("lag_1h")))
    (tmp_path / "in").mkdir()
    for name, lines in (("0", first), ("1", [message(1, 99.0, timestamp=stamp(14)), message(1, 98.0, timestamp=stamp(15))])):
        (tmp_path / "in" / f"{name}.txt").write_text("\n".join(lines) + "\n")
        finish(scoring.start_scoring(stream_source(spark, "text", str(tmp_path / "in")), score, str(tmp_path / "out"), str(tmp_path / "ckpt"), str(tmp_path / "topic")))
    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "topic")).collect()]
    assert sorted((m["sensor_id"], m["timestamp"], m["actual_speed"], m["predicted_speed"], m["horizon_minutes"]) for m in sent) == [
        ("s1", stamp(12), 12.0, 0.0, 0), ("s1", stamp(13), 13.0, 1.0, 0), ("s1", stamp(15), 98.0, 3.0, 0)]
    skipped = load_table(spark, str(tmp_path / "out" / "scoring_skipped"))
    assert {(r.reason, r.batch_id): r.n for r in skipped.groupBy("reason", "batch_id").agg(F.count("*").alias("n")).collect()} == {
        ("json_decode_error", 0): 1, ("schema_invalid", 0): 2, ("bad_timestamp", 0): 1, ("warming_up", 0): 12, ("output_invalid", 1): 1}
    totals = load_table(spark, str(tmp_path / "out" / "scoring_counts"))
    assert totals.agg(F.sum("n")).first()[0] == len(first) + 2
    assert {(r.key, r.n) for r in totals.where("outcome = 'processed'").collect()} == {("s1", 2), ("s1", 1)}


def test_a_repeated_batch_of_a_job_replaces_its_outputs(spark, tmp_path):
    rows = spark.createDataFrame([("s", "t", None), ("s", "u", "warming_up")], "sensor_id string, timestamp string, reason string")
    for batch in (rows, rows.where("reason is null")):
        scoring._outputs(batch, ["sensor_id", "timestamp"], "sensor_id", "timestamp", str(tmp_path), "job", 3, str(tmp_path / "topic"), None, "run")
    assert spark.read.text(str(tmp_path / "topic")).count() == 1
    assert load_table(spark, str(tmp_path / "job_skipped")).count() == 0
    assert [(r.outcome, r.key, r.n) for r in load_table(spark, str(tmp_path / "job_counts")).collect()] == [("processed", "s", 1)]


def test_camera_job(spark, tmp_path):
    import base64

    def frame(name, age=1.0, image="1,2", **more):
        return json.dumps({"camera_id": "a/b", "frame_id": name, "timestamp": 1000.0, "frame_b64": base64.b64encode(image.encode()).decode(), "ingested_at": 1000.0 + age, **more})

    lines = [frame("f0"), frame("f1", age=10.0), frame("f2", age=10.5), frame("f3", frame_b64="*"), frame("f4", image="none"), frame("f5", image="-1"), "{", frame("f6", camera_id="")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.txt").write_text("\n".join(lines) + "\n")

    def detect(frames):
        ids = F.when(F.col("image") != F.lit(b"none"), F.split(F.col("image").cast("string"), ",").cast("array<bigint>"))
        return frames.withColumn("track_ids", ids).withColumn("inference_ms", F.lit(2.5))

    finish(scoring.start_cameras(stream_source(spark, "text", str(tmp_path / "in")), detect, str(tmp_path / "out"), str(tmp_path / "ckpt"), str(tmp_path / "topic"),
                                 now=F.col("ingested_at"), parts=2))
    sent = {m["frame_id"]: m for m in (json.loads(r.value) for r in spark.read.text(str(tmp_path / "topic")).collect())}
    assert sorted(sent) == ["f0", "f1"] and sent["f0"]["unique_count_session"] == 3 and sent["f1"]["track_ids"] == [1, 2]
    assert sent["f0"]["frame_url"].endswith("/a_b/f0.jpg") and sent["f0"]["inference_ms"] == 2.5
    skipped = load_table(spark, str(tmp_path / "out" / "cameras_skipped"))
    assert sorted((r.frame_id or "", r.reason) for r in skipped.collect()) == [
        ("", "json_decode_error"), ("f2", "stale"), ("f3", "decode_error"), ("f4", "decode_error"), ("f5", "output_invalid"), ("f6", "schema_invalid")]


def test_frames_of_a_camera_are_not_held_in_memory():
    """The frames of a batch wait in a file while its changes are summed; counts, also those of a later batch, are right."""

    class Value:
        held = None

        def get(self):
            return self.held

        def update(self, row):
            self.held = row

    def chunks(low, high):
        for at in range(low, high, 2_000):
            t = np.arange(at, at + 2_000)[::-1]
            frames = pd.DataFrame({"t": t, "kind": state.FRAME, "delta": 0, "new": 0, "frame_id": [f"{x:06d}" + "x" * 500 for x in t]})
            # one vehicle at every tenth instant, there for 25
            seen = t[t % 10 == 0]
            come = pd.DataFrame({"t": seen, "kind": state.ARRIVAL, "delta": 1, "new": 1, "frame_id": None})
            leave = pd.DataFrame({"t": seen + 25, "kind": state.DEPARTURE, "delta": -1, "new": 0, "frame_id": None})
            yield pd.concat([leave, frames, come], ignore_index=True)

    step = state.CameraTotals()
    step._totals = Value()
    for low, high in ((0, 60_000), (60_000, 64_000)):
        tracemalloc.start()
        n = 0
        for rows in step.handleInputRows(("c",), chunks(low, high), None):
            t = rows["frame_id"].str[:6].astype(int).to_numpy()
            n += len(rows)
            assert (rows["unique_count_session"] == t // 10 + 1).all()
            assert (rows["unique_count_5min"] == t // 10 - np.maximum(-(-(t - 25) // 10), 0) + 1).all()
            assert (rows["ts"] == pd.to_datetime(t, unit="us")).all()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # the texts of the first batch alone are 33 MB; held in arrays they took 158 MB
        assert n == high - low and peak < 30e6


def test_sensors_share_a_call_of_the_state(spark, tmp_path, monkeypatch):
    """A part's sensors are worked on together, with the state of each, over a restart; null is a sensor of its own."""
    calls = tmp_path / "calls"
    calls.mkdir()

    class Counted(state.RecentSpeeds):
        def handleInputRows(self, key, rows, timerValues):
            (calls / str(key[0])).touch()
            yield from super().handleInputRows(key, rows, timerValues)

    monkeypatch.setattr(state, "RecentSpeeds", Counted)
    df = readings(spark, sensors=50).withColumn("sensor_id", F.when(F.col("sensor_id") != "7", F.col("sensor_id")))
    got = None
    for low, high in ((0, 9), (9, 40)):
        part = df.filter((F.col("id") >= low * 50) & (F.col("id") < high * 50)).orderBy(F.col("id").desc())
        send(spark, tmp_path / "in", part.repartition(3))
        got = collect(spark, state.stream_features(decode(stream_source(spark, "text", str(tmp_path / "in")), READING), "id", parts=4), tmp_path)
    want = shown(speed_features(df, order=("ts", "id")))
    assert got.count() == want.count() == 50 * 28 and shown(got).exceptAll(want).count() == 0
    assert len(list(calls.iterdir())) <= 4


def test_warm_start_of_many_sensors_of_a_part(spark, tmp_path):
    df = readings(spark, sensors=30)
    warm = state.warm_state(df.filter("id < 600"), minutes=120)
    send(spark, tmp_path / "in", df.filter("id >= 600 and sensor_id <> '4'"))
    got = collect(spark, state.stream_features(decode(stream_source(spark, "text", str(tmp_path / "in")), READING), "id", warm, parts=2), tmp_path)
    want = shown(speed_features(df, order=("ts", "id")).filter("id >= 600 and sensor_id <> '4'"))
    assert got.count() == 29 * 20 and shown(got).exceptAll(want).count() == 0


def test_ties_and_missing_times_keep_their_order():
    of, ts = np.array([1, 0, 1, 1, 0]), np.array(["2022", "NaT", "2022", "2021", "2022"], "datetime64[ns]")
    assert list(state._in_order(of, ts, np.array(["b", "x", "a", "c", "y"], object))) == [4, 1, 3, 2, 0]
    assert list(state._in_order(of, ts, np.array([None, "x", "a", "c", "y"], object))) == [4, 1, 3, 2, 0]


def test_vehicles_ever_seen_are_asked_for_in_pieces():
    """Two calls of the state for each piece, not for each vehicle."""

    class Pieces(dict):
        calls = 0

        def getValue(self, key):
            self.calls += 1
            return self.get(key)

        def updateValue(self, key, row):
            self.calls += 1
            self[key] = row

    step = state.VehicleChanges(10)
    step._ever = Pieces()
    rng = np.random.default_rng(5)
    seen: set[int] = set()
    for n in (20_000, 3, 0, 20_000):
        ids = np.unique(rng.integers(-30_000, 30_000, n))
        before, step._ever.calls = step._ever.calls, 0
        assert step._unseen(ids).tolist() == [i not in seen for i in ids.tolist()]
        seen.update(ids.tolist())
        assert step._ever.calls <= min(2 * state.EVER_PIECES, 2 * len(ids))


def test_frames_of_a_camera_are_spread_after_their_count(spark, tmp_path, monkeypatch):
    """What follows the counts, as the output contract, is not left to one task for each camera."""
    tasks = []

    def outputs(rows, *_):
        tasks.append(rows.groupBy(F.spark_partition_id()).count().count())

    monkeypatch.setattr(scoring, "_outputs", outputs)
    monkeypatch.setattr(scoring, "checked_frames", lambda messages, *_: messages.select(
        F.lit("c").alias("camera_id"), F.col("value").alias("frame_id"), F.lit(1.0).alias("timestamp"), F.lit(b"").alias("image"), F.lit(None).cast("string").alias("reason")))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.txt").write_text("\n".join(random.Random(i).randbytes(1500).hex() for i in range(4000)) + "\n")
    finish(scoring.start_cameras(stream_source(spark, "text", str(tmp_path / "in")), lambda f: f.withColumn("track_ids", F.array(F.lit(1).cast("bigint"))).withColumn(
        "inference_ms", F.lit(1.0)), str(tmp_path / "out"), str(tmp_path / "ckpt"), str(tmp_path / "topic"), parts=2))
    assert tasks and max(tasks) > 1
