"""Validation and column functions on hand-made rows."""

import json
import math

import pytest
from pyspark.sql import functions as F

from streetflow import functions as fn
from streetflow.operators.contracts import CCTV_INFERRED, CONTRACTS, PREDICTIONS, SENSORS, WEATHER, broken, validate
from streetflow.operators.validate import congested, dead_letter, decode, drop_missing, in_range, skip_reason, split, valid_reading
from streetflow.operators.windows import speed_features


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("speed, ok", [(-0.1, False), (0.0, True), (150.0, True), (150.1, False), (math.nan, False), (None, False)])
def test_speed_range(spark, speed, ok):
    assert one(spark, in_range(F.lit(speed).cast("double"), 0.0, 150.0)) is ok


def test_congestion_is_strict(rows):
    df = rows([(19.99,), (20.0,), (math.nan,), (None,)], "speed double")
    assert [r.speed for r in congested(df).collect()] == [19.99]


def test_bad_rows_collapse_only_on_request(rows):
    df = rows([("s", 200.0), ("s", 200.0), ("s", 10.0), (None, None), (None, None)], "sensor_id string, speed double")
    good, bad = split(df, valid_reading())
    assert (good.count(), bad.count()) == (1, 4)
    assert split(df, valid_reading(), distinct_invalid=True)[1].count() == 2


def test_malformed_texts_become_one_bad_row_when_distinct(rows):
    df = decode(rows([("{oops",), ("[1",), ('{"speed": 3',)], "value string"), SENSORS.schema)
    assert split(df, valid_reading())[1].count() == 3
    assert split(df, valid_reading(), distinct_invalid=True)[1].count() == 1


def test_dead_letter(rows):
    row = dead_letter(rows([(1,)], "a int"), 5).first()
    assert (row.dlq_reason, row.batch_id) == ("failed_validation", 5) and row.dlq_at is not None


@pytest.mark.parametrize("text, micros", [
    ("1330560000000000000", 1330560000000000), ("1704067207179575999", 1704067207179575),
    ("2022-01-01T00:05:00", 1640995500000000), ("2022-01-01 00:05:00.5", 1640995500500000), ("2022-01-01 00:05:00", 1640995500000000),
    ("2022-01-01T00:05:00+02:00", 1640988300000000), ("b'x'", None), ("yesterday", None), ("", None), ("99999999999999999999999", None), (None, None)])
def test_event_time(spark, text, micros):
    assert one(spark, F.unix_micros(fn.parse_event_time(F.lit(text).cast("string")))) == micros


def check(spark, message, contract=SENSORS):
    text = message if isinstance(message, str) else json.dumps(message)
    return validate(spark.createDataFrame([(text,)], "value string"), contract).first().errors


GOOD = {"timestamp": "2022-01-01", "sensor_id": "7", "sensor_index": 7, "speed": 61.5, "ingested_at": 1.0}


@pytest.mark.parametrize("change, errors", [
    ({}, []), ({"speed": 0}, []), ({"speed": 150}, []), ({"sensor_index": None}, []), ({"sensor_index": 1.0}, []),
    ({"zone": 1}, ["zone:not_allowed"]), ({"speed": "x"}, ["speed:type"]), ({"speed": None}, ["speed:type"]), ({"speed": True}, ["speed:type"]),
    ({"speed": 150.5}, ["speed:above_maximum"]), ({"speed": -1}, ["speed:below_minimum"]), ({"sensor_id": ""}, ["sensor_id:too_short"]),
    ({"sensor_id": "x" * 65}, ["sensor_id:too_long"]), ({"sensor_id": "x" * 64}, []), ({"sensor_index": 1.5}, ["sensor_index:type"]),
    ({"sensor_index": -1}, ["sensor_index:below_minimum"]), ({"timestamp": 5}, ["timestamp:type"]), ({"ingested_at": None}, ["ingested_at:type"]),
    ({"speed": [1], "a": 1}, ["a:not_allowed", "speed:type"])])
def test_sensor_contract(spark, change, errors):
    assert check(spark, {**GOOD, **change}) == errors


def test_contract_of_other_shapes(spark):
    assert check(spark, "{broken") == ["not_json"]
    assert check(spark, "[1,2]") == ["not_object"]
    assert check(spark, "5") == ["not_object"]
    assert check(spark, {k: v for k, v in GOOD.items() if k not in ("speed", "ingested_at")}) == ["speed:required"]


@pytest.mark.parametrize("tracks, errors", [
    ([], []), ([1, 2], []), ([1.0, 2], []), ([1, 2.5], ["track_ids:type"]), ([-1], ["track_ids:below_minimum"]), ([None], ["track_ids:type"]),
    (["1"], ["track_ids:type"]), ("1", ["track_ids:type"]), ([1, None], ["track_ids:type"])])
def test_track_ids(spark, tracks, errors):
    frame = {"camera_id": "c", "frame_id": "f", "timestamp": 1, "unique_count_5min": 0, "unique_count_session": 0, "track_ids": tracks,
             "frame_url": "u", "inference_ms": 1.5, "model_version": "v"}
    assert check(spark, frame, CCTV_INFERRED) == errors


def test_weather_contract(spark):
    ok = {"city": "x", "observed_at": "t", "timestamp": 1, "humidity": None, "wind_deg": 360}
    assert check(spark, ok, WEATHER) == []
    assert check(spark, {**ok, "wind_deg": 361, "humidity": "high"}, WEATHER) == ["humidity:type", "wind_deg:above_maximum"]


def test_filtered_messages_are_parsed_once(spark):
    """A filter on the errors is moved below the projection; it must not parse anew for every check."""
    rows = spark.createDataFrame([("{}",)], "value string").withColumn("value", F.concat("value", F.lit(" ")))
    plan = validate(rows, SENSORS).filter(F.size("errors") == 0)._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("parseJson(") <= 2 and plan.count("concat(value") <= 2


def test_contract_names():
    assert sorted(CONTRACTS) == ["cctv_inferred", "cctv_raw", "gps", "sensors", "speed_predictions", "weather"]
    assert [len(CONTRACTS[n].rules) for n in sorted(CONTRACTS)] == [11, 6, 6, 5, 8, 17]


def test_first_reason_wins(spark):
    reason = skip_reason(("a", F.lit(False)), ("b", F.lit(True)), ("c", F.lit(True)))
    assert one(spark, reason) == "b"
    assert one(spark, skip_reason(("a", F.lit(None).cast("boolean")))) is None


def test_drop_missing(rows):
    df = rows([(1.0, "a"), (math.nan, "a"), (None, "a"), (1.0, None)], "x double, y string")
    assert drop_missing(df, "x", "y").count() == 1


def test_marker(spark):
    assert one(spark, fn.speed_color(F.lit(19.9))) == [220, 50, 50, 200]
    assert one(spark, fn.speed_color(F.lit(20.0))) == [240, 200, 60, 200]
    assert one(spark, fn.band(F.lit(40.0))) == "green"
    assert [one(spark, fn.radius(F.lit(s))) for s in (-5.0, 0.0, 30.0, 99.0)] == [370.0, 370.0, 250.0, 50.0]
    assert one(spark, fn.radius(F.lit(None).cast("double"))) is None and one(spark, fn.radius(F.lit(math.nan))) is None


def test_alert_text(spark):
    distances = F.create_map(F.lit("100"), F.lit(4), F.lit("0"), F.lit(2))
    text = one(spark, fn.alert_text(F.lit("773869"), F.lit("5"), F.lit(12.25), distances))
    assert text == "Sensor 773869 (vertex 5) at 12.2 mph — reroute landmarks: node 0 → 2 hops, node 100 → 4 hops"


@pytest.mark.parametrize("camera, frame, key", [("a/b", "x/y.JPG", "a_b/x_y.JPG"), ("c", "f", "c/f.jpg"), ("c", "f.jpeg", "c/f.jpeg.jpg")])
def test_object_key(spark, camera, frame, key):
    assert one(spark, fn.object_key(F.lit(camera), F.lit(frame))) == key


@pytest.mark.parametrize("url, moved", [
    (None, ""), ("", ""), ("http://new/cctv-frames/c/1.jpg", "http://new/cctv-frames/c/1.jpg"),
    ("http://old:9/cctv-frames/c/1.jpg", "http://new/cctv-frames/c/1.jpg"), ("http://old/else/1.jpg", "http://old/else/1.jpg")])
def test_rebase(spark, url, moved):
    assert one(spark, fn.rebase_url(F.lit(url).cast("string"), "http://new/cctv-frames")) == moved


@pytest.mark.parametrize("name, short, full", [("camera_7_0001.jpg", "camera", "camera_7"), ("seq_img1.jpg", "seq", "seq"), ("plain.jpg", "camera_0", "camera_0")])
def test_camera_of(spark, name, short, full):
    assert one(spark, fn.camera_of(F.lit(name))) == short
    assert one(spark, fn.camera_of(F.lit(name), up_to_first_underscore=False)) == full


def test_base64(spark):
    assert bytes(one(spark, fn.decode_base64(F.lit("aGk=")))) == b"hi"
    assert one(spark, fn.decode_base64(F.lit("not base64!"))) is None


def test_box_outside_frame_is_clamped(spark):
    line = fn.box_line(*[F.lit(float(v)) for v in (-100, 500, 1200, 100, 960, 540)])
    assert one(spark, line) == "0 0.520833 1.000000 1.000000 0.185185"
    # 1/128 lies exactly between two six-digit values.
    assert one(spark, fn.box_line(*[F.lit(float(v)) for v in (0, 0, 15, 0, 960, 540)])).split()[1] == "0.007812"


def test_first_text(spark):
    assert one(spark, fn.first_text(F.lit(" "), F.lit("haze"))) == "haze"
    assert one(spark, fn.first_text(F.lit(None).cast("string"), F.lit(""))) == "—"


@pytest.mark.parametrize("n, left", [(1, 0), (12, 0), (13, 1)])
def test_twelve_readings_give_no_features(spark, n, left):
    df = spark.range(n).select(F.lit("s").alias("sensor_id"), F.timestamp_seconds(F.col("id") * 300).alias("ts"), F.col("id").cast("double").alias("speed"))
    out = speed_features(df).collect()
    assert len(out) == left
    if left:
        assert (out[0].lag_5min, out[0].lag_15min, out[0].lag_1h, out[0].rolling_mean_30min) == (11.0, 9.0, 0.0, 8.5)


def test_rows_break_a_contract_as_their_messages_do(spark):
    """The check on columns gives the verdict of the check on the text, for odd values of every kind of property."""
    nan, inf = float("nan"), float("inf")
    good = ("c", "f", 1.0, 1, 1, [1, 2], "u", 1.5, "v", 2.0)
    odd = [("", None, "x" * 129), ("", "x" * 257, None), (-1.0, nan, inf, None), (-1, None), (-1, None), ([], None, [-1], [None], [1, None], [1 << 40]), ("", None),
           (-inf, nan, -0.5, None), ("", None, "x" * 65), (None, -1.0, nan)]
    names = [f.name for f in CCTV_INFERRED.schema if f.name != "worker_id"]
    rows = spark.createDataFrame([good, *(good[:i] + (x,) + good[i + 1:] for i, more in enumerate(odd) for x in more)],
                                 "camera_id string, frame_id string, timestamp double, unique_count_5min bigint, unique_count_session bigint, track_ids array<bigint>,"
                                 " frame_url string, inference_ms double, model_version string, processed_at double").select(*names)
    typed = [rows, rows.drop("frame_url"), rows.drop("processed_at"), rows.withColumn("zone", F.lit(1)), rows.withColumn("unique_count_5min", F.lit(1.5)),
             rows.withColumn("unique_count_5min", F.lit(2.0)), rows.withColumn("inference_ms", F.col("inference_ms").cast("float")), rows.withColumn("inference_ms", F.lit("5")),
             rows.withColumn("timestamp", F.lit(5).cast("decimal(5,2)")), rows.withColumn("track_ids", F.col("track_ids").cast("array<string>")),
             rows.withColumn("track_ids", F.array(F.lit(1.0), F.lit(1.5))), rows.withColumn("camera_id", F.lit(7))]
    for df in typed:
        text = F.to_json(F.struct(*df.columns))
        both = validate(df, CCTV_INFERRED, text).select((F.size("errors") > 0).alias("a"), broken(df.schema, CCTV_INFERRED).alias("b"), text.alias("text")).collect()
        assert [r.text for r in both if r.a != r.b] == []
    assert rows.where(~broken(rows.schema, CCTV_INFERRED)).count() == 4
    plain = spark.createDataFrame([("s", "t", None, 1.0, None, "v"), ("s", "t", nan, 1.0, 0, "v"), ("s", "t", 1.0, None, 0, "v"), ("s", "t", 1.0, 1.0, -1, "v")],
                                  "sensor_id string, timestamp string, actual_speed double, predicted_speed double, horizon_minutes int, model_version string")
    assert [r[0] for r in plain.select(broken(plain.schema, PREDICTIONS)).collect()] == [False, True, True, True]
