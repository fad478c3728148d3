"""Panels and batch jobs from end to end."""

import pytest
from pyspark.sql import functions as F

from streetflow.plans import batch, panels
from streetflow.sources.tables import read_table


def test_panels(rows):
    readings = rows([("2022-01-01 00:00:00", "a", 10.0), ("2022-01-01T00:05:00", "a", 50.0), ("1640995200000000000", "b", 15.0)],
                    "timestamp string, sensor_id string, speed float")
    speed = panels.speed_panel(readings).first()
    assert (speed.avg_speed, round(speed.congested_pct, 3)) == (25.0, 66.667)
    places = rows([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "sensor_id string, lat double, lon double")
    shown = {r.sensor_id: (r.speed, r.band, r.color) for r in panels.congestion_map(readings, places).collect()}
    assert shown == {"a": (50.0, "green", [80, 200, 100, 200]), "b": (15.0, "red", [220, 50, 50, 200])}
    weather = rows([("x", 5.0, "", "mist", 2.0), ("y", 1.0, "Rain", None, 1.0)],
                   "city string, temp_c float, weather_main string, weather_description string, timestamp double")
    assert tuple(panels.weather_panel(weather).first()) == ("x", 5.0, "mist")
    counts = rows([("c", "1", 1.0, 5), ("c", "2", 2.0, 7), ("d", "1", 1.0, 1)],
                  "camera_id string, frame_id string, timestamp double, unique_count_5min int")
    assert tuple(panels.vehicle_panel(counts).first()) == (8, 2)
    alerts = rows([(i, "s", "1", 9.0, {"0": 1}) for i in range(30)],
                  "batch_id bigint, sensor_id string, id string, speed float, distances map<string,int>")
    feed = panels.alert_feed(alerts).collect()
    assert len(feed) == 20 and feed[0].batch_id == 29 and feed[0].text.endswith("node 0 → 1 hops")
    predictions = rows([("s", f"{i}", float(i), None if i % 2 else 1.0, "v", float(i)) for i in range(50)],
                       "sensor_id string, timestamp string, actual_speed float, predicted_speed float, model_version string, processed_at double")
    assert panels.scored(predictions).count() == 25
    assert panels.latest_predictions(predictions).first().timestamp == "48"


def test_graph_tables(spark, tmp_path):
    v = spark.range(4).select(F.col("id").cast("string").alias("id"))
    e = spark.createDataFrame([("1", "0", 1.0), ("2", "1", 1.0)], "src string, dst string, weight double")
    stats = batch.build_graph_tables(v, e, str(tmp_path), ["0"]).first()
    assert (stats.vertices, stats.edges) == (4, 2)
    assert read_table(spark, str(tmp_path), "graph_pagerank").agg(F.sum("pagerank")).first()[0] == pytest.approx(1.0, abs=1e-6)
    assert {r.id: r.distances for r in read_table(spark, str(tmp_path), "graph_shortest_paths").collect()} == {"0": {"0": 0}, "1": {"0": 1}, "2": {"0": 2}, "3": {}}


def test_metadata_table(spark, tmp_path):
    batch.build_sensor_metadata(spark, str(tmp_path), [], spark.createDataFrame([("b",), ("a",)], "sensor_id string"))
    assert [(r.sensor_id, r.sensor_index) for r in read_table(spark, str(tmp_path), "sensor_metadata").orderBy("sensor_index").collect()] == [("a", 0), ("b", 1)]


def test_training_jobs(spark, tmp_path):
    n = F.col("id")
    readings = spark.range(1500).select((n % 5).cast("string").alias("sensor_id"), F.timestamp_seconds(F.floor(n / 5) * 300).alias("ts"),
                                        (40 + 20 * F.sin(n / 200)).alias("speed"))
    batch.train(readings, str(tmp_path), 1, rounds=3)
    run = read_table(spark, str(tmp_path), "model_runs").first()
    assert run.n_train + run.n_test == 1500 - 5 * 12
    batch.train_baseline(readings, str(tmp_path))
    assert read_table(spark, str(tmp_path), "baseline_predictions").columns == ["sensor_id", "timestamp", "speed", "prediction"]
