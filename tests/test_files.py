"""Files in and out: sources, tables, maintenance."""

import os
import time

import pytest
from pyspark.sql import functions as F

from streetflow.operators.aggregates import label_files
from streetflow.operators.validate import decode
from streetflow.sinks import tables as sink
from streetflow.sources import frames, sensors, tables, trips


def test_missing_table(spark, tmp_path):
    assert tables.read_table(spark, str(tmp_path), "sensor_speeds", 5, "timestamp").count() == 0
    assert tables.load_static(spark, str(tmp_path / "graph_shortest_paths")) is None


def test_read_table_sorts_only_by_present_columns(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    assert [r.id for r in tables.read_table(spark, str(tmp_path), "t", 2, "id").collect()] == [9, 8]
    assert tables.read_table(spark, str(tmp_path), "t", 2, "absent").count() == 2
    with pytest.raises(ValueError):
        tables.explore(spark, str(tmp_path), "t")


def test_locations_use_header_aliases(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("id,place\n1,x\n")
    (tmp_path / "good.csv").write_text("Lat,ID,LNG\n34.1,767541,-118.2\n34.2,767542,-118.3\n")
    got = sensors.read_locations(spark, [str(tmp_path / "none.csv"), str(tmp_path / "bad.csv"), str(tmp_path / "good.csv")])
    assert [tuple(r) for r in got.orderBy("sensor_index").collect()] == [("767541", 0, 34.1, -118.2), ("767542", 1, 34.2, -118.3)]


def test_locations_without_id_column_use_the_first(spark, tmp_path):
    (tmp_path / "a.csv").write_text("station,latitude,longitude\nA,1,2\n")
    assert sensors.read_locations(spark, [str(tmp_path / "a.csv")]).first().sensor_id == "A"


@pytest.mark.parametrize("n", [1, 4, 207])
def test_grid(spark, n):
    got = sensors.sensor_metadata(spark, [], sensors.placeholder_ids(spark, n)).orderBy("sensor_index").collect()
    side = next(s for s in range(1, 99) if s * s >= n)
    for i, r in enumerate(got):
        step = max(side - 1, 1)
        assert r.sensor_id == f"synth_{i:03d}" and r.sensor_index == i
        assert r.lat == pytest.approx(33.95 + (i // side) * 0.25 / step) and r.lon == pytest.approx(-118.5 + (i % side) * 0.4 / step)


def test_metadata_falls_back_to_placeholders(spark):
    got = sensors.sensor_metadata(spark, ["/nowhere.csv"])
    assert got.count() == 207 and got.columns == ["sensor_id", "sensor_index", "lat", "lon"]


def test_matrix_drops_gaps(spark):
    wide = spark.createDataFrame([(1, 5.0, None), (2, float("nan"), 7.0)], "timestamp int, `77.1` double, b double")
    got = {tuple(r) for r in sensors.matrix_to_long(wide).collect()}
    assert got == {(1, "77.1", 0, 5.0), (2, "b", 1, 7.0)}


def test_trips_read_five_columns(spark, tmp_path):
    spark.createDataFrame([("2022-01-01 00:00:00", "2022-01-01 00:10:00", 4, 7, 2.5, 9.0)],
                          "tpep_pickup_datetime string, tpep_dropoff_datetime string, PULocationID bigint, DOLocationID bigint,"
                          " trip_distance double, fare double").write.parquet(str(tmp_path / "t"))
    got = trips.read_trips(spark, str(tmp_path / "t"), limit=5)
    assert tuple(got.first()) == ("2022-01-01 00:00:00", "2022-01-01 00:10:00", 4, 7, 2.5)
    assert "fare" not in got._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def images(tmp_path):
    for name in ["MVI_1/img00001.jpg", "MVI_1/img00002.jpg", "MVI_1/img00003.jpg", "MVI_2/img00001.jpg", "MVI_3/img00001.jpg"]:
        path = tmp_path / "images" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())
    return str(tmp_path / "images")


def test_frames_of_sequences(spark, images):
    got = frames.read_frames(spark, images, cameras=2, frames=2)
    back = {(r.camera_id, r.frame_id): bytes(r.b).decode() for r in got.withColumn("b", F.unbase64("frame_b64")).collect()}
    assert back == {("MVI_1", "img00001.jpg"): "MVI_1/img00001.jpg", ("MVI_1", "img00002.jpg"): "MVI_1/img00002.jpg",
                    ("MVI_2", "img00001.jpg"): "MVI_2/img00001.jpg"}


def test_frames_of_folders_with_special_names(spark, tmp_path):
    for folder in ("cam[1]", "cam*", "cam"):
        (tmp_path / folder).mkdir()
        for n in range(2):
            (tmp_path / folder / f"img0000{n}.jpg").write_bytes(f"{folder}{n}".encode())
    found = frames.read_frames(spark, str(tmp_path), 3, 2)
    assert found.count() == 6 and found.select("frame_b64").distinct().count() == 6


def test_frames_of_a_flat_folder(spark, tmp_path):
    for name in ["camera_2_b.jpg", "camera_1_a.jpg", "plain.jpg", "note.txt"]:
        (tmp_path / name).write_bytes(b"x")
    short = frames.read_frames(spark, str(tmp_path), 2, 1, "flat")
    assert {(r.camera_id, r.frame_id) for r in short.collect()} == {("camera", "camera_1_a.jpg"), ("camera", "camera_2_b.jpg")}
    full = frames.read_frames(spark, str(tmp_path), 5, 1, "flat", up_to_first_underscore=False)
    assert {r.camera_id for r in full.collect()} == {"camera_1", "camera_2", "camera_0"}


XML = """<?xml version="1.0"?><sequence name="MVI_1"{size}><ignored_region><box left="1" top="1" width="2" height="2"/></ignored_region>
<frame num="1"><target_list><target id="1"><box left="0" top="0" width="96" height="54"/></target>
<target id="2"><box left="900" top="0" width="120" height="54"/></target><target id="3"/></target_list></frame>
<frame num="2"><target_list></target_list></frame><frame num="3"/>
<frame num="7"><target_list><target id="1"><box left="48" top="27" width="96" height="54"/></target></target_list></frame></sequence>"""


def test_annotations(spark, tmp_path, images):
    (tmp_path / "xml").mkdir()
    (tmp_path / "xml" / "MVI_1.xml").write_text(XML.format(size=""))
    (tmp_path / "xml" / "MVI_2.xml").write_text(XML.format(size=' width="480" height="270"'))
    boxes = frames.label_lines(frames.read_annotations(spark, str(tmp_path / "xml")))
    assert boxes.count() == 6
    labels = {(r.sequence, r.frame): r.label for r in label_files(boxes).collect()}
    assert labels[("MVI_1", 1)] == "0 0.050000 0.050000 0.100000 0.100000\n0 1.000000 0.050000 0.125000 0.100000"
    assert labels[("MVI_2", 7)] == "0 0.200000 0.200000 0.200000 0.200000"
    from streetflow.operators.enrich import with_images
    kept = with_images(boxes, frames.list_images(spark, images))
    assert {(r.sequence, r.frame) for r in kept.select("sequence", "frame").collect()} == {("MVI_1", 1), ("MVI_2", 1)}


def day_rows(spark, n):
    return spark.range(n).select("id", F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("event_date"))


def live_files(path):
    return sum(n.endswith(".parquet") for d, _, names in os.walk(path) for n in names if "/_" not in d[len(path):])


def test_append_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.append_once(day_rows(spark, 9), path, 0, partition_by=("event_date",))
    for _ in range(2):
        sink.append_once(day_rows(spark, 6), path, 1, partition_by=("event_date",))
    assert tables.load_table(spark, path).count() == 15
    sink.append_once(day_rows(spark, 0), path, 1, partition_by=("event_date",))
    assert tables.load_table(spark, path).count() == 9


def test_declared_columns_fill_gaps(spark, tmp_path):
    path = str(tmp_path / "pipeline_latency")
    sink.append_once(spark.range(2).select(F.lit("t").alias("topic"), F.col("id").alias("batch_id")), path, 0)
    got = tables.read_table(spark, str(tmp_path), "pipeline_latency")
    assert got.columns[-1] == "batch_finished_at" and got.filter("valid_count is null").count() == 2


def test_days_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "gps_trips")
    sink.append_once(day_rows(spark, 9).withColumnRenamed("id", "pickup_zone"), path, 0, partition_by=("event_date",))
    got = tables.read_table(spark, str(tmp_path), "gps_trips", days=("2022-01-02", "2022-01-03"))
    assert got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_compaction_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(5):
        sink.append_once(day_rows(spark, 30).repartition(4), path, batch, partition_by=("event_date",))
    before, was = tables.load_table(spark, path).groupBy("id", "event_date").count().collect(), live_files(path)
    assert sink.compact(spark, path, partition_by=("event_date",))
    assert sorted(map(tuple, tables.load_table(spark, path).groupBy("id", "event_date").count().collect())) == sorted(map(tuple, before))
    assert live_files(path) < was
    # The newest batch may still be repeated by a restarted stream.
    sink.append_once(day_rows(spark, 30), path, 4, partition_by=("event_date",))
    assert tables.load_table(spark, path).count() == 150
    assert not sink.compact(spark, path, partition_by=("event_date",), keep_latest=2)


def test_batches_of_large_files_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(2):
        sink.append_once(day_rows(spark, 10), path, batch)
    sink.append_once(spark.range(400_000).select("id", F.lit("2022-01-01").cast("date").alias("event_date")).coalesce(1), path, 2)
    for batch in range(3, 6):
        sink.append_once(day_rows(spark, 10), path, batch)
    assert sink.compact(spark, path, target_mb=1)
    assert sorted(n for n in os.listdir(path) if n.startswith("txn=")) == ["txn=1", "txn=2", "txn=4", "txn=5"]
    assert tables.load_table(spark, path).count() == 400_050


def test_interrupted_compaction_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for batch in range(4):
        sink.append_once(day_rows(spark, 10), path, batch)

    def stop(folder, span):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sink, "_swap_in", stop)
        with pytest.raises(RuntimeError):
            sink.compact(spark, path)
    assert tables.load_table(spark, path).count() == 40
    sink.compact(spark, path)
    assert tables.load_table(spark, path).count() == 40
    assert sorted(n for n in os.listdir(path) if n.startswith("txn=")) == ["txn=2", "txn=3"]


def test_expiry(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in range(3):
        sink.append_once(day_rows(spark, 10), path, batch)
    sink.compact(spark, path)
    with pytest.raises(ValueError):
        sink.expire(spark, path, hours=1)
    assert sink.expire(spark, path) == 0
    time.sleep(0.01)
    assert sink.expire(spark, path, hours=0, force=True) == 1
    assert tables.load_table(spark, path).count() == 30


def test_maintenance_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    for name in ("weather", "gps_trips"):
        for batch in range(3):
            sink.append_once(day_rows(spark, 10), str(tmp_path / name), batch)
    real = sink.compact
    expired = []
    monkeypatch.setattr(sink, "compact", lambda s, p, **k: (_ for _ in ()).throw(OSError("no")) if p.endswith("gps_trips") else real(s, p, **k))
    monkeypatch.setattr(sink, "expire", lambda s, p, *a: expired.append(p))
    got = sink.maintain(spark, str(tmp_path), ["gps_trips", "weather", "dlq_sensors"])
    assert got == {"gps_trips": "failed", "weather": "compacted", "dlq_sensors": "absent"}
    assert expired == [str(tmp_path / "weather")]


def test_keyed_json_comes_back(spark):
    df = spark.createDataFrame([("s", 1.5, [1, 2]), (None, None, None)], "sensor_id string, speed double, ids array<int>")
    sent = sink.to_keyed_json(df, "sensor_id")
    assert [r.key for r in sent.collect()] == ["s", None]
    back = decode(sent, df.schema)
    assert back.collect() == df.collect()
    assert sink.to_keyed_json(df).first().key is None


def test_writers_and_runs_keep_their_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.append_once(day_rows(spark, 3), path, 0, "app-a")
    for _ in range(2):
        sink.append_once(day_rows(spark, 4), path, 0, "app-b")
    sink.append_once(day_rows(spark, 5), path, 0, "app-b", run="second checkpoint")
    assert tables.load_table(spark, path).count() == 12


def test_a_new_checkpoint_keeps_stored_rows(spark, tmp_path):
    from streetflow.sources.streams import stream_source
    from streetflow.streaming.ingest import start_append
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\n")
    for ckpt in ("c1", "c2", "c2"):
        start_append(stream_source(spark, "text", str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / ckpt)).awaitTermination()
    assert tables.load_table(spark, str(tmp_path / "t")).count() == 4


def test_maintain_keeps_day_tables_readable(spark, tmp_path):
    path = str(tmp_path / "sensor_speeds")
    for batch in range(4):
        sink.append_once(day_rows(spark, 6), path, batch, partition_by=("event_date",))
    assert sink.maintain(spark, str(tmp_path), ["sensor_speeds"]) == {"sensor_speeds": "compacted"}
    assert tables.load_table(spark, path).count() == 24
