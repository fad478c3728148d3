"""Aggregations, joins and splits on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from streetflow.operators import aggregates as agg
from streetflow.operators.enrich import consumer_lag, partition_lag, rerouting_alerts, with_images
from streetflow.operators.windows import first_of_groups, latest_per, latest_row, newest_rows, split_groups, tail_window


def test_histogram_of_equal_values(rows):
    h = agg.residual_histogram(rows([(2.0,), (2.0,), (2.0,)], "residual double")).collect()
    assert len(h) == 40 and sum(r.n for r in h) == 3
    assert [r.bin for r in h if r.n] == [21] and min(r.bin_start for r in h) == 1.5


def test_histogram_of_one_value(rows):
    assert sum(r.n for r in agg.residual_histogram(rows([(-1.0,)], "residual double")).collect()) == 1


def test_histogram_closes_the_last_bin(rows):
    h = {r.bin: r.n for r in agg.residual_histogram(rows([(float(i),) for i in range(41)], "residual double")).collect()}
    assert h[40] == 2 and all(h[b] == 1 for b in range(1, 40))


def test_errors_by_hand(rows):
    df = rows([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0), (None, 1.0), (1.0, None)], "actual_speed double, predicted_speed double")
    r = agg.regression_errors(df).first()
    assert (round(r.rmse, 6), r.mae, r.n, round(r.r2, 6)) == (round((5 / 3) ** 0.5, 6), 1.0, 3, round(1 - 5 / 8, 6))


def test_r2_of_a_constant_is_null(rows):
    assert agg.regression_errors(rows([(1.0, 2.0), (1.0, 1.0)], "actual_speed double, predicted_speed double")).first().r2 is None


@pytest.mark.parametrize("offset, lag", [(-1001, 10), (None, 10), (4, 6), (15, 0)])
def test_lag(rows, offset, lag):
    ends = rows([("t", 0, 10)], "topic string, partition int, end_offset bigint")
    done = rows([("g", "t", 0, offset)], "group string, topic string, partition int, offset bigint")
    assert consumer_lag(ends, done).first().lag == lag


def test_partition_without_commit_is_listed(rows):
    ends = rows([("t", 0, 10), ("t", 1, 7)], "topic string, partition int, end_offset bigint")
    done = rows([("g", "t", 0, 10)], "group string, topic string, partition int, offset bigint")
    assert {(r.partition, r.lag) for r in partition_lag(ends, done).collect()} == {(0, 0), (1, 7)}


def test_alerts(rows):
    readings = rows([("a", 1, 5.0), ("b", 2, 5.0), ("c", 3, 5.0), ("d", None, 5.0), ("e", 1, 20.0), ("f", 9, 1.0)],
                    "sensor_id string, sensor_index int, speed double")
    paths = rows([("1", {"0": 2}), ("2", {}), ("3", None)], "id string, distances map<string,int>")
    assert [(r.id, r.sensor_id, r.speed, r.distances, r.batch_id) for r in rerouting_alerts(readings, paths, batch_id=3).collect()] == [
        ("1", "a", 5.0, {"0": 2}, 3)]
    plan = rerouting_alerts(readings, paths, batch_id=3, few=True)
    assert [r.sensor_id for r in plan.collect()] == ["a"]


def test_labels_without_image_go(rows):
    labels = rows([("s", 1, "x"), ("s", 2, "y")], "sequence string, frame int, line string")
    files = rows([("s", 2), ("s", 2), ("t", 1)], "sequence string, frame int")
    assert [r.line for r in with_images(labels, files).collect()] == ["y"]


def test_latest(rows):
    df = rows([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("a", 2, "w")], "k string, t int, v string")
    assert {(r.k, r.v) for r in latest_per(df, "k", "t", "v").collect()} == {("a", "y"), ("b", "z")}
    assert latest_row(df, "t", "v").first().v == "y"
    assert {(r.k, r.v) for r in newest_rows(df, "k", "t", "v", rows=1).collect()} == {("a", "y"), ("b", "z")}


def test_first_of_groups(rows):
    df = rows([(c, i) for c in "dbca" for i in range(5)], "camera string, frame int")
    assert {(r.camera, r.frame) for r in first_of_groups(df, "camera", ["frame"], 2, 3).collect()} == {(c, i) for c in "ab" for i in range(3)}


def test_long_lists_per_group(spark, monkeypatch):
    from streetflow.operators import windows
    df = spark.range(90).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("t"))
    short = (first_of_groups(df, "k", ["t"], 2, 7), newest_rows(df, "k", "t", rows=7))
    monkeypatch.setattr(windows, "MAP_SIDE_ROWS", 5)
    long = (first_of_groups(df, "k", ["t"], 2, 7), newest_rows(df, "k", "t", rows=7))
    for a, b in zip(short, long):
        assert a.count() == b.count() and a.exceptAll(b.select(a.columns)).count() == 0


def test_tail_window_keeps_its_edge(spark):
    df = spark.range(100).select(F.timestamp_seconds(F.col("id") * 60).alias("ts"))
    assert tail_window(df, "ts", 30).count() == 31


@pytest.mark.parametrize("n, sizes", [(20, (14, 3, 3)), (1, (0, 0, 1)), (10, (7, 1, 2))])
def test_split_sizes(spark, n, sizes):
    df = spark.range(n * 3).select((F.col("id") % n).cast("string").alias("seq"))
    got = split_groups(df, "seq")
    counts = {r.split: r.c for r in got.groupBy("split").agg(F.countDistinct("seq").alias("c")).collect()}
    assert tuple(counts.get(s, 0) for s in ("train", "val", "test")) == sizes
    assert got.groupBy("seq").agg(F.countDistinct("split").alias("c")).filter("c > 1").count() == 0
    other = split_groups(df.repartition(5), "seq")
    assert got.exceptAll(other).count() == 0


def test_throughput_slides(rows):
    df = rows([("a", 30), ("a", 70)], "k string, s int").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r.n for r in agg.throughput(df, "k").collect()) == [1, 1]
    assert sorted(r.n for r in agg.throughput(df, "k", slide="30 seconds").collect()) == [1, 1, 2]


def test_buckets_are_cumulative(rows):
    df = rows([(40.0,), (50.0,), (60.0,), (20000.0,)], "v double").withColumn("ts", F.timestamp_seconds(F.lit(0)))
    got = {r.le: r.n for r in agg.latency_buckets(df, "v").collect()}
    assert got == {"50": 2, "100": 3, "200": 3, "500": 3, "1000": 3, "2000": 3, "5000": 3, "10000": 3, "+Inf": 4}


def test_sketched_quantiles_are_near(spark):
    df = spark.range(10001).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("v"))
    r = agg.latency_quantiles(df, ["k"], "v", exact=False).first()
    assert abs(r.p50 - 5000) <= 5 and abs(r.p95 - 9500) <= 5


def test_quantiles_over_everything(rows):
    r = agg.latency_quantiles(rows([(1.0,), (2.0,), (4.0,), (None,)], "v double"), [], "v").first()
    assert (r.p50, round(r.p95, 6)) == (2.0, 3.8)
