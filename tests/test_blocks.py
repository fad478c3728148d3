"""Cut groups give the same results as whole ones."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from streetflow.operators import blocks
from streetflow.operators.aggregates import latency_quantiles
from streetflow.operators.windows import lag_features, running_distinct, sliding_distinct


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key, many share one time, and some keys are null."""
    rnd = random.Random(3)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else rnd.choice([None, "a", "b", "c", "d"])
        data.append((i, key, rnd.randrange(0, 400), rnd.randrange(0, 25), float(rnd.randrange(0, 60))))
    return spark.createDataFrame(data, "n int, key string, second int, item int, speed double").withColumn(
        "ts", F.timestamp_seconds("second")).cache()


def same(a, b):
    columns = sorted(a.columns)
    a, b = a.select(columns), b.select(columns)
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("size", [1, 7, 100])
def test_running_sum(skewed, size):
    window = Window.partitionBy("key").orderBy("second", "n").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumn("total", F.sum("item").over(window))
    got = blocks.running_sum(skewed, ["key"], ["second", "n"], "item", "total", block_rows=size, derived=size == 7)
    assert same(want, got)


@pytest.mark.parametrize("size", [1, 5, 40])
def test_rows_before_and_after(skewed, size):
    def columns(w):
        return {"back": F.lag("n", 12).over(w), "next": F.lead("n", 3).over(w),
                "mean": F.round(F.avg("speed").over(w.rowsBetween(-6, -1)), 6)}

    want = skewed.withColumns(columns(Window.partitionBy("key").orderBy("second", "n")))
    got = blocks.row_window(skewed, ["key"], ["second", "n"], columns, before=12, after=3, block_rows=size)
    assert same(want, got)


def test_lag_features_cut(skewed):
    whole = lag_features(skewed, "key", ("ts", "n"))
    assert same(whole, lag_features(skewed, "key", ("ts", "n"), block_rows=10))


def test_row_index(skewed):
    got = blocks.row_index(skewed, ["speed", "n"], block_rows=50)
    want = skewed.withColumn("row_index", F.row_number().over(Window.orderBy("speed", "n")).cast("bigint") - 1)
    assert same(want, got)


@pytest.mark.parametrize("size", [blocks.BLOCK_ROWS, 60])
def test_sliding_distinct_against_brute_force(skewed, size):
    known = skewed.filter("key is not null")
    window = Window.partitionBy("key").orderBy("second").rangeBetween(-10, 0)
    want = known.withColumn("c", F.size(F.collect_set("item").over(window)).cast("bigint"))
    got = sliding_distinct(known, "key", "item", "ts", "n", 10.0, "c", block_rows=size)
    assert same(want, got)


@pytest.mark.parametrize("size", [blocks.BLOCK_ROWS, 60])
def test_running_distinct_against_brute_force(skewed, size):
    known = skewed.filter("key is not null")
    window = Window.partitionBy("key").orderBy("second").rangeBetween(Window.unboundedPreceding, 0)
    want = known.withColumn("c", F.size(F.collect_set("item").over(window)).cast("bigint"))
    assert same(want, running_distinct(known, "key", "item", "ts", "n", "c", block_rows=size))


@pytest.mark.parametrize("size", [blocks.BLOCK_ROWS, 3])
def test_exact_quantiles(skewed, size):
    known = skewed.filter("key is not null")
    want = known.groupBy("key").agg(*[F.round(F.percentile("speed", q), 6).alias(n) for q, n in ((0.5, "p50"), (0.95, "p95"), (0.999, "p99_9"))])
    got = latency_quantiles(known, ["key"], "speed", (0.5, 0.95, 0.999), block_rows=size)
    assert same(want, got.select("key", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "p99_9")]))


def test_blocks_hold_about_their_size(skewed):
    cut = blocks.into_blocks(skewed, ["key"], ["second", "n"], block_rows=100)
    assert cut.split
    largest = cut.rows.groupBy("key", "_block").count().agg(F.max("count")).first()[0]
    assert largest <= 250


def test_same_vehicle_at_window_edges(spark, rows):
    df = rows([(1, "c", "v", 0.0), (2, "c", "v", 300.0), (3, "c", "w", 600.0), (4, "c", "w", 600.001), (5, "c", "x", 900.001)],
              "n int, key string, item string, s double").withColumn("ts", F.timestamp_micros((F.col("s") * 1000000).cast("bigint")))
    got = {r.n: r.c for r in sliding_distinct(df, "key", "item", "ts", "n", 300.0, "c").collect()}
    # v is still counted exactly 300 s after its last sighting, and w at 900.001 is as well.
    assert got == {1: 1, 2: 1, 3: 2, 4: 1, 5: 2}


def test_no_row_carries_all_points(skewed):
    """Rows look their block up in two arrays of about the root of a group's points each."""
    counts = skewed.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    ends, chunks = blocks._split_points(skewed, ["key"], ["second", "n"], 1, counts)
    points = {r.key: r.n for r in chunks.groupBy("key").agg(F.sum(F.size("_chunk")).alias("n")).collect()}
    assert points["hot"] > 900
    assert all(r.n ** 2 <= points[r.key] + 2 * points[r.key] ** 0.5 + 1 for r in ends.select("key", F.size("_ends").alias("n")).collect())
    assert all((r.n - 1) ** 2 < points[r.key] for r in chunks.select("key", F.size("_chunk").alias("n")).collect())
    looked = skewed.sparkSession.range(1).select(*[blocks._smaller(F.array(*map(F.lit, range(n))), F.lit(x)) for n in (1, 2, 7, 300) for x in (-1, 0, 1, 6, 500)])
    assert list(looked.first()) == [max(0, min(n, x)) for n in (1, 2, 7, 300) for x in (-1, 0, 1, 6, 500)]


def test_groups_are_first_counted_in_lots(rows, monkeypatch):
    """Many small groups are not counted one by one; a full lot without a large group is not cut."""
    small = rows([(k % 10 if k % 10 else None, k) for k in range(50)], "key int, n int")
    assert blocks.largest_lot(small, ["key"]) == (50, 5) and blocks.largest_lot(small.limit(0), ["key"]) == (None, None)
    monkeypatch.setattr(blocks, "LOTS", 3)
    total, most = blocks.largest_lot(small, ["key"])
    assert total == 50 and most > 16
    for size, split in ((8, False), (2, True)):
        cut = blocks.into_blocks(small, ["key"], ["n"], block_rows=size, derived=size == 2)
        assert cut.split == split and cut.rows.count() == 50
