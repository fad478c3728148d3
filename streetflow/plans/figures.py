"""Joins, aggregations, windows and top lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from streetflow import functions as fn
from streetflow.operators import aggregates as agg
from streetflow.operators import windows as win
from streetflow.operators.blocks import row_index
from streetflow.operators.enrich import consumer_lag, on_map, partition_lag, with_images
from streetflow.operators.validate import valid_reading
from streetflow.plans import inputs
from streetflow.plans.inputs import FRAMES_SQL, OFFSETS_SQL, PREDICTIONS_SQL
from streetflow.plans.registry import big, micros, query, six
from streetflow.sources.frames import label_lines
from streetflow.sources.sensors import location_grid

GRID_SQL = """ids as (select distinct user_id from events),
numbered as (select *, row_number() over (order by user_id) - 1 as i, cast(ceil(sqrt(count(*) over ())) as bigint) as side from ids),
grid as (select cast(user_id as varchar) as sensor_id, i, 33.95 + (i // side) * (34.20 - 33.95) / greatest(side - 1, 1) as lat,
  -118.50 + (i % side) * (-118.10 - -118.50) / greatest(side - 1, 1) as lon from numbered)"""
LATEST_SQL = """latest as (
  select cast(user_id as varchar) as sensor_id, value as speed, ts from events
  qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)"""


def _metadata(spark, sf):
    ids = inputs.events(spark, sf).select("user_id").distinct().withColumn("sensor_id", F.col("user_id").cast("string"))
    return location_grid(ids, ["user_id"])


# --- joins -----------------------------------------------------------------------------------

@query("j2_latest_on_map", "with " + GRID_SQL + ", " + LATEST_SQL + """
select sensor_id, speed, round(lat, 6) as lat, round(lon, 6) as lon,
  case when speed < 20 then 'red' when speed < 40 then 'yellow' else 'green' end as band,
  round((80 - least(greatest(speed, 0), 80)) * 4 + 50, 6) as radius from latest join grid using (sensor_id)""")
def j2(spark, sf):
    latest = win.latest_per(inputs.readings(spark, sf), "sensor_id", "ts", "event_id")
    return on_map(latest, _metadata(spark, sf)).select("sensor_id", "speed", six("lat"), six("lon"), "band", six("radius"))


@query("j3_with_images", """
select event_id, event_type as sequence, user_id as frame from events e
where exists (select 1 from events f where f.event_type = e.event_type and f.user_id = e.user_id and f.value > 150)""")
def j3(spark, sf):
    e = inputs.events(spark, sf)
    labels = e.select("event_id", F.col("event_type").alias("sequence"), F.col("user_id").alias("frame"))
    files = e.filter(F.col("value") > 150).select(F.col("event_type").alias("sequence"), F.col("user_id").alias("frame"))
    return with_images(labels, files).select("event_id", "sequence", "frame")


@query("j4_except", """
select user_id, strftime(ts, '%Y-%m-%d') as day from events where event_type = 'view'
except select user_id, strftime(ts, '%Y-%m-%d') as day from events where event_type = 'click'""")
def j4(spark, sf):
    """A difference across rows: sensor days with a view and no click."""
    e = inputs.events(spark, sf).select("user_id", F.to_date("ts").cast("string").alias("day"), "event_type")
    return (e.filter(F.col("event_type") == "view").drop("event_type")
            .subtract(e.filter(F.col("event_type") == "click").drop("event_type")))


@query("j5_partition_lag", "with " + OFFSETS_SQL + """
select "group", topic, "partition", end_offset, committed, greatest(0, end_offset - committed) as lag from lags""")
def j5(spark, sf):
    return partition_lag(*inputs.offsets(spark, sf))


@query("a16_consumer_lag", "with " + OFFSETS_SQL + """
select "group", topic, cast(sum(greatest(0, end_offset - committed)) as bigint) as lag from lags group by 1, 2""")
def a16(spark, sf):
    return consumer_lag(*inputs.offsets(spark, sf))


@query("j5_group_without_commit", "with " + OFFSETS_SQL.replace("readers as (select distinct", "readers as (select distinct 'newcomer' as \"group\", topic from ends union select distinct") + """
select "group", topic, "partition", end_offset, committed, greatest(0, end_offset - committed) as lag from lags""")
def j5_new(spark, sf):
    """A group that reads every topic and never committed lags by all of it."""
    ends, committed = inputs.offsets(spark, sf)
    newcomer = ends.select(F.lit("newcomer").alias("group"), "topic")
    return partition_lag(ends, committed, committed.select("group", "topic").unionByName(newcomer).distinct())


# --- aggregations ----------------------------------------------------------------------------

_NEWEST_SQL = "n as (select value from events order by ts desc, event_id desc limit 5000)"


@query("a1_a2_network_speed", "with " + _NEWEST_SQL + """
select round(avg(value), 6) as avg_speed, round(avg(cast(value < 20 as int)) * 100, 6) as congested_pct from n""")
def a1(spark, sf):
    latest = agg.newest(inputs.readings(spark, sf), agg.NEWEST_READINGS, "ts", "event_id")
    return agg.network_speed(latest).select(six("avg_speed"), six("congested_pct"))


_COUNTS_SQL = """c as (select *, count(distinct user_id) over (
    partition by event_type order by ts range between interval 300 seconds preceding and current row) as n5 from events)"""


@query("a3_vehicles_now", "with " + _COUNTS_SQL + """,
l as (select * from c qualify row_number() over (partition by event_type order by ts desc, event_id desc) = 1)
select cast(sum(n5) as bigint) as vehicles, count(*) as active_cameras from l""")
def a3(spark, sf):
    counts = win.sliding_distinct(inputs.detections(spark, sf), "camera_id", "track_id", "ts", "event_id")
    return agg.vehicles_now(counts, order=("ts", "event_id"))


_ERROR_SQL = """
with """ + PREDICTIONS_SQL + """,
r as (select actual_speed as y, actual_speed - predicted_speed as e from p where predicted_speed is not null)
select round(sqrt(avg(e * e)), 6) as rmse, round(avg(abs(e)), 6) as mae,
  round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) as r2, count(*) as n from r"""


@query("a4_a5_a6_errors", _ERROR_SQL)
def a4(spark, sf):
    return agg.regression_errors(inputs.predictions(spark, sf)).select(six("rmse"), six("mae"), six("r2"), "n")


@query("a7_residual_histogram", "with " + PREDICTIONS_SQL + """,
r as (select actual_speed - predicted_speed as x from p where predicted_speed is not null),
b as (select min(x) as lo, max(x) as hi from r),
h as (select least(cast(floor((x - lo) / (hi - lo) * 40) as bigint) + 1, 40) as bin, count(*) as n from r, b group by 1)
select i as bin, round(lo + (i - 1) * (hi - lo) / 40, 6) + 0.0 as bin_start, coalesce(n, 0) as n
from (select unnest(range(1, 41)) as i) cross join b left join h on bin = i""")
def a7(spark, sf):
    p = inputs.predictions(spark, sf).withColumn("residual", fn.residual(F.col("actual_speed"), F.col("predicted_speed")))
    return agg.residual_histogram(p).select("bin", six("bin_start"), "n")


@query("a8_batch_counts", """
select count(*) filter (value between 0 and 150) as valid_count, count(*) filter (not value between 0 and 150) as invalid_count,
  count(*) filter (value < 20) as alerts_count from events""")
def a8(spark, sf):
    return agg.batch_counts(inputs.readings(spark, sf), valid_reading(), F.col("speed") < 20)


@query("a11_throughput", """
select epoch_us(time_bucket(interval '1 minute', ts)) as ts_us, event_type, count(*) as n, round(count(*) / 60, 6) as per_second
from events group by 1, 2""")
def a11(spark, sf):
    return agg.throughput(inputs.events(spark, sf), "event_type").select(micros("window_start"), "event_type", "n", six("per_second"))


@query("a12_top_keys", """
with r as (select epoch_us(time_bucket(interval '1 day', ts)) as ts_us, user_id, count(*) as n from events group by 1, 2)
select ts_us, user_id, n, row_number() over (partition by ts_us order by n desc, user_id) as place from r qualify place <= 10""")
def a12(spark, sf):
    rates = agg.throughput(inputs.events(spark, sf), "user_id", window="1 day")
    return agg.top_keys(rates, "user_id").select(micros("window_start"), "user_id", "n", big("place"))


@query("a13_latency_quantiles", """
select event_type, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95 from events group by 1""")
def a13(spark, sf):
    q = agg.latency_quantiles(inputs.events(spark, sf), ["event_type"], "value")
    return q.select("event_type", six("p50"), six("p95"))


@query("a13_bucket_quantiles", """
with bounds as (select * from (values (1, 0.0, 50.0), (2, 50.0, 100.0), (3, 100.0, 200.0), (4, 200.0, 500.0), (5, 500.0, 1000.0),
    (6, 1000.0, 2000.0), (7, 2000.0, 5000.0), (8, 5000.0, 10000.0)) as t(i, low, high)),
w as (select epoch_us(time_bucket(interval '1 hour', ts)) as ts_us, value * 10 as v from events),
n as (select ts_us, count(*) as total from w group by 1),
c as (select n.ts_us, total, i, cast(low as double) as low, cast(high as double) as high,
    (select count(*) from w where w.ts_us = n.ts_us and v <= high) as upto, (select count(*) from w where w.ts_us = n.ts_us and v <= low) as below
  from n cross join bounds),
q as (select ts_us, total, q, total * q as rank from n cross join (select unnest([0.5::double, 0.95::double]) as q)),
e as (select q.ts_us, q.q, coalesce(min_by(low + (high - low) * (rank - below) / (upto - below), i) filter (upto >= rank), 10000.0) as est
  from q join c on c.ts_us = q.ts_us group by 1, 2)
select ts_us, round(max(est) filter (q = 0.5), 6) as p50, round(max(est) filter (q = 0.95), 6) as p95 from e group by 1""")
def a13_buckets(spark, sf):
    """Ten times the value as microseconds, so that the buckets are used."""
    e = inputs.events(spark, sf).withColumn("us", F.col("value") * 10)
    return agg.bucket_quantiles(e, "us", window="1 hour").select(micros("window_start"), six("p50"), six("p95"))


@query("a14_latency_buckets", """
with b as (select unnest([50, 100, 200, 500, 1000, 2000, 5000, 10000]) as bound),
w as (select epoch_us(time_bucket(interval '5 minutes', ts)) as ts_us, value from events),
d as (select distinct ts_us from w),
c as (select ts_us, bound, count(*) as n from w join b on value <= bound group by 1, 2)
select d.ts_us, cast(b.bound as varchar) as le, coalesce(n, 0) as n from d cross join b left join c on c.ts_us = d.ts_us and c.bound = b.bound
union all select ts_us, '+Inf', count(*) from w group by 1""")
def a14(spark, sf):
    return agg.latency_buckets(inputs.events(spark, sf), "value").select(micros("window_start"), "le", "n")


@query("a15_active", "select count(distinct user_id) as active from events")
def a15(spark, sf):
    return agg.active_entities(inputs.events(spark, sf), "user_id")


@query("a17_map_centre", "with " + GRID_SQL + ", " + LATEST_SQL + """
select round(avg(lat), 6) as lat, round(avg(lon), 6) as lon from latest join grid using (sensor_id)""")
def a17(spark, sf):
    latest = win.latest_per(inputs.readings(spark, sf), "sensor_id", "ts", "event_id")
    return agg.map_centre(on_map(latest, _metadata(spark, sf))).select(six("lat"), six("lon"))


@query("f14_f15_a18_labels", """
with b as (select l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity,
    round(l_discount * 100) * 200 as l, round(l_tax * 100) * 90 as t, l_quantity * 10 as w, l_quantity * 7 as h from lineitem),
n as (select cast(l_orderkey as varchar) as sequence, l_linenumber as frame, l_suppkey, l_partkey, l_quantity, printf('0 %.6f %.6f %.6f %.6f',
    greatest(0.0, least(1.0, (l + w / 2) / 960)), greatest(0.0, least(1.0, (t + h / 2) / 540)),
    greatest(0.0, least(1.0, w / 960)), greatest(0.0, least(1.0, h / 540))) as line from b)
select printf('%s_img%05d.txt', sequence, frame) as name,
  string_agg(line, chr(10) order by l_suppkey, l_partkey, l_quantity, line) as label from n group by sequence, frame""")
def f14(spark, sf):
    line = inputs.table(spark, sf, "lineitem")
    boxes = line.select(
        F.col("l_orderkey").cast("string").alias("sequence"), F.col("l_linenumber").alias("frame"),
        F.struct("l_suppkey", "l_partkey", "l_quantity").alias("box"),
        (F.round(F.col("l_discount") * 100) * 200).alias("left"), (F.round(F.col("l_tax") * 100) * 90).alias("top"),
        (F.col("l_quantity") * 10).alias("width"), (F.col("l_quantity") * 7).alias("height"),
        F.lit(960).alias("frame_width"), F.lit(540).alias("frame_height"))
    files = agg.label_files(label_lines(boxes))
    return files.select(fn.frame_label(F.col("sequence"), F.col("frame"), ".txt").alias("name"), "label")


# --- windows ---------------------------------------------------------------------------------

@query("w1_latest_per", "with " + LATEST_SQL + " select sensor_id, speed, epoch_us(ts) as ts_us from latest")
def w1(spark, sf):
    return win.latest_per(inputs.readings(spark, sf), "sensor_id", "ts", "event_id").select("sensor_id", "speed", micros("ts"))


@query("w2_latest_row", "select event_id, value as speed from events order by ts desc, event_id desc limit 1")
def w2(spark, sf):
    return win.latest_row(inputs.readings(spark, sf), "ts", "event_id").select("event_id", "speed")


LAGS_SQL = """lags as (
  select event_id, ts, cast(user_id as varchar) as sensor_id, value as speed, lag(value, 1) over s as lag_5min, lag(value, 3) over s as lag_15min, lag(value, 12) over s as lag_1h,
    case when count(value) over (s rows between 6 preceding and 1 preceding) >= 2
         then avg(value) over (s rows between 6 preceding and 1 preceding) end as rolling
  from events window s as (partition by user_id order by ts, event_id))"""
FEATURES_SQL = LAGS_SQL + """,
feats as (select event_id, ts, sensor_id, speed, hour(ts) as hour, isodow(ts) as dow, cast(isodow(ts) >= 6 as bigint) as is_weekend,
  lag_5min, lag_15min, lag_1h, round(rolling, 6) as rolling_mean_30min from lags where lag_1h is not null)"""


@query("w3_w4_lags", "with " + LAGS_SQL + """
select event_id, lag_5min, lag_15min, lag_1h, round(rolling, 6) as rolling_mean_30min from lags""")
def w3(spark, sf):
    lagged = win.lag_features(inputs.readings(spark, sf), order=("ts", "event_id"))
    return lagged.select("event_id", "lag_5min", "lag_15min", "lag_1h", six("rolling_mean_30min"))


_FEATURE_SELECT = """
select event_id, hour, dow, is_weekend, lag_5min, lag_15min, lag_1h, rolling_mean_30min from feats"""


def _features(spark, sf, **how):
    rows = win.speed_features(inputs.readings(spark, sf), order=("ts", "event_id"), **how)
    return rows.select("event_id", big("hour"), big("dow"), big("is_weekend"), "lag_5min", "lag_15min", "lag_1h", six("rolling_mean_30min"))


@query("w5_features", "with " + FEATURES_SQL + _FEATURE_SELECT)
def w5(spark, sf):
    return _features(spark, sf)


@query("w5_features_cut", "with " + FEATURES_SQL + _FEATURE_SELECT)
def w5_cut(spark, sf):
    """The same features with every sensor cut into blocks, as a sensor too large for a task is."""
    return _features(spark, sf, block_rows=20)


_SLIDING_SQL = """
select event_id, count(distinct user_id) over (
  partition by event_type order by ts range between interval {} preceding and current row) as unique_count_5min from events"""


@query("w6_sliding_distinct", _SLIDING_SQL.format("6 hours"))
def w6(spark, sf):
    counted = win.sliding_distinct(inputs.detections(spark, sf), "camera_id", "track_id", "ts", "event_id", 6 * 3600.0)
    return counted.select("event_id", "unique_count_5min")


@query("w6_sliding_distinct_cut", _SLIDING_SQL.format("300 seconds"))
def w6_cut(spark, sf):
    """Five minutes, with every camera cut into blocks."""
    counted = win.sliding_distinct(inputs.detections(spark, sf), "camera_id", "track_id", "ts", "event_id", block_rows=300)
    return counted.select("event_id", "unique_count_5min")


@query("w7_running_distinct", """
with f as (select event_id, event_type, ts, row_number() over (partition by event_type, user_id order by ts, event_id) = 1 as first from events)
select event_id, cast(sum(cast(first as int)) over (partition by event_type order by ts range unbounded preceding) as bigint) as unique_count_session from f""")
def w7(spark, sf):
    counted = win.running_distinct(inputs.detections(spark, sf), "camera_id", "track_id", "ts", "event_id")
    return counted.select("event_id", "unique_count_session")


COUNTS_SQL = FRAMES_SQL + """,
pairs as (select f.camera_id, f.frame_id, s.track_id, s.ts, f.ts as now from f join s on f.camera_id = s.camera_id and s.ts <= f.ts),
recent as (select camera_id, frame_id, count(distinct track_id) as unique_count_5min from pairs where ts >= now - interval 6 hours group by 1, 2),
firsts as (select camera_id, track_id, min(ts) as ts from s group by 1, 2),
ever as (select f.camera_id, f.frame_id, count(*) as unique_count_session from f join firsts x on x.camera_id = f.camera_id and x.ts <= f.ts group by 1, 2),
counts as (select f.camera_id, f.frame_id, coalesce(unique_count_5min, 0) as unique_count_5min, coalesce(unique_count_session, 0) as unique_count_session
  from f left join recent r using (camera_id, frame_id) left join ever e using (camera_id, frame_id))"""


@query("w6_w7_frame_counts", "with " + COUNTS_SQL + " select * from counts")
def w6_w7(spark, sf):
    counted = win.frame_counts(inputs.frames(spark, sf), 6 * 3600.0)
    return counted.select("camera_id", "frame_id", "unique_count_5min", "unique_count_session")


@query("w8_first_of_groups", """
with g as (select distinct event_type from events order by 1 limit 3)
select event_id, event_type from events where event_type in (select event_type from g)
qualify row_number() over (partition by event_type order by ts, event_id) <= 50""")
def w8(spark, sf):
    return win.first_of_groups(inputs.events(spark, sf), "event_type", ["ts", "event_id"], 3, 50).select("event_id", "event_type")


@query("w9_row_index", """
select event_id, row_number() over (order by value, event_id) - 1 as row_index from events""")
def w9(spark, sf):
    e = inputs.events(spark, sf).select("event_id", "value")
    return row_index(e, ["value", "event_id"]).select("event_id", "row_index")


@query("w10_split_groups", """
with g as (select distinct cast(user_id as varchar) as sequence from events),
r as (select sequence, row_number() over (order by md5(sequence || '|42'), sequence) - 1 as place, cast(count(*) over () as double) as n from g)
select event_id, cast(user_id as varchar) as sequence,
  case when place < floor(n * 0.70) then 'train' when place < floor(n * 0.85) then 'val' else 'test' end as split
from events join r on sequence = cast(user_id as varchar)""")
def w10(spark, sf):
    e = inputs.events(spark, sf).select("event_id", F.col("user_id").cast("string").alias("sequence"))
    return win.split_groups(e, "sequence").select("event_id", "sequence", "split")


@query("w11_tail_window", "select event_id from events where ts >= (select max(ts) from events) - interval 1 day")
def w11(spark, sf):
    return win.tail_window(inputs.readings(spark, sf), "ts", 24 * 60.0).select("event_id")


@query("w12_newest_rows", """
select event_id from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 12""")
def w12(spark, sf):
    return win.newest_rows(inputs.readings(spark, sf), "sensor_id", "ts", "event_id").select("event_id")


# --- top lists -------------------------------------------------------------------------------

@query("t1_newest_predictions", "with " + PREDICTIONS_SQL + """
select sensor_id, epoch_us(ts) as ts_us, actual_speed, predicted_speed from p where predicted_speed is not null
order by ts desc, event_id desc limit 20""")
def t1(spark, sf):
    p = inputs.predictions(spark, sf).filter(F.col("predicted_speed").isNotNull())
    return agg.newest(p, 20, "ts", "event_id").select("sensor_id", micros("ts"), "actual_speed", "predicted_speed")


@query("t3_order", """
select event_id, row_number() over (partition by user_id order by ts, event_id) as place from events""")
def t3(spark, sf):
    """Order by sensor and time, seen as each reading's place within its sensor."""
    from streetflow.operators.blocks import running_sum
    r = inputs.readings(spark, sf).withColumn("one", F.lit(1).cast("bigint"))
    return running_sum(r, ["sensor_id"], ["ts", "event_id"], "one", "place").select("event_id", "place")
