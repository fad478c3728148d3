"""Sources, validation and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from streetflow import functions as fn
from streetflow.operators.contracts import SENSORS, validate
from streetflow.operators.validate import (
    congested, dead_letter, decode, drop_missing, drop_stale, first_rows, in_range, is_stale, require, skip_reason,
    split, valid_reading,
)
from streetflow.plans import inputs
from streetflow.plans.inputs import DECODED_SQL, MESSAGES_SQL, PREDICTIONS_SQL, WEATHER_SQL
from streetflow.plans.registry import big, query, six, whole
from streetflow.sinks.tables import to_keyed_json
from streetflow.sources.sensors import adjacency_to_edges, location_grid, matrix_to_long
from streetflow.sources.tables import load_static, read_table
from streetflow.sources.trips import trip_columns
from streetflow.sources.weather import flatten_weather

# --- sources ---------------------------------------------------------------------------------

@query("s2_read_table", """
select event_id, epoch_us(ts) as ts_us, value from events order by ts desc, event_id desc limit 500""")
def s2(spark, sf):
    df = read_table(inputs.prepare(spark), sf, "events.parquet", limit=500, sort_col="ts", tie="event_id")
    return df.select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "value")


@query("s3_load_static", "select p_partkey, p_brand from part")
def s3(spark, sf):
    return load_static(inputs.prepare(spark), f"{sf}/part.parquet").select("p_partkey", "p_brand")


@query("s5_matrix_to_long", """
with m as (select date_trunc('hour', ts) as t, event_type, round(avg(value), 6) as speed from events group by 1, 2)
select epoch_us(t) as ts_us, event_type as sensor_id,
  cast(list_position((select list(distinct event_type order by event_type) from events where event_type is not null), event_type) - 1 as bigint) as sensor_index, speed
from m where event_type is not null""")
def s5(spark, sf):
    """One column for each kind of event there is, in order of name."""
    e = inputs.events(spark, sf).filter(F.col("event_type").isNotNull())
    wide = (e.groupBy(F.date_trunc("hour", "ts").alias("timestamp")).pivot("event_type")
            .agg(F.round(F.avg("value"), 6)))
    return matrix_to_long(wide).select(F.unix_micros("timestamp").alias("ts_us"), "sensor_id", big("sensor_index"), "speed")


@query("s6_adjacency_edges", """
with m as (
  select c_nationkey as i, s_nationkey as j, sum(l_quantity) as w
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join supplier on l_suppkey = s_suppkey group by 1, 2)
select cast(i as varchar) as src, cast(j as varchar) as dst, w - 100.0 as weight from m where i <> j and w - 100.0 > 0""")
def s6(spark, sf):
    """One column for each nation there is; a matrix has them in order, from 0."""
    trips = trip_columns(inputs.trip_file(spark, sf))
    last = inputs.table(spark, sf, "nation").agg(F.max("n_nationkey")).first()[0]
    nations = list(range(last + 1))
    wide = trips.groupBy("pickup_zone").pivot("dropoff_zone", nations).agg(F.sum("distance_miles"))
    rows = wide.select(F.col("pickup_zone").alias("row"), F.array(*[F.col(str(n)) - 100.0 for n in nations]).alias("weights"))
    return adjacency_to_edges(rows)[1]


@query("s7_read_trips", """
select strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as pickup_time, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as dropoff_time,
  c_nationkey as pickup_zone, s_nationkey as dropoff_zone, l_quantity as distance_miles
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
join supplier on l_suppkey = s_suppkey""")
def s7(spark, sf):
    return trip_columns(inputs.trip_file(spark, sf))


@query("s10_flatten_weather", "with " + WEATHER_SQL + """
select event_id, city, country, temp_c, cast(humidity as varchar) as humidity, wind_speed_mps, wind_deg, clouds_pct,
  weather_main, weather_description, cast(weather_id as varchar) as weather_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' as observed_at,
  epoch_us(ts) / 1e6 as "timestamp" from flat""")
def s10(spark, sf):
    raw = inputs.payloads(spark, sf)
    flat = flatten_weather(raw, "Los Angeles", now=F.col("ts"), keep=("event_id",))
    return flat.select("event_id", "city", "country", "temp_c", whole("humidity"), "wind_speed_mps", big("wind_deg"),
                       big("clouds_pct"), "weather_main", "weather_description", whole("weather_id"), "observed_at",
                       "timestamp")


@query("s11_location_grid", """
with ids as (select distinct user_id from events),
n as (select *, row_number() over (order by user_id) - 1 as i, cast(ceil(sqrt(count(*) over ())) as bigint) as side from ids)
select cast(user_id as varchar) as sensor_id, i as sensor_index,
  round(33.95 + (i // side) * (34.20 - 33.95) / greatest(side - 1, 1), 6) as lat,
  round(-118.50 + (i % side) * (-118.10 - -118.50) / greatest(side - 1, 1), 6) as lon from n""")
def s11(spark, sf):
    ids = inputs.events(spark, sf).select("user_id").distinct().withColumn("sensor_id", F.col("user_id").cast("string"))
    return location_grid(ids, ["user_id"]).select("sensor_id", big("sensor_index"), six("lat"), six("lon"))


# --- projection, filters, validation ---------------------------------------------------------

@query("v1_decode", "with " + DECODED_SQL + """
select event_id, "timestamp", sensor_id, cast(sensor_index as varchar) as sensor_index, round(speed, 6) as speed, ingested_at from decoded""")
def v1(spark, sf):
    rows = decode(inputs.messages(spark, sf), SENSORS.schema, keep=("event_id",))
    return rows.select("event_id", "timestamp", "sensor_id", whole("sensor_index"), six("speed"), "ingested_at")


@query("v2_required", """
select pickup_time, dropoff_time, distance_miles from (
  select case when l_returnflag <> 'N' then cast(epoch_us(o_orderdate) as bigint) end as pickup_time,
    case when l_linestatus = 'F' then cast(epoch_us(l_shipdate) as bigint) end as dropoff_time, l_quantity as distance_miles
  from lineitem join orders on l_orderkey = o_orderkey)
where pickup_time is not null and dropoff_time is not null""")
def v2(spark, sf):
    line, orders = inputs.table(spark, sf, "lineitem"), inputs.table(spark, sf, "orders")
    trips = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_returnflag") != "N", F.unix_micros(F.col("o_orderdate").cast("timestamp"))).alias("pickup_time"),
        F.when(F.col("l_linestatus") == "F", F.unix_micros(F.col("l_shipdate").cast("timestamp"))).alias("dropoff_time"),
        F.col("l_quantity").alias("distance_miles"))
    return require(trips, "pickup_time", "dropoff_time")


@query("v3_in_range", "select event_id, value >= 0.0 and value <= 150.0 as ok from events")
def v3(spark, sf):
    return inputs.readings(spark, sf).select("event_id", in_range(F.col("speed"), 0.0, 150.0).alias("ok"))


@query("v4_split", """
select 'good' as part, count(*) as n, round(sum(value), 4) as total from events where value between 0 and 150
union all
select 'bad' as part, count(*) as n, round(sum(value), 4) as total from events where not value between 0 and 150""")
def v4(spark, sf):
    good, bad = split(inputs.readings(spark, sf), valid_reading())
    sizes = [df.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("speed"), 4).alias("total")).select(F.lit(p).alias("part"), "n", "total")
             for p, df in (("good", good), ("bad", bad))]
    return sizes[0].unionByName(sizes[1])


@query("v5_invalid_distinct", "with " + DECODED_SQL + """,
r as (select "timestamp", sensor_id, sensor_index, speed, ingested_at from decoded),
good as (select * from r where sensor_id is not null and speed between 0 and 150)
select "timestamp", sensor_id, cast(sensor_index as varchar) as sensor_index, round(speed, 6) as speed, ingested_at from (select * from r except select * from good)""")
def v5(spark, sf):
    bad = split(decode(inputs.messages(spark, sf), SENSORS.schema), valid_reading(), distinct_invalid=True)[1]
    return bad.select("timestamp", "sensor_id", whole("sensor_index"), six("speed"), "ingested_at")


@query("v6_dead_letter", """
select event_id, value as speed, 'failed_validation' as dlq_reason, cast(7 as bigint) as batch_id
from events where not value between 0 and 150""")
def v6(spark, sf):
    bad = split(inputs.readings(spark, sf), valid_reading())[1]
    return dead_letter(bad, 7).select("event_id", "speed", "dlq_reason", "batch_id")


# Every rule of the sensor contract written out, apart from the library's own rule list.
CONTRACT_SQL = MESSAGES_SQL + """,
kinds as (select event_id, ts, k, value, json_valid(value) as ok,
    case when json_valid(value) then json_type(value) end as top,
    case when json_valid(value) then cast(value as json) end as j from msg),
typed as (select *, json_type(j, '$.timestamp') as t_time, json_type(j, '$.sensor_id') as t_id,
    json_type(j, '$.sensor_index') as t_index, json_type(j, '$.speed') as t_speed, json_type(j, '$.ingested_at') as t_in,
    try_cast(j->>'$.sensor_index' as double) as index_value, try_cast(j->>'$.speed' as double) as speed_value,
    length(j->>'$.sensor_id') as id_length from kinds),
checked as (select event_id, ts, k, value, j, case
  when not ok then ['not_json'] when top <> 'OBJECT' then ['not_object']
  else list_sort(list_filter(list_concat([
    case when t_time is null then 'timestamp:required' end,
    case when t_time is not null and t_time <> 'VARCHAR' then 'timestamp:type' end,
    case when t_id is null then 'sensor_id:required' end,
    case when t_id is not null and t_id <> 'VARCHAR' then 'sensor_id:type' end,
    case when t_id = 'VARCHAR' and id_length < 1 then 'sensor_id:too_short' end,
    case when t_id = 'VARCHAR' and id_length > 64 then 'sensor_id:too_long' end,
    case when t_index not in ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL')
           or (t_index = 'DOUBLE' and index_value <> floor(index_value)) then 'sensor_index:type' end,
    case when t_index in ('UBIGINT', 'BIGINT', 'DOUBLE') and index_value < 0 then 'sensor_index:below_minimum' end,
    case when t_speed is null then 'speed:required' end,
    case when t_speed not in ('UBIGINT', 'BIGINT', 'DOUBLE') then 'speed:type' end,
    case when t_speed in ('UBIGINT', 'BIGINT', 'DOUBLE') and speed_value < 0 then 'speed:below_minimum' end,
    case when t_speed in ('UBIGINT', 'BIGINT', 'DOUBLE') and speed_value > 150 then 'speed:above_maximum' end,
    case when t_in not in ('UBIGINT', 'BIGINT', 'DOUBLE') then 'ingested_at:type' end],
    list_transform(list_filter(json_keys(j), lambda x: x not in ('timestamp', 'sensor_id', 'sensor_index', 'speed', 'ingested_at')),
      lambda x: x || ':not_allowed')), lambda x: x is not null)) end as errors from typed)"""


@query("v7_contract", "with " + CONTRACT_SQL + """
select event_id, array_to_string(errors, ',') as errors from checked""")
def v7(spark, sf):
    checked = validate(inputs.messages(spark, sf), SENSORS)
    return checked.select("event_id", F.array_join("errors", ",").alias("errors"))


@query("v8_drop_stale", """
with t as (select event_id, epoch_us(ts) / 1e6 as t, epoch_us(ts) / 1e6 + cast(props->>'$.k' as int) / 5.0 as now from events)
select event_id from t where not (now - t > 10.0)""")
def v8(spark, sf):
    e = inputs.events(spark, sf).withColumn("t", F.unix_micros("ts") / 1e6)
    return drop_stale(e, F.col("t"), now=F.col("t") + F.col("k") / 5.0).select("event_id")


def _reasons(spark, sf):
    rows = validate(inputs.messages(spark, sf), SENSORS)
    time = fn.parse_event_time(F.get_json_object("value", "$.timestamp"))
    seconds = F.unix_micros("ts") / 1e6
    reason = skip_reason(
        ("json_decode_error", F.array_contains("errors", "not_json")),
        ("schema_invalid", F.size("errors") > 0),
        ("bad_timestamp", time.isNull()),
        ("stale", is_stale(seconds, now=seconds + F.col("k") / 5.0)))
    return rows.withColumn("reason", reason)


REASON_SQL = CONTRACT_SQL + """,
reasons as (select event_id, case
  when list_contains(errors, 'not_json') then 'json_decode_error' when len(errors) > 0 then 'schema_invalid'
  when k = 13 then 'bad_timestamp'
  when (epoch_us(ts) / 1e6 + k / 5.0) - epoch_us(ts) / 1e6 > 10.0 then 'stale' end as reason from checked)"""


@query("v9_skip_reason", "with " + REASON_SQL + " select event_id, coalesce(reason, 'accepted') as reason from reasons")
def v9(spark, sf):
    return _reasons(spark, sf).select("event_id", F.coalesce("reason", F.lit("accepted")).alias("reason"))


@query("a10_counts", "with " + REASON_SQL + " select coalesce(reason, 'processed') as reason, count(*) as n from reasons group by 1")
def a10(spark, sf):
    from streetflow.operators.aggregates import count_by
    return count_by(_reasons(spark, sf).withColumn("reason", F.coalesce("reason", F.lit("processed"))), "reason")


@query("v10_drop_missing", "with " + PREDICTIONS_SQL + """
select event_id, predicted_speed from p where predicted_speed is not null and actual_speed is not null""")
def v10(spark, sf):
    return drop_missing(inputs.predictions(spark, sf), "predicted_speed", "actual_speed").select("event_id", "predicted_speed")


@query("v11_congested", "select event_id, value as speed from events where value < 20")
def v11(spark, sf):
    return congested(inputs.readings(spark, sf)).select("event_id", "speed")


@query("v12_row_cap", "select event_id, value as speed from events order by ts, event_id limit 1000")
def v12(spark, sf):
    return first_rows(inputs.readings(spark, sf), 1000, "ts", "event_id").select("event_id", "speed")


@query("v13_project", "with " + PREDICTIONS_SQL + " select actual_speed as actual, predicted_speed as predicted from p")
def v13(spark, sf):
    return inputs.predictions(spark, sf).select(F.col("actual_speed").alias("actual"), F.col("predicted_speed").alias("predicted"))


# --- column functions ------------------------------------------------------------------------

@query("f1_parse_event_time", """
with t as (select event_id, ts, cast(props->>'$.k' as int) as k from events)
select event_id, cast(case when k < 50 then epoch_us(ts) when k < 75 then epoch_us(date_trunc('second', ts)) end as varchar) as ts_us from t""")
def f1(spark, sf):
    e, k = inputs.events(spark, sf), F.col("k")
    text = (F.when(k < 25, (F.unix_micros("ts") * 1000).cast("string"))
            .when(k < 50, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
            .when(k < 75, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("b'2024'"))
    return e.select("event_id", F.unix_micros(fn.parse_event_time(text)).alias("ts_us")).select("event_id", whole("ts_us"))


@query("f2_event_date", "select event_id, strftime(ts, '%Y-%m-%d') as day_text, strftime(ts, '%Y-%m-%d') as day_seconds from events")
def f2(spark, sf):
    e = inputs.events(spark, sf)
    return e.select("event_id", fn.event_date(F.col("ts").cast("string")).cast("string").alias("day_text"),
                    fn.event_date(F.unix_micros("ts") / 1e6, epoch_seconds=True).cast("string").alias("day_seconds"))


@query("f3_to_f7_calendar", """
select event_id, hour(ts) as hour, isodow(ts) as dow, dayofweek(ts) + 1 as dow_sunday,
  cast(isodow(ts) >= 6 as bigint) as is_weekend, epoch_us(ts) // 1000000 as seconds from events""")
def f3(spark, sf):
    ts = F.col("ts")
    e = inputs.events(spark, sf).select(
        "event_id", fn.hour_of_day(ts).alias("hour"), fn.iso_weekday(ts).alias("dow"), fn.sunday_weekday(ts).alias("dow_sunday"),
        fn.is_weekend(ts).alias("is_weekend"), fn.unix_seconds(ts).alias("seconds"))
    return e.select("event_id", *[big(c) for c in ("hour", "dow", "dow_sunday", "is_weekend", "seconds")])


@query("f8_f9_marker", """
select event_id, case when value < 20 then '220,50,50,200' when value < 40 then '240,200,60,200' else '80,200,100,200' end as color,
  case when value < 20 then 'red' when value < 40 then 'yellow' else 'green' end as band,
  round((80 - least(greatest(value, 0), 80)) * 4 + 50, 6) as radius from events""")
def f8(spark, sf):
    v = F.col("value")
    e = inputs.events(spark, sf).withColumn("radius", fn.radius(v))
    return e.select("event_id", F.array_join(fn.speed_color(v).cast("array<string>"), ",").alias("color"), fn.band(v).alias("band"), six("radius"))


@query("f10_object_key", """
with n as (select url, 'cam/' || (page_id % 7) as camera, case when page_id % 2 = 0 then url else url || '.JPG' end as frame from pages),
k as (select replace(camera, '/', '_') || '/' || replace(frame, '/', '_') as key from n)
select case when lower(key) like '%.jpg' then key else key || '.jpg' end as key,
  'http://localhost:9000/cctv-frames/' || case when lower(key) like '%.jpg' then key else key || '.jpg' end as url from k""")
def f10(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    camera = F.concat(F.lit("cam/"), (F.col("page_id") % 7).cast("string"))
    frame = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat("url", F.lit(".JPG")))
    keyed = pages.select(fn.object_key(camera, frame).alias("key"))
    return keyed.withColumn("url", fn.object_url(F.col("key")))


@query("f11_rebase_url", """
with u as (select event_id, value, event_type, case when value < 10 then '' when value < 30 then 'http://localhost:9000/cctv-frames/' || event_type
  when value < 60 then 'http://old:9000/cctv-frames/' || event_type || '/cctv-frames/1.jpg' when value < 100 then 'http://other/' || event_type end as url from events)
select event_id, case when url is null or url = '' then '' when contains(url, 'http://localhost:9000/cctv-frames') then url
  when not contains(url, '/cctv-frames/') then url
  else 'http://localhost:9000/cctv-frames/' || substr(url, instr(url, '/cctv-frames/') + 13) end as url from u""")
def f11(spark, sf):
    v, kind = F.col("value"), F.col("event_type")
    url = (F.when(v < 10, "").when(v < 30, F.concat(F.lit("http://localhost:9000/cctv-frames/"), kind))
           .when(v < 60, F.concat(F.lit("http://old:9000/cctv-frames/"), kind, F.lit("/cctv-frames/1.jpg")))
           .when(v < 100, F.concat(F.lit("http://other/"), kind)))
    return inputs.events(spark, sf).select("event_id", fn.rebase_url(url).alias("url"))


@query("f12_camera_of", """
with n as (select event_id, case when value < 50 then event_type || '_7_' || user_id || '.jpg' else user_id || '.jpg' end as name from events)
select event_id, case when contains(name, '_') then split_part(name, '_', 1) else 'camera_0' end as camera,
  case when contains(name, '_') then regexp_extract(name, '^(.*)_[^_]*$', 1) else 'camera_0' end as camera_full from n""")
def f12(spark, sf):
    e = inputs.events(spark, sf)
    user = F.col("user_id").cast("string")
    name = F.when(F.col("value") < 50, F.concat("event_type", F.lit("_7_"), user, F.lit(".jpg"))).otherwise(F.concat(user, F.lit(".jpg")))
    return e.select("event_id", fn.camera_of(name).alias("camera"), fn.camera_of(name, up_to_first_underscore=False).alias("camera_full"))


@query("f13_base64", """
select doc_id, lang <> 'en' as broken, case when lang <> 'en' then null else md5(text) end as digest from documents""")
def f13(spark, sf):
    docs = inputs.table(spark, sf, "documents").withColumn("broken", F.col("lang") != "en")
    coded = F.base64(F.col("text").cast("binary"))
    sent = F.when(F.col("broken"), F.concat(F.lit("*"), coded)).otherwise(coded)
    return docs.select("doc_id", "broken", F.md5(fn.decode_base64(sent)).alias("digest"))


@query("f17_first_text", "with " + WEATHER_SQL + """
select event_id, coalesce(weather_main, weather_description, '—') as condition from flat""")
def f17(spark, sf):
    flat = flatten_weather(inputs.payloads(spark, sf), "Los Angeles", now=F.col("ts"), keep=("event_id",))
    return flat.select("event_id", fn.first_text(F.col("weather_main"), F.col("weather_description")).alias("condition"))


@query("f18_residual", "with " + PREDICTIONS_SQL + """
select event_id, round(actual_speed - predicted_speed, 6) + 0.0 as residual from p""")
def f18(spark, sf):
    p = inputs.predictions(spark, sf).withColumn("residual", fn.residual(F.col("actual_speed"), F.col("predicted_speed")))
    return p.select("event_id", six("residual"))


@query("k6_keyed_json", """
select cast(user_id as varchar) as key, cast(user_id as varchar) as sensor_id, user_id as sensor_index,
  value as speed, epoch_us(ts) as ts_us from events""")
def k6(spark, sf):
    sent = to_keyed_json(inputs.readings(spark, sf).drop("event_id").withColumn("ts_us", F.unix_micros("ts")).drop("ts"), "sensor_id")
    back = decode(sent, "sensor_id string, sensor_index bigint, speed double, ts_us bigint", keep=("key",))
    return back
