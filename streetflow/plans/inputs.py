"""The given tables seen as readings, messages, detections, trips, roads and offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streetflow.operators.blocks import row_window
from streetflow.session import prepare, scratch, stage
from streetflow.sinks.tables import to_keyed_json
from streetflow.sources.weather import flatten_weather

# Messages are spoiled by the number in `props`, so that every kind of defect occurs.
CUT_OFF, EXTRA, NO_SPEED, TEXT_SPEED, EMPTY_ID, NULL_INDEX, NEGATIVE_INDEX, NUMBER_TIME = range(1, 9)
LONG_ID, NANOS, LIST, FRACTION_INDEX, NO_TIME, WHOLE_AS_FRACTION = range(9, 15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a UTC timestamp instead of a zone-less one, and the number in `props`."""
    return (table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
            .withColumn("k", F.get_json_object("props", "$.k").cast("int")))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        "event_id", F.col("user_id").cast("string").alias("sensor_id"),
        F.col("user_id").cast("int").alias("sensor_index"), F.col("value").alias("speed"), "ts")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(event_id, ts, k, value)`: sensor messages as JSON text, some of them broken."""
    e, k = events(spark, sf_dir), F.col("k")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    time = (F.when(k == NANOS, F.concat(F.lit('"'), (F.unix_micros("ts") * 1000).cast("string"), F.lit('"')))
            .when(k == NUMBER_TIME, F.unix_micros("ts").cast("string"))
            .when(k == NO_TIME, '"yesterday"').otherwise(F.concat(F.lit('"'), text, F.lit('"'))))
    sensor = F.when(k == EMPTY_ID, "").when(k == LONG_ID, "x" * 65).otherwise(F.col("user_id").cast("string"))
    user = F.col("user_id").cast("string")
    index = (F.when(k == NULL_INDEX, "null").when(k == NEGATIVE_INDEX, "-1")
             .when(k == FRACTION_INDEX, F.concat(user, F.lit(".5")))
             .when(k == WHOLE_AS_FRACTION, F.concat(user, F.lit(".0"))).otherwise(user))
    speed = (F.when(k == NO_SPEED, "")
             .when(k == TEXT_SPEED, ',"speed":"fast"').otherwise(F.concat(F.lit(',"speed":'), F.col("value").cast("string"))))
    extra = F.when(k == EXTRA, ',"zone":1').otherwise("")
    seconds = F.floor(F.unix_micros("ts") / 1000000).cast("string")
    body = F.concat(F.lit('{"timestamp":'), time, F.lit(',"sensor_id":"'), sensor, F.lit('","sensor_index":'), index,
                    speed, extra, F.lit(',"ingested_at":'), seconds, F.lit("}"))
    value = F.when(k == CUT_OFF, F.substring(body, 1, 30)).when(k == LIST, "[1,2]").otherwise(body)
    return e.select("event_id", "ts", "k", value.alias("value"))


MESSAGES_SQL = """e as (
  select *, cast(props->>'$.k' as int) as k, cast(user_id as varchar) as u from events),
body as (
  select event_id, ts, k, concat('{"timestamp":',
    case when k = 10 then concat('"', epoch_us(ts) * 1000, '"') when k = 8 then cast(epoch_us(ts) as varchar)
         when k = 13 then '"yesterday"' else concat('"', strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '"') end,
    ',"sensor_id":"', case when k = 5 then '' when k = 9 then repeat('x', 65) else u end, '","sensor_index":',
    case when k = 6 then 'null' when k = 7 then '-1' when k = 12 then u || '.5' when k = 14 then u || '.0' else u end,
    case when k = 3 then '' when k = 4 then ',"speed":"fast"' else concat(',"speed":', cast(value as varchar)) end,
    case when k = 2 then ',"zone":1' else '' end,
    ',"ingested_at":', epoch_us(ts) // 1000000, '}') as b from e),
msg as (
  select event_id, ts, k, case when k = 1 then substr(b, 1, 30) when k = 11 then '[1,2]' else b end as value from body)"""

# A message decoded by the fixed schema: null where it is not an object or the type is wrong.
DECODED_SQL = MESSAGES_SQL + """,
obj as (select event_id, ts, k, value,
  case when json_valid(value) then case when json_type(value) = 'OBJECT' then cast(value as json) end end as j from msg),
decoded as (
  select event_id, ts, k, value,
    j->>'$.timestamp' as "timestamp", j->>'$.sensor_id' as sensor_id,
    case when json_type(j, '$.sensor_index') in ('UBIGINT', 'BIGINT') then cast(j->>'$.sensor_index' as bigint) end as sensor_index,
    case when json_type(j, '$.speed') in ('UBIGINT', 'BIGINT', 'DOUBLE') then cast(cast(j->>'$.speed' as float) as double) end as speed,
    cast(j->>'$.ingested_at' as double) as ingested_at
  from obj)"""


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sighting per event: camera = event type, vehicle = user."""
    return events(spark, sf_dir).select("event_id", F.col("event_type").alias("camera_id"),
                                        F.col("user_id").alias("track_id"), "ts", "value", "k")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections as frames with a list of vehicles; some frames show two, some none."""
    d = detections(spark, sf_dir)
    tracks = (F.when(F.col("k") < 10, F.array().cast("array<bigint>"))
              .when(F.col("k") < 30, F.array("track_id", F.col("k").cast("bigint")))
              .otherwise(F.array("track_id")))
    return d.select("camera_id", F.col("event_id").cast("string").alias("frame_id"), "ts", tracks.alias("track_ids"))


FRAMES_SQL = """f as (
  select event_type as camera_id, cast(event_id as varchar) as frame_id, ts,
    case when cast(props->>'$.k' as int) < 10 then [] when cast(props->>'$.k' as int) < 30
         then [user_id, cast(props->>'$.k' as bigint)] else [user_id] end as track_ids from events),
s as (select camera_id, ts, unnest(track_ids) as track_id from f)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual speed = value, predicted speed = the user's value before; none for the first."""
    past = row_window(readings(spark, sf_dir), ["sensor_id"], ["ts", "event_id"],
                      lambda w: {"predicted_speed": F.lag("speed").over(w)}, before=1)
    return past.withColumnRenamed("speed", "actual_speed")


PREDICTIONS_SQL = """p as (
  select event_id, ts, cast(user_id as varchar) as sensor_id, value as actual_speed,
    lag(value) over (partition by user_id order by ts, event_id) as predicted_speed from events)"""


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather payloads made from events; parts are missing depending on the number in `props`."""
    e, k = events(spark, sf_dir), F.col("k")
    number = F.col("value").cast("string")
    name = F.when(k < 80, F.concat(F.lit('"name":"'), F.col("event_type"), F.lit('",'))).otherwise("")
    main = F.when(k < 90, F.concat(F.lit('"main":{"temp":'), number, F.lit(',"humidity":'), k.cast("string"), F.lit("},"))).otherwise("")
    sky = (F.when(k < 50, F.concat(F.lit('"weather":[{"main":"Rain","description":"light","id":'), k.cast("string"),
                                   F.lit('},{"main":"Mist","id":1}],')))
           .when(k < 70, '"weather":[{"description":"haze","id":7}],').when(k < 75, '"weather":[],').otherwise(""))
    wind = F.concat(F.lit('"wind":{"speed":'), number, F.lit(',"deg":'), (k * 3).cast("string"), F.lit("},"))
    text = F.concat(F.lit("{"), name, main, sky, wind, F.lit('"clouds":{"all":'), k.cast("string"), F.lit('},"sys":{"country":"US"}}'))
    return e.select("event_id", "ts", text.alias("value"))


WEATHER_SQL = """w as (
  select event_id, ts, event_type, value, cast(props->>'$.k' as int) as k from events),
flat as (
  select event_id, ts, case when k < 80 then event_type else 'Los Angeles' end as city, 'US' as country,
    case when k < 90 then value end as temp_c, cast(case when k < 90 then k end as bigint) as humidity,
    value as wind_speed_mps, cast(k * 3 as bigint) as wind_deg, cast(k as bigint) as clouds_pct,
    case when k < 50 then 'Rain' end as weather_main,
    case when k < 50 then 'light' when k < 70 then 'haze' end as weather_description,
    cast(case when k < 50 then k when k < 70 then 7 end as bigint) as weather_id from w)"""


def trip_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines laid out like a trip file, with columns that are not wanted."""
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    return (line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(F.col("o_orderdate").alias("tpep_pickup_datetime"), F.col("l_shipdate").alias("tpep_dropoff_datetime"),
                    F.col("c_nationkey").alias("PULocationID"), F.col("s_nationkey").alias("DOLocationID"),
                    F.col("l_quantity").alias("trip_distance"), F.col("l_tax").alias("fare_amount"),
                    F.col("l_returnflag").alias("store_and_fwd_flag")))


def ride_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip messages: a ride lasts until the user's next event; the last one has no end yet."""
    rides = row_window(events(spark, sf_dir), ["user_id"], ["ts", "event_id"],
                       lambda w: {"until": F.lead("ts").over(w)}, after=1)
    text = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return rides.select("ts", F.to_json(F.struct(
        F.date_format("ts", text).alias("pickup_time"), F.date_format("until", text).alias("dropoff_time"),
        F.col("user_id").alias("pickup_zone"), F.col("k").alias("dropoff_zone"),
        F.col("value").alias("distance_miles"))).alias("value"))


RIDES_SQL = """rides as (select strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as pickup_time,
  strftime(lead(ts) over (partition by user_id order by ts, event_id), '%Y-%m-%d %H:%M:%S.%f') as dropoff_time,
  user_id as pickup_zone, cast(props->>'$.k' as bigint) as dropoff_zone, cast(cast(value as float) as double) as distance_miles,
  strftime(ts, '%Y-%m-%d') as event_date from events)"""


def prediction_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction messages; a sensor's first one lacks the predicted value."""
    return predictions(spark, sf_dir).select("ts", F.to_json(F.struct(
        "sensor_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "actual_speed",
        "predicted_speed", F.lit(0).alias("horizon_minutes"), F.lit("v1").alias("model_version"))).alias("value"))


def camera_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inferred frames; a tenth lacks the camera."""
    d = detections(spark, sf_dir)
    return d.select("ts", F.to_json(F.struct(
        F.when(F.col("k") >= 10, F.col("camera_id")).alias("camera_id"), F.col("event_id").cast("string").alias("frame_id"),
        (F.unix_micros("ts") / 1e6).alias("timestamp"), F.col("k").alias("unique_count_5min"),
        F.array("track_id").alias("track_ids"), F.col("value").alias("inference_ms"))).alias("value"))


def raw_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw camera frames as JSON text; the image holds the ids of the vehicles. Some are broken, by the number in `props`, or come late."""
    f = frames(spark, sf_dir).join(events(spark, sf_dir).select(F.col("event_id").cast("string").alias("frame_id"), "k"), "frame_id")
    k, seconds = F.col("k"), F.unix_micros("ts") / 1e6
    coded = F.base64(F.when(F.size("track_ids") > 0, F.array_join(F.col("track_ids").cast("array<string>"), ",")).otherwise(" ").cast("binary"))
    body = F.to_json(F.struct(
        "camera_id", "frame_id", seconds.alias("timestamp"), F.when(k == 4, F.concat(F.lit("*"), coded)).when(k != 3, coded).alias("frame_b64"),
        (seconds + F.when(k > 90, 11).otherwise(1)).alias("ingested_at"), F.when(k == 6, "faulty").otherwise("ok").alias("producer_id"),
        F.when(k == 2, "x").alias("zone")))
    return f.select("ts", F.when(k == 1, F.substring(body, 1, 20)).otherwise(body).alias("value"))


def weather_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten_weather(payloads(spark, sf_dir), "Los Angeles", now=F.col("ts"), keep=("ts",))
    return flat.select("ts", F.to_json(F.struct(*[c for c in flat.columns if c != "ts"])).alias("value"))


def road_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Vertices = parts; a link leads from a part to the next part of the same order, with its quantity. Links repeat."""
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    chained = row_window(lines, ["l_orderkey"], ["l_linenumber", "l_suppkey", "l_partkey", "l_quantity"],
                         lambda w: {"dst": F.lead("l_partkey").over(w)}, after=1)
    links = chained.filter(F.col("dst").isNotNull() & (F.col("dst") != F.col("l_partkey")))
    return parts, links.select(F.col("l_partkey").alias("src"), "dst", F.col("l_quantity").alias("weight"))


def road_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The vertices, and an edge for all links between two parts."""
    parts, links = road_links(spark, sf_dir)
    return parts, links.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


GRAPH_SQL = """chained as (
  select l_partkey as src, l_quantity, lead(l_partkey) over (
    partition by l_orderkey order by l_linenumber, l_suppkey, l_partkey, l_quantity) as dst from lineitem),
edges as (select src, dst, sum(l_quantity) as weight from chained where dst is not null and dst <> src group by src, dst),
vertices as (select p_partkey as id from part)"""


def offsets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """End offset = newest event, committed = newest event above 300, per type and third of users."""
    e = events(spark, sf_dir).withColumn("partition", F.col("user_id") % 3)
    ends = e.groupBy(F.col("event_type").alias("topic"), "partition").agg(F.max("event_id").alias("end_offset"))
    committed = (e.filter(F.col("value") > 300).groupBy(F.col("event_type").alias("topic"), "partition")
                 .agg(F.max("event_id").alias("offset")).withColumn("group", F.lit("workers")))
    return ends, committed


OFFSETS_SQL = """ends as (
  select event_type as topic, user_id % 3 as "partition", max(event_id) as end_offset from events group by 1, 2),
committed as (
  select 'workers' as "group", event_type as topic, user_id % 3 as "partition", max(event_id) as "offset"
  from events where value > 300 group by 2, 3),
readers as (select distinct "group", topic from committed),
lags as (
  select r."group", e.topic, e."partition", e.end_offset, greatest(coalesce(c."offset", 0), 0) as committed
  from ends e join readers r on e.topic = r.topic
  left join committed c on c."group" = r."group" and c.topic = e.topic and c."partition" = e."partition")"""


def slices(df: DataFrame, ts: str, parts: int) -> list[DataFrame]:
    """Cut a table into consecutive spans of time of about equal size."""
    df = stage(df)
    when = F.unix_micros(ts)
    cuts = df.select(when.alias("t")).approxQuantile("t", [i / parts for i in range(1, parts)], 0.001)
    bounds = [None, *[int(c) for c in cuts], None]
    pieces = []
    for low, high in zip(bounds, bounds[1:]):
        piece = df if low is None else df.filter(when > low)
        pieces.append(piece if high is None else piece.filter(when <= high))
    return pieces


def replay(df: DataFrame, ts: str, run: Callable[[str], StreamingQuery], parts: int = 2) -> None:
    """Hand `df` to a stream in order of time: write a span as text, run the stream, go on.

    Rows are written as JSON; a table of time and `value` alone has its messages ready.
    `run` starts a stream over the folder that ends when it has taken everything; every run
    after the first one restarts it from its checkpoint.
    """
    folder = scratch(df.sparkSession, "replay")
    for piece in slices(df, ts, parts):
        lines = piece.select("value") if set(piece.columns) == {ts, "value"} else to_keyed_json(piece).select("value")
        lines.write.mode("append").text(folder)
        query = run(folder)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
