"""Road graph, stored tables, streams and models."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from streetflow import functions as fn
from streetflow.operators import graph, model
from streetflow.operators.blocks import row_index
from streetflow.operators.enrich import rerouting_alerts
from streetflow.operators.validate import decode
from streetflow.operators.windows import FEATURES, speed_features
from streetflow.plans import batch, inputs, panels
from streetflow.plans.figures import COUNTS_SQL, FEATURES_SQL, GRID_SQL, LAGS_SQL, _metadata
from streetflow.plans.inputs import DECODED_SQL, FRAMES_SQL, GRAPH_SQL, MESSAGES_SQL
from streetflow.plans.registry import big, micros, query, six, whole
from streetflow.plans.rows import CONTRACT_SQL
from streetflow.session import scratch, stage
from streetflow.sinks.tables import append_once, compact, expire, replaced_batches, write_snapshot
from streetflow.sources.sensors import read_locations
from streetflow.sources.streams import stream_source
from streetflow.sources.tables import explore, load_static, load_table, read_table
from streetflow.streaming import ingest, scoring, state

# --- graph -----------------------------------------------------------------------------------

HOPS_SQL = GRAPH_SQL + """,
bfs as (
  select v.id, l.landmark, 0 as d from (select unnest(['0', '50', '100']) as landmark) l join vertices v on v.id = cast(l.landmark as bigint)
  union
  select e.src, b.landmark, b.d + 1 from bfs b join edges e on e.dst = b.id where b.d < 12),
hops as (select id, landmark, min(d) as hops from bfs group by 1, 2),
paths as (select v.id, coalesce(string_agg(landmark || ':' || hops, ',' order by cast(landmark as bigint)), '') as distances
  from vertices v left join hops h on h.id = v.id group by 1)"""


def _rank_sql(rounds: int) -> str:
    """The same PageRank as a chain of `rounds` steps."""
    sql = GRAPH_SQL + """,
outs as (select src, sum(weight) as w from edges group by 1),
size as (select count(*) as n from vertices),
r0 as (select v.id, 1.0::double / n as rank, w from vertices v cross join size left join outs on src = v.id)"""
    for i in range(rounds):
        sql += f""",
l{i} as (select coalesce(sum(rank) filter (w is null), 0) as loose from r{i}),
g{i} as (select dst as id, sum(rank * weight / w) as got from edges join r{i} on src = r{i}.id group by 1),
r{i + 1} as (select r.id, 0.15 / n + 0.85 * loose / n + 0.85 * coalesce(got, 0) as rank, w
  from r{i} r cross join size cross join l{i} left join g{i} g on g.id = r.id)"""
    return sql


def _paths(spark, sf):
    # a search needs no sums of the links between two parts
    vertices, links = inputs.road_links(spark, sf)
    return graph.distance_maps(vertices, graph.hops_to(vertices, links))


def _distances(column="distances"):
    """A distance map as text, landmarks in numeric order."""
    entries = F.array_sort(F.transform(F.map_entries(column), lambda e: F.struct(e["key"].cast("bigint").alias("k"), e["value"].alias("v"))))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["k"].cast("string"), e["v"].cast("string"))), ",")


@query("g1_edges", "with " + GRAPH_SQL + " select src, dst, weight from edges")
def g1(spark, sf):
    return inputs.road_graph(spark, sf)[1].select("src", "dst", "weight")


@query("g2_pagerank_rounds", "with " + _rank_sql(8) + " select id, round(rank, 9) as pagerank from r8")
def g2(spark, sf):
    vertices, edges = inputs.road_graph(spark, sf)
    ranks = graph.pagerank(vertices, edges, max_rounds=8, tolerance=0.0)
    return ranks.select("id", F.round("pagerank", 9).alias("pagerank"))


_MOST_ROUNDS = 20


@query("g2_g3_pagerank", "with " + _rank_sql(_MOST_ROUNDS) + """,
moves as (""" + " union all ".join(
    f"select {i} as i, sum(abs(b.rank - a.rank)) as moved from r{i - 1} a join r{i} b using (id)" for i in range(1, _MOST_ROUNDS + 1)) + """),
last as (select min(i) as i from moves cross join size where moved < n * 1e-6),
every as (""" + " union all ".join(f"select {i} as i, id, rank from r{i}" for i in range(1, _MOST_ROUNDS + 1)) + """)
select cast(id as varchar) as id, round(cast(cast(rank as float) as double), 9) as pagerank from every join last using (i)""")
def g3(spark, sf):
    """The stored table: rounds until the ranks settle, 32-bit ranks."""
    ranks = graph.pagerank_table(graph.pagerank(*inputs.road_graph(spark, sf)))
    return ranks.select("id", F.round(F.col("pagerank").cast("double"), 9).alias("pagerank"))


@query("t2_top_vertices", "with " + _rank_sql(8) + """
select id, round(rank, 9) as pagerank from r8 order by rank desc, id limit 10""")
def t2(spark, sf):
    ranks = graph.pagerank(*inputs.road_graph(spark, sf), max_rounds=8, tolerance=0.0)
    return graph.top_vertices(ranks).select("id", F.round("pagerank", 9).alias("pagerank"))


@query("g4_hops", "with recursive " + HOPS_SQL + " select id, landmark, cast(hops as bigint) as hops from hops")
def g4(spark, sf):
    return graph.hops_to(*inputs.road_links(spark, sf)).select("id", "landmark", big("hops"))


@query("g5_distance_maps", "with recursive " + HOPS_SQL + " select cast(id as varchar) as id, distances from paths")
def g5(spark, sf):
    return _paths(spark, sf).select("id", _distances().alias("distances"))


@query("g6_graph_stats", "with " + GRAPH_SQL + """,
n as (select (select count(*) from vertices) as vertices, (select count(*) from edges) as edges)
select vertices, edges, round(edges / vertices, 6) as mean_out_degree, round(edges / (vertices * (vertices - 1)), 9) as density from n""")
def g6(spark, sf):
    stats = graph.graph_stats(*inputs.road_graph(spark, sf))
    return stats.select("vertices", "edges", six("mean_out_degree"), F.round("density", 9).alias("density"))


ALERTS_SQL = HOPS_SQL + """,
alerts as (select e.event_id, e.ts, p.id, e.value as speed, p.distances from events e join paths p on p.id = e.user_id
  where e.value < 20 and p.distances <> '')"""


@query("j1_rerouting_alerts", "with recursive " + ALERTS_SQL + """
select cast(id as varchar) as id, cast(id as varchar) as sensor_id, speed, distances, cast(0 as bigint) as batch_id from alerts""")
def j1(spark, sf):
    alerts = rerouting_alerts(inputs.readings(spark, sf), _paths(spark, sf), batch_id=0)
    return alerts.select("id", "sensor_id", "speed", _distances().alias("distances"), "batch_id")


@query("f16_alert_text", "with recursive " + HOPS_SQL + """,
texts as (select v.id, string_agg('node ' || landmark || ' → ' || hops || ' hops', ', ' order by cast(landmark as bigint)) as t
  from vertices v join hops h on h.id = v.id group by 1)
select 'Sensor ' || id || ' (vertex ' || id || ') at ' || printf('%.1f', cast(cast(value as float) as double)) || ' mph — reroute landmarks: ' || t as text
from events join texts on id = user_id where value < 20""")
def f16(spark, sf):
    alerts = rerouting_alerts(inputs.readings(spark, sf), _paths(spark, sf), batch_id=0)
    return alerts.select(fn.alert_text(F.col("sensor_id"), F.col("id"), F.col("speed"), F.col("distances")).alias("text"))


# --- stored tables ---------------------------------------------------------------------------

@query("k3_append_once", "select event_id, value as speed from events")
def k3(spark, sf):
    """Two batches, the second written twice."""
    r, path = inputs.readings(spark, sf), scratch(inputs.prepare(spark), "append")
    day = r.withColumn("event_date", F.to_date("ts"))
    append_once(day.filter(F.col("speed") < 20), path, 0, partition_by=("event_date",))
    for _ in range(2):
        append_once(day.filter(F.col("speed") >= 20), path, 1, partition_by=("event_date",))
    return load_table(spark, path).select("event_id", "speed")


@query("k4_schema_merge", """
select event_id, case when value >= 20 then event_type end as kind from events""")
def k4(spark, sf):
    """The second batch brings a column the first one lacks."""
    e, path = inputs.events(spark, sf).select("event_id", "value", F.col("event_type").alias("kind")), scratch(spark, "merge")
    append_once(e.filter(F.col("value") < 20).drop("kind"), path, 0)
    append_once(e.filter(F.col("value") >= 20), path, 1)
    return load_table(spark, path).select("event_id", "kind")


@query("k5_snapshot", "select event_id, event_type from events")
def k5(spark, sf):
    e, path = inputs.events(spark, sf).select("event_id", "event_type"), scratch(spark, "snapshot")
    write_snapshot(e.filter(F.col("event_type") == "view"), path)
    write_snapshot(e, path)
    return read_table(spark, path, "")


@query("k3_two_writers", """
select event_id, 'one' as writer from events union all select event_id, 'two' as writer from events""")
def k3_writers(spark, sf):
    """Two writers and two runs of each use the same batch numbers on one table; every batch is written twice."""
    e, path = inputs.events(spark, sf).select("event_id"), scratch(spark, "writers")
    for writer in ("one", "two"):
        for run in (0, 1):
            for _ in range(2):
                append_once(e.filter(F.col("event_id") % 2 == run).withColumn("writer", F.lit(writer)), path, 0, writer, run=f"run-{run}")
    return load_table(spark, path).select("event_id", "writer")


BATCHES = 5


def _batches(rows, path, **how):
    """Append a table in some batches, by a hash of the event."""
    for number in range(BATCHES):
        append_once(rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(BATCHES)) == number), path, number, **how)


@query("k7_compact", "select event_id, value as speed, strftime(ts, '%Y-%m-%d') as event_date from events")
def k7(spark, sf):
    """Rows of a compacted table are the rows that were appended."""
    e, path = inputs.events(spark, sf).withColumn("event_date", F.to_date("ts")), scratch(spark, "compact")
    _batches(e, path, partition_by=("event_date",))
    compact(spark, path, partition_by=("event_date",))
    return load_table(spark, path).select("event_id", F.col("value").alias("speed"), F.col("event_date").cast("string").alias("event_date"))


@query("k8_expire", f"select event_id, value as speed, {BATCHES - 1} as replaced, 0 as left_over from events")
def k8(spark, sf):
    """Compaction replaces all batches but the newest, which a stream may still repeat; expiry deletes those files and no row."""
    e, path = inputs.events(spark, sf).select("event_id", F.col("value").alias("speed")), scratch(spark, "expire")
    _batches(e, path)
    compact(spark, path)
    replaced = len(replaced_batches(spark, path))
    expire(spark, path, hours=0, force=True)
    left_over = len(replaced_batches(spark, path))
    return load_table(spark, path).select("event_id", "speed", F.lit(replaced).alias("replaced"), F.lit(left_over).alias("left_over"))


@query("s4_read_locations", "with " + GRID_SQL + """
select sensor_id, i as sensor_index, round(lat, 6) as lat, round(lon, 6) as lon from grid""")
def s4(spark, sf):
    """The grid written as CSV with other header names, and read back in file order."""
    path = scratch(spark, "places")
    grid = _metadata(spark, sf).orderBy("sensor_index")
    grid.select(F.col("lat").alias("Latitude"), F.col("sensor_id").alias("ID"), F.col("lon").alias("LNG")).write.option("header", "true").csv(path)
    found = read_locations(spark, ["/nowhere.csv", path])
    return found.select("sensor_id", big("sensor_index"), six("lat"), six("lon"))


@query("s12_v14_metadata", "with " + GRID_SQL + """
select sensor_id, i as sensor_index, round(lat, 6) as lat, round(lon, 6) as lon from grid""")
def s12(spark, sf):
    """No CSV is there, so known ids go on the grid; the stored table is then looked at as it is."""
    root = scratch(spark, "root")
    ids = inputs.events(spark, sf).select("user_id").distinct().orderBy("user_id")
    ids = row_index(ids, ["user_id"], "sensor_index").withColumn("sensor_id", F.col("user_id").cast("string"))
    batch.build_sensor_metadata(spark, root, ["/nowhere.csv"], ids)
    return explore(spark, root, "sensor_metadata", limit=None).select("sensor_id", big("sensor_index"), six("lat"), six("lon"))


# --- streams ---------------------------------------------------------------------------------

def _drain(df, ts, schema, shape, name):
    """Send a table through a stream in order of time and read what the stream stored.

    `shape` turns the decoded stream into the stored one.
    """
    spark = df.sparkSession
    path, ckpt = scratch(spark, name), scratch(spark, f"{name}-ckpt")

    def run(folder):
        return ingest.start_append(shape(decode(stream_source(spark, "text", folder), schema)), path, ckpt)

    inputs.replay(df, ts, run)
    return load_table(spark, path)


MESSAGE = "event_id bigint, ts timestamp, value string"


def _messages(spark, sf):
    return inputs.messages(spark, sf).select("event_id", "ts", "value")


@query("s1_k1_stream_append", "with " + MESSAGES_SQL + " select event_id, value from msg")
def s1(spark, sf):
    return _drain(_messages(spark, sf), "ts", MESSAGE, lambda rows: rows.select("event_id", "value"), "s1")


def _run_sensors(spark, sf):
    spark = inputs.prepare(spark)
    root, ckpt, tables = scratch(spark, "sensors"), scratch(spark, "ckpt"), scratch(spark, "paths")
    write_snapshot(_paths(spark, sf), tables)
    paths = load_static(spark, tables)

    def run(folder):
        return ingest.start_sensors(decode(stream_source(spark, "text", folder), MESSAGE), root, ckpt, paths)

    inputs.replay(_messages(spark, sf), "ts", run)
    return spark, root


_GOOD_SQL = DECODED_SQL + """,
good as (select * from decoded where sensor_id is not null and speed between 0 and 150 and k <> 13)"""


@query("k2_stream_speeds", "with " + _GOOD_SQL + """
select sensor_id, cast(sensor_index as varchar) as sensor_index, round(speed, 6) as speed, strftime(ts, '%Y-%m-%d') as event_date from good
where k <> 8 union all
select sensor_id, cast(sensor_index as varchar) as sensor_index, round(speed, 6) as speed,
  strftime(make_timestamp(cast("timestamp" as bigint) // 1000), '%Y-%m-%d') as event_date from good where k = 8""")
def k2_speeds(spark, sf):
    spark, root = _run_sensors(spark, sf)
    rows = read_table(spark, root, "sensor_speeds")
    return rows.select("sensor_id", whole("sensor_index"), six("speed"), F.col("event_date").cast("string").alias("event_date"))


@query("k2_stream_dead_letters", "with " + CONTRACT_SQL + """,
bad as (select event_id, value, errors from checked where k = 13 or len(list_filter(errors,
    lambda x: x in ('not_json', 'not_object', 'sensor_id:required', 'speed:required', 'speed:type', 'speed:above_maximum', 'speed:below_minimum'))) > 0)
select value, array_to_string(errors, ',') as dlq_errors, 'failed_validation' as dlq_reason from bad""")
def k2_dlq(spark, sf):
    spark, root = _run_sensors(spark, sf)
    rows = read_table(spark, root, "dlq_sensors")
    return rows.select("value", F.array_join("dlq_errors", ",").alias("dlq_errors"), "dlq_reason")


@query("k2_stream_alerts", "with recursive " + DECODED_SQL + ", " + HOPS_SQL + """
select cast(p.id as varchar) as id, d.sensor_id, round(d.speed, 6) as speed, p.distances from decoded d join paths p on p.id = d.sensor_index
where d.sensor_id is not null and d.k <> 13 and d.speed < 20 and d.speed >= 0 and p.distances <> ''""")
def k2_alerts(spark, sf):
    spark, root = _run_sensors(spark, sf)
    rows = read_table(spark, root, "rerouting_alerts")
    return rows.select("id", "sensor_id", six("speed"), _distances().alias("distances"))


@query("a9_batch_latency", "with recursive " + _GOOD_SQL + ", " + HOPS_SQL + """
select (select count(*) from good) as valid_count, (select count(*) from decoded) - (select count(*) from good) as invalid_count,
  (select count(*) from good d join paths p on p.id = d.sensor_index where d.speed < 20 and p.distances <> '') as alerts_count""")
def a9(spark, sf):
    spark, root = _run_sensors(spark, sf)
    rows = read_table(spark, root, "pipeline_latency")
    return rows.agg(*[F.sum(c).alias(c) for c in ("valid_count", "invalid_count", "alerts_count")])


def _fed(messages, kind):
    """Send messages through one of the plain feeds and read its table."""
    spark = messages.sparkSession
    root, ckpt = scratch(spark, kind), scratch(spark, f"{kind}-ckpt")

    def run(folder):
        return ingest.start_feed(stream_source(spark, "text", folder), kind, root, ckpt)

    inputs.replay(messages, "ts", run)
    rows = read_table(spark, root, ingest.FEEDS[kind].table)
    return rows.withColumn("event_date", F.col("event_date").cast("string")) if "event_date" in rows.columns else rows


@query("r5_stream_trips", "with " + inputs.RIDES_SQL + """
select pickup_time, dropoff_time, pickup_zone, dropoff_zone, round(distance_miles, 6) as distance_miles, event_date
from rides where dropoff_time is not null""")
def r5_trips(spark, sf):
    rows = _fed(inputs.ride_messages(spark, sf), "gps")
    return rows.select("pickup_time", "dropoff_time", big("pickup_zone"), big("dropoff_zone"), six("distance_miles"), "event_date")


@query("r5_stream_predictions", "with " + inputs.PREDICTIONS_SQL + """
select sensor_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as "timestamp", round(cast(cast(actual_speed as float) as double), 6) as actual_speed,
  round(cast(cast(predicted_speed as float) as double), 6) as predicted_speed, strftime(ts, '%Y-%m-%d') as event_date
from p where predicted_speed is not null""")
def r5_predictions(spark, sf):
    rows = _fed(inputs.prediction_messages(spark, sf), "speed_predictions")
    return rows.select("sensor_id", "timestamp", six("actual_speed"), six("predicted_speed"), "event_date")


@query("r5_stream_cameras", """
select event_type as camera_id, cast(event_id as varchar) as frame_id, epoch_us(ts) / 1e6 as "timestamp",
  cast(props->>'$.k' as bigint) as unique_count_5min, cast(user_id as varchar) as track_ids, strftime(ts, '%Y-%m-%d') as event_date
from events where cast(props->>'$.k' as int) >= 10""")
def r5_cameras(spark, sf):
    rows = _fed(inputs.camera_messages(spark, sf), "cctv")
    return rows.select("camera_id", "frame_id", "timestamp", big("unique_count_5min"),
                       F.array_join(F.col("track_ids").cast("array<string>"), ",").alias("track_ids"), "event_date")


@query("r5_stream_weather", "with " + inputs.WEATHER_SQL + """
select city, round(cast(cast(temp_c as float) as double), 6) as temp_c, clouds_pct, weather_main, epoch_us(ts) / 1e6 as "timestamp" from flat""")
def r5_weather(spark, sf):
    rows = _fed(inputs.weather_messages(spark, sf), "weather")
    return rows.select("city", six("temp_c"), big("clouds_pct"), "weather_main", "timestamp")


READING = "event_id bigint, sensor_id string, sensor_index int, speed double, ts timestamp"


def _feature_rows(df):
    return df.select("sensor_id", micros("ts"), "speed", big("hour"), big("dow"), big("is_weekend"), "lag_5min", "lag_15min",
                     "lag_1h", six("rolling_mean_30min"))


_STREAM_FEATURES_SQL = """
select sensor_id, epoch_us(ts) as ts_us, speed, hour, dow, is_weekend, lag_5min, lag_15min, lag_1h, rolling_mean_30min from feats"""


@query("r1_stream_features", "with " + FEATURES_SQL + _STREAM_FEATURES_SQL)
def r1(spark, sf):
    return _feature_rows(_drain(inputs.readings(spark, sf), "ts", READING,
                                lambda rows: state.stream_features(rows, tie="event_id"), "r1"))


_MIDDLE_SQL = "(select (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 from events)"


@query("r2_warm_start", "with " + FEATURES_SQL + f""",
used as (select sum(least(n, 12))::bigint as rows_used from (select count(*) as n from events where epoch_us(ts) < {_MIDDLE_SQL}
  and epoch_us(ts) >= (select max(epoch_us(ts)) from events where epoch_us(ts) < {_MIDDLE_SQL}) - 30 * 24 * 3600 * 1000000::bigint group by user_id))
select x.*, rows_used from (""" + _STREAM_FEATURES_SQL + f" where epoch_us(ts) >= {_MIDDLE_SQL}) x cross join used")
def r2(spark, sf):
    """State from the first half of the readings, the second half as a stream; the number of readings in the state is reported."""
    r = inputs.readings(spark, sf)
    t = F.unix_micros("ts")
    middle = r.select(F.call_function("div", F.min(t) + F.max(t), F.lit(2))).first()[0]
    used = Observation()
    warm = state.warm_state(r.filter(t < middle), minutes=60 * 24 * 30, used=used)
    rows = _feature_rows(_drain(r.filter(t >= middle), "ts", READING,
                                lambda rows: state.stream_features(rows, tie="event_id", warm=warm), "r2"))
    return rows.withColumn("rows_used", F.lit(used.get["rows"]).cast("bigint"))


@query("r3_stream_counts", "with " + COUNTS_SQL + " select * from counts")
def r3(spark, sf):
    counted = _drain(inputs.frames(spark, sf), "ts",
                     "camera_id string, frame_id string, ts timestamp, track_ids array<bigint>",
                     lambda frames: state.stream_counts(frames, 6 * 3600.0), "r3")
    return counted.select("camera_id", "frame_id", "unique_count_5min", "unique_count_session")


# --- panels ----------------------------------------------------------------------------------

@query("p1_camera_grid", """
with n as (select *, cast(props->>'$.k' as bigint) as k from events order by ts desc, event_type desc, event_id desc limit 200),
l as (select * from n qualify row_number() over (partition by event_type order by ts desc, event_id desc) = 1 order by ts desc limit 8)
select event_type as camera_id, 'http://new/cctv-frames/' || event_type || '/' || event_id || '.jpg' as url,
  event_type || ' — ' || k || ' veh (5m), ' || user_id || ' total' as caption from l""")
def p1(spark, sf):
    e = inputs.events(spark, sf)
    frame = F.format_string("%012d", "event_id")
    url = fn.object_url(fn.object_key(F.col("event_type"), F.col("event_id").cast("string")))
    counts = e.select(F.col("event_type").alias("camera_id"), frame.alias("frame_id"), (F.unix_micros("ts") / 1e6).alias("timestamp"),
                      F.col("k").alias("unique_count_5min"), F.col("user_id").cast("int").alias("unique_count_session"), url.alias("frame_url"))
    return panels.camera_grid(counts, "http://new/cctv-frames")


@query("p2_speed_panel", """
with n as (select cast(cast(value as float) as double) as v from events order by ts desc, event_id desc limit 5000)
select round(avg(v), 4) as avg_speed, round(avg(cast(v < 20 as int)) * 100, 4) as congested_pct from n""")
def p2(spark, sf):
    r = inputs.readings(spark, sf).select("sensor_id", F.col("ts").cast("string").alias("timestamp"), F.col("speed").cast("float").alias("speed"))
    panel = panels.speed_panel(r)
    return panel.select(F.round("avg_speed", 4).alias("avg_speed"), F.round("congested_pct", 4).alias("congested_pct"))


# --- models ----------------------------------------------------------------------------------

KEY = ("sensor_id", "ts")


def _trained(spark, sf):
    features = speed_features(inputs.readings(spark, sf), order=("ts", "event_id"))
    train, test = model.hash_split(features, KEY)
    return model.train_speed(train, KEY), train, test


_SPLIT_SQL = """parts as (select *, ('0x' || substr(md5(concat_ws('|', user_id, epoch_us(ts), '42')), 1, 8))::bigint % 100 < 80 as is_train from events)"""
_FEATURE_SPLIT_SQL = LAGS_SQL + ", " + _SPLIT_SQL + """,
rows as (select lags.*, is_train from lags join parts using (event_id) where lag_1h is not null)"""


@query("m1_m6_baseline_predictions", "with " + _SPLIT_SQL + """
select cast(user_id as varchar) as sensor_id, epoch_us(ts) as ts_us, value as speed, true as plausible from parts where not is_train""")
def m1(spark, sf):
    """The test rows with a prediction inside the range of speeds that were learned from."""
    train, test = model.hash_split(model.baseline_features(inputs.readings(spark, sf)), KEY)
    rows = model.prediction_rows(model.baseline_model().fit(train).transform(test))
    low, high = train.agg(F.min("speed"), F.max("speed")).first()
    # boosting adds up steps, so a prediction may leave the range a little
    slack = (high - low) / 2
    return rows.select("sensor_id", F.unix_micros("timestamp").alias("ts_us"), "speed", F.col("prediction").between(low - slack, high + slack).alias("plausible"))


@query("m2_split", "with " + _SPLIT_SQL + " select event_id, case when is_train then 'train' else 'test' end as part from parts")
def m2(spark, sf):
    train, test = model.hash_split(inputs.readings(spark, sf), KEY)
    return train.select("event_id", F.lit("train").alias("part")).unionByName(test.select("event_id", F.lit("test").alias("part")))


#: How much worse than the mean of the training rows a model may do: these readings are mostly noise.
NOISE = 1.05


@query("m3_m4_speed_model", "with " + _FEATURE_SPLIT_SQL + """
select count(*) as n, true as near_the_mean, true as errors_in_order, true as r2_fits from rows where not is_train""")
def m3(spark, sf):
    """Errors on the test rows: no worse than those of the training rows' mean, mae up to rmse, r2 by its definition."""
    fitted, train, test = _trained(spark, sf)
    mean = train.agg(F.avg("speed")).first()[0]
    plain = test.agg(F.sqrt(F.avg(F.pow(F.col("speed") - mean, 2))).alias("plain"), F.var_pop("speed").alias("var"))
    e = model.evaluate(fitted.transform(test)).crossJoin(F.broadcast(plain))
    return e.select("n", (F.col("rmse") <= NOISE * F.col("plain")).alias("near_the_mean"), (F.col("mae") <= F.col("rmse")).alias("errors_in_order"),
                    (F.abs(F.col("r2") - (1 - F.pow("rmse", F.lit(2)) / F.col("var"))) < 1e-6).alias("r2_fits"))


@query("m5_importances", "select unnest(" + repr(sorted(FEATURES)) + """) as feature, true as in_range, true as sum_is_one""")
def m5(spark, sf):
    fitted, train, _ = _trained(spark, sf)
    rows = model.importance_table(train, fitted)
    total = rows.agg(F.sum("importance")).first()[0]
    return rows.select("feature", F.col("importance").between(0, 1).alias("in_range"), F.lit(abs(total - 1) < 1e-9).alias("sum_is_one"))


@query("k10_run_record", "with " + _FEATURE_SPLIT_SQL + f"""
select '{model.MODEL_VERSION}' as model_version, count(*) filter (is_train) as n_train, count(*) filter (not is_train) as n_test,
  '{",".join(FEATURES)}' as features, {len(FEATURES)} as n_importances, '{model.ROUNDS}' as max_rounds, true as timed from rows""")
def k10(spark, sf):
    import time
    started = time.time()
    fitted, train, test = _trained(spark, sf)
    record = model.run_record(fitted, fitted.transform(test), train.count(), time.time() - started)
    return record.select("model_version", "n_train", "n_test", F.array_join("features", ",").alias("features"), F.size("importances").alias("n_importances"),
                         F.col("params")["maxIter"].alias("max_rounds"), ((F.col("train_seconds") > 0) & (F.col("rmse") > 0)).alias("timed"))


@query("r4_stream_scores", "with " + LAGS_SQL + """
select sensor_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as second, speed as actual_speed, 0 as horizon_minutes from lags where lag_1h is not null""")
def r4(spark, sf):
    """Readings scored as they arrive; all but the predicted value can be said in SQL."""
    fitted, _, _ = _trained(spark, sf)
    path = scratch(spark, "model")
    model.save_model(fitted, path)
    fitted = model.load_model(path)

    def score(rows):
        features = state.stream_features(rows, tie="event_id")
        return model.keep_valid(model.output_records(fitted.transform(features)))

    stored = _drain(inputs.readings(spark, sf), "ts", READING, score, "r4")
    return stored.filter(F.col("predicted_speed").isNotNull()).select(
        "sensor_id", F.substring("timestamp", 1, 19).alias("second"), "actual_speed", "horizon_minutes")


# --- online jobs -----------------------------------------------------------------------------

def _score_messages(spark, sf, score):
    """Run the scoring job over the sensor messages; returns the folder of its tables and that of its messages."""
    spark = inputs.prepare(spark)
    root, ckpt, topic = scratch(spark, "scoring"), scratch(spark, "ckpt"), scratch(spark, "topic")

    def run(folder):
        return scoring.start_scoring(stream_source(spark, "text", folder), score, root, ckpt, topic)

    inputs.replay(inputs.messages(spark, sf).select("ts", "value"), "ts", run)
    return root, topic


_ACCEPTED_SQL = CONTRACT_SQL + """,
good as (select j->>'$.sensor_id' as sensor_id, j->>'$.timestamp' as "timestamp", ts, cast(cast(j->>'$.speed' as float) as double) as speed
  from checked where len(errors) = 0 and k <> 13),
past as (select *, lag(speed, 12) over s as lag_1h, avg(speed) over (s rows between 6 preceding and 1 preceding) as rolling
  from good window s as (partition by sensor_id order by ts, "timestamp"))"""


@query("r4_scoring_job", "with " + _ACCEPTED_SQL + """
select sensor_id, "timestamp", round(speed, 6) as actual_speed, 0 as horizon_minutes, true as as_in_batch from past where lag_1h is not null""")
def r4_job(spark, sf):
    """Messages in, prediction messages out, stored by the predictions feed, and compared with the scores of a batch."""
    fitted, _, _ = _trained(spark, sf)
    root, topic = _score_messages(spark, sf, fitted.transform)
    ingest.start_feed(stream_source(spark, "text", topic), "speed_predictions", root, scratch(spark, "ckpt")).awaitTermination()
    stored = read_table(spark, root, "speed_predictions")
    readings = stage(scoring.checked_readings(inputs.messages(spark, sf))).where("reason is null")
    batch = fitted.transform(speed_features(readings, order=("ts", "timestamp"))).select("sensor_id", "timestamp", "prediction")
    both = stored.join(batch, ["sensor_id", "timestamp"], "left")
    same = F.abs(F.col("predicted_speed") - F.col("prediction")) < 1e-3
    return both.select("sensor_id", "timestamp", six("actual_speed"), big("horizon_minutes"), F.coalesce(same, F.lit(False)).alias("as_in_batch"))


def _watch_frames(spark, sf):
    """Run the camera job over raw frames, whose image bytes are the vehicles' ids; returns its tables' and messages' folders."""
    spark = inputs.prepare(spark)
    root, ckpt, topic = scratch(spark, "cameras"), scratch(spark, "ckpt"), scratch(spark, "topic")

    def detect(frames):
        text = F.col("image").cast("string")
        ids = F.when(F.trim(text) == "", F.array().cast("array<bigint>")).otherwise(F.split(text, ",").cast("array<bigint>"))
        return frames.withColumn("track_ids", ids).withColumn("inference_ms", F.when(F.col("producer_id") == "faulty", -1.0).otherwise(5.0))

    def run(folder):
        return scoring.start_cameras(stream_source(spark, "text", folder), detect, root, ckpt, topic, now=F.col("ingested_at"), seconds=6 * 3600.0)

    inputs.replay(inputs.raw_frames(spark, sf), "ts", run)
    return root, topic


_SEEN_SQL = """e as (select *, cast(props->>'$.k' as int) as k from events),
f as (select event_type as camera_id, cast(event_id as varchar) as frame_id, ts, k,
  case when k < 10 then [] when k < 30 then [user_id, cast(k as bigint)] else [user_id] end as track_ids from e where k not in (1, 2, 3, 4) and k <= 90),
s as (select camera_id, ts, unnest(track_ids) as track_id from f)"""


@query("e4_camera_job", "with " + _SEEN_SQL + COUNTS_SQL[len(FRAMES_SQL):] + """
select camera_id, frame_id, cast(unique_count_5min as bigint) as unique_count_5min, cast(unique_count_session as bigint) as unique_count_session,
  array_to_string(list_sort(track_ids), ',') as track_ids, 'http://localhost:9000/cctv-frames/' || camera_id || '/' || frame_id || '.jpg' as frame_url
from counts join f using (camera_id, frame_id) where k <> 6""")
def e4(spark, sf):
    """Raw frames in, counted frames out, stored by the camera feed."""
    root, topic = _watch_frames(spark, sf)
    ingest.start_feed(stream_source(spark, "text", topic), "cctv", root, scratch(spark, "ckpt")).awaitTermination()
    rows = read_table(spark, root, "cv_vehicle_counts")
    return rows.select("camera_id", "frame_id", big("unique_count_5min"), big("unique_count_session"),
                       F.array_join(F.array_sort("track_ids").cast("array<string>"), ",").alias("track_ids"), "frame_url")


@query("a10_stream_skips", "with " + _ACCEPTED_SQL + """,
scoring as (select case when list_contains(errors, 'not_json') then 'json_decode_error' when len(errors) > 0 then 'schema_invalid' else 'bad_timestamp' end as reason, null as key
  from checked where len(errors) > 0 or k = 13
  union all select case when lag_1h is null then 'warming_up' when lag_1h < 20 then 'output_invalid' end, sensor_id from past),
cameras as (select case when k = 1 then 'json_decode_error' when k in (2, 3) then 'schema_invalid' when k > 90 then 'stale' when k = 4 then 'decode_error'
    when k = 6 then 'output_invalid' end as reason, event_type as key from (select *, cast(props->>'$.k' as int) as k from events)),
every as (select 'scoring' as job, * from scoring union all select 'cameras', * from cameras)
select job, case when reason is null then 'processed' else 'skipped' end as outcome, coalesce(reason, key) as key, count(*) as n from every group by all""")
def a10_stream(spark, sf):
    """What both jobs processed, by entity, and skipped, by reason; the score here has nothing to say after a slow hour."""
    slow = lambda rows: rows.withColumn("prediction", F.when(F.col("lag_1h") >= 20, F.col("rolling_mean_30min")))
    tables = [("scoring", _score_messages(spark, sf, slow)[0]), ("cameras", _watch_frames(spark, sf)[0])]
    rows = [load_table(spark, f"{root}/{job}_counts").withColumn("job", F.lit(job)) for job, root in tables]
    return rows[0].unionByName(rows[1]).groupBy("job", "outcome", "key").agg(F.sum("n").alias("n"))
