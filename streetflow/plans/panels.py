"""The figures a traffic dashboard shows, each as one query over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streetflow.functions.display import CONGESTION_MPH, alert_text, first_text, residual, speed_color
from streetflow.functions.media import DEFAULT_BASE_URL, rebase_url
from streetflow.functions.time import parse_event_time
from streetflow.operators import aggregates as agg
from streetflow.operators.enrich import on_map
from streetflow.operators.validate import drop_missing
from streetflow.operators.windows import latest_per, latest_row

# Rows looked at and shown by the panels.
NEWEST_FRAMES = 2000
GRID_FRAMES, GRID_CAMERAS = 200, 8
MAP_READINGS = 20_000
LISTED_PREDICTIONS = 20
LISTED_ALERTS = 20


def speed_panel(readings: DataFrame, threshold: float = CONGESTION_MPH) -> DataFrame:
    """Mean speed and congested share of the newest readings."""
    timed = readings.withColumn("_t", parse_event_time(F.col("timestamp")))
    return agg.network_speed(agg.newest(timed, agg.NEWEST_READINGS, "_t", "sensor_id", "speed"), threshold)


def vehicle_panel(counts: DataFrame) -> DataFrame:
    """Vehicles in the window over all cameras, and active cameras."""
    frames = agg.newest(counts, NEWEST_FRAMES, "timestamp", "camera_id", "frame_id")
    return agg.vehicles_now(frames, order=("timestamp", "frame_id"))


def weather_panel(weather: DataFrame) -> DataFrame:
    """City, temperature and condition of the newest observation."""
    return latest_row(weather, "timestamp", "city").select(
        F.coalesce("city", F.lit("—")).alias("city"), "temp_c",
        first_text(F.col("weather_main"), F.col("weather_description")).alias("condition"))


def camera_grid(counts: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """The newest frame of each of the most recently seen cameras."""
    frames = agg.newest(counts, GRID_FRAMES, "timestamp", "camera_id", "frame_id")
    latest = agg.newest(latest_per(frames, "camera_id", "timestamp", "frame_id"), GRID_CAMERAS, "timestamp", "camera_id")
    caption = F.format_string("%s — %d veh (5m), %d total", F.coalesce("camera_id", F.lit("?")),
                              F.coalesce("unique_count_5min", F.lit(0)), F.coalesce("unique_count_session", F.lit(0)))
    return latest.select("camera_id", rebase_url(F.col("frame_url"), base_url).alias("url"), caption.alias("caption"))


def congestion_map(readings: DataFrame, metadata: DataFrame, threshold: float = CONGESTION_MPH) -> DataFrame:
    """Latest reading per sensor with place, colour and radius."""
    timed = readings.withColumn("_t", parse_event_time(F.col("timestamp")))
    newest = agg.newest(timed, MAP_READINGS, "_t", "sensor_id", "speed")
    placed = on_map(latest_per(newest, "sensor_id", "_t", "speed"), metadata)
    return placed.select("sensor_id", "speed", "lat", "lon", "band", "radius", speed_color(F.col("speed"), threshold).alias("color"))


def scored(predictions: DataFrame) -> DataFrame:
    """The newest predictions that can be compared with an actual speed, with their residual."""
    newest = agg.newest(predictions, agg.NEWEST_READINGS, "processed_at", "sensor_id", "timestamp")
    both = drop_missing(newest, "predicted_speed", "actual_speed")
    return both.withColumn("residual", residual(F.col("actual_speed"), F.col("predicted_speed")))


def latest_predictions(predictions: DataFrame) -> DataFrame:
    newest = agg.newest(scored(predictions), LISTED_PREDICTIONS, "processed_at", "sensor_id", "timestamp")
    return newest.select("sensor_id", "timestamp", "actual_speed", "predicted_speed", "model_version")


def alert_feed(alerts: DataFrame) -> DataFrame:
    """Texts of the newest alerts."""
    newest = agg.newest(alerts, LISTED_ALERTS, "batch_id", "sensor_id", "speed")
    return newest.select("batch_id", alert_text(F.col("sensor_id"), F.col("id"), F.col("speed"), F.col("distances")).alias("text"))
