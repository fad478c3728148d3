"""Weather payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layout of the public weather payload.
PAYLOAD = """name string, sys struct<country: string>,
 main struct<temp: double, feels_like: double, temp_min: double, temp_max: double, humidity: int, pressure: int>,
 wind struct<speed: double, deg: int>, clouds struct<all: int>,
 weather array<struct<main: string, description: string, id: int>>"""


def flatten_weather(df: DataFrame, default_city: str, value: str = "value", now: Column | None = None,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested payload to the 17 columns of a weather message (S10); only the first condition counts."""
    now = F.current_timestamp() if now is None else now
    seconds = F.unix_micros(now) / 1e6
    p = df.select(*keep, F.from_json(value, PAYLOAD).alias("p"), now.alias("_now"), seconds.alias("_s"))
    first = F.get("p.weather", F.lit(0))
    return p.select(
        *keep,
        F.coalesce("p.name", F.lit(default_city)).alias("city"),
        F.coalesce("p.sys.country", F.lit("")).alias("country"),
        F.date_format("_now", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("observed_at"),
        F.col("p.main.temp").alias("temp_c"), F.col("p.main.feels_like").alias("feels_like_c"),
        F.col("p.main.temp_min").alias("temp_min_c"), F.col("p.main.temp_max").alias("temp_max_c"),
        F.col("p.main.humidity").alias("humidity"), F.col("p.main.pressure").alias("pressure_hpa"),
        F.col("p.wind.speed").alias("wind_speed_mps"), F.col("p.wind.deg").alias("wind_deg"),
        F.col("p.clouds.all").alias("clouds_pct"), first["main"].alias("weather_main"),
        first["description"].alias("weather_description"), first["id"].alias("weather_id"),
        F.col("_s").alias("timestamp"), F.col("_s").alias("ingested_at"))
