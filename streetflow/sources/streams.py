"""Topic streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Rows per trigger of each topic; the weather topic has no limit.
ROWS_PER_TRIGGER = {"sensors": 5000, "gps": 5000, "speed_predictions": 5000, "cctv": 500, "weather": None}


def stream_source(spark: SparkSession, kind: str, where: str, topic: str | None = None,
                  max_per_trigger: int | None = None) -> DataFrame:
    """A stream with a text column `value`.

    `kind` is "kafka" (`where` = bootstrap servers, from the latest offset, limit in rows) or
    "text" (`where` = folder, limit in files). Without `max_per_trigger` a Kafka topic has the
    limit of ROWS_PER_TRIGGER, found by the topic's name with or without "topic_"; 0 means none.
    """
    if kind == "kafka":
        reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", where)
                  .option("subscribe", topic).option("startingOffsets", "latest"))
        if max_per_trigger is None:
            max_per_trigger = ROWS_PER_TRIGGER.get((topic or "").removeprefix("topic_"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().selectExpr("cast(key as string) key", "cast(value as string) value")
    if kind == "text":
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.load(where)
    raise ValueError(f"unknown stream kind {kind!r}")
