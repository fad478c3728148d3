"""What the map, the alert feed and the weather card show."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Congestion threshold and map bands in mph, and their RGBA colours.
CONGESTION_MPH = 20.0
SLOW_MPH = 40.0
RED = [220, 50, 50, 200]
YELLOW = [240, 200, 60, 200]
GREEN = [80, 200, 100, 200]
NO_TEXT = "—"


def _by_speed(speed: Column, threshold: float, low: Column, mid: Column, high: Column) -> Column:
    return (F.when(speed.isNull() | F.isnan(speed), None)
            .when(speed < threshold, low).when(speed < SLOW_MPH, mid).otherwise(high))


def speed_color(speed: Column, threshold: float = CONGESTION_MPH) -> Column:
    """RGBA colour of a reading (F8)."""
    red, yellow, green = (F.array(*[F.lit(v) for v in rgba]) for rgba in (RED, YELLOW, GREEN))
    return _by_speed(speed, threshold, red, yellow, green)


def band(speed: Column, threshold: float = CONGESTION_MPH) -> Column:
    return _by_speed(speed, threshold, F.lit("red"), F.lit("yellow"), F.lit("green"))


def radius(speed: Column) -> Column:
    """Marker radius: the slower, the larger; null and NaN give null."""
    clipped = F.greatest(F.lit(0.0), F.least(speed, F.lit(80.0)))
    return F.when(speed.isNotNull() & ~F.isnan(speed), (80 - clipped) * 4 + 50)


def alert_text(sensor_id: Column, vertex: Column, speed: Column, distances: Column) -> Column:
    """One line of the alert feed, landmarks in numeric order (F16).

    Speeds are 32-bit values, and one exactly between two tenths goes to the even one.
    """
    entries = F.array_sort(F.transform(
        F.map_entries(distances),
        lambda e: F.struct(e["key"].try_cast("bigint").alias("n"), e["key"].alias("k"), e["value"].alias("v"))))
    hops = F.transform(entries, lambda e: F.format_string("node %s → %d hops", e["k"], e["v"]))
    return F.format_string("Sensor %s (vertex %s) at %.1f mph — reroute landmarks: %s", sensor_id, vertex,
                           F.bround(speed.cast("float").cast("double"), 1), F.array_join(hops, ", "))


def first_text(*columns: Column, default: str = NO_TEXT) -> Column:
    """The first text that is neither null nor blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns], F.lit(default))


def residual(actual: Column, predicted: Column) -> Column:
    return actual - predicted
