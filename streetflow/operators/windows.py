"""Latest rows, lag features, distinct counts over time, numbering and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetflow.functions.time import hour_of_day, is_weekend, iso_weekday
from streetflow.operators.blocks import BLOCK_ROWS, row_index, row_window, running_sum
from streetflow.operators.validate import drop_missing

# Feature names and the rows they look back, window lengths and counts.
LAGS = {"lag_5min": 1, "lag_15min": 3, "lag_1h": 12}
ROLLING_ROWS = 6
ROLLING_MIN_ROWS = 2
HISTORY_ROWS = 12
FEATURES = ["hour", "dow", "is_weekend", "lag_5min", "lag_15min", "lag_1h", "rolling_mean_30min"]
UNIQUE_WINDOW_SEC = 300.0
SPLIT_RATIOS = (0.70, 0.85)
SPLIT_SEED = 42

# Up to this many rows per group Spark limits groups before the shuffle
# (spark.sql.optimizer.windowGroupLimitThreshold).
MAP_SIDE_ROWS = 1000


def latest_per(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row with the greatest `order` per key (W1): a partial aggregation, no sort of the rows."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(key).agg(newest.alias("_r")).select("_r.*")


def latest_row(df: DataFrame, *order: str) -> DataFrame:
    """The single newest row."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(1)


def lag_columns(window: Window, value: str = "speed") -> dict[str, Column]:
    """Lags by rows and the mean of the rows before."""
    past = window.rowsBetween(-ROLLING_ROWS, -1)
    columns = {name: F.lag(value, n).over(window) for name, n in LAGS.items()}
    columns["rolling_mean_30min"] = F.when(F.count(value).over(past) >= ROLLING_MIN_ROWS,
                                           F.avg(value).over(past))
    return columns


def lag_features(df: DataFrame, key: str = "sensor_id", order: tuple[str, ...] = ("ts",),
                 value: str = "speed", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the lag and rolling columns; one window definition, one shuffle."""
    return row_window(df, [key], list(order), lambda w: lag_columns(w, value),
                      before=max(LAGS.values()), block_rows=block_rows)


def calendar_columns(ts: Column) -> dict[str, Column]:
    return {"hour": hour_of_day(ts), "dow": iso_weekday(ts), "is_weekend": is_weekend(ts)}


def speed_features(df: DataFrame, key: str = "sensor_id", order: tuple[str, ...] = ("ts",),
                   value: str = "speed", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The seven model features; rows with a missing one are dropped."""
    lagged = lag_features(df, key, order, value, block_rows)
    return drop_missing(lagged.withColumns(calendar_columns(F.col(order[0]))), *FEATURES)


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name))


def _count_at(probes: DataFrame, changes: DataFrame, key: str, tie: str, out: str,
              block_rows: int) -> DataFrame:
    """Running total of `changes(key, _t, _kind, _delta)` at each row of `probes`.

    At one instant arrivals (kind 0) come before the probe (kind 1) and departures (kind 2)
    after it. Changes are already summed per instant, so copies do not travel.
    """
    probe = probes.withColumns({"_kind": F.lit(1), "_delta": F.lit(0).cast("bigint"),
                                "_tie": F.col(tie).cast("string")})
    both = probe.unionByName(changes, allowMissingColumns=True)
    counted = running_sum(both, [key], ["_t", "_kind", "_tie"], "_delta", out, block_rows,
                          sizes=probes, derived=True)
    return counted.filter(F.col("_kind") == 1).drop("_kind", "_delta", "_tie")


def sliding_distinct(df: DataFrame, key: str, item: str, ts: str, tie: str,
                     seconds: float = UNIQUE_WINDOW_SEC, out: str = "unique_count_5min",
                     sightings: DataFrame | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct items of the key in the last `seconds`, both ends included.

    The sightings of an item are merged into stays: an item is present from its first sighting
    until `seconds` after the last one that follows without a longer gap. Each stay adds one
    arrival and one departure, and the count is a running sum of those. Cost grows with rows,
    not with rows times window. Rows without an item are frames without a detection: they are
    counted at, and add nothing. If frames and sightings are separate tables, `df` has the
    rows to count at and `sightings` the items.
    """
    width = round(seconds * 1_000_000)
    timed = df.withColumn("_t", _micros(ts))
    items = timed if sightings is None else sightings.withColumn("_t", _micros(ts))
    seen = items.filter(F.col(item).isNotNull()).select(key, item, "_t").distinct()
    gaps = row_window(seen, [key, item], ["_t"],
                      lambda w: {"_prev": F.lag("_t").over(w), "_next": F.lead("_t").over(w)},
                      before=1, after=1, block_rows=block_rows, sizes=items, derived=True)
    arrives = F.col("_prev").isNull() | (F.col("_t") - F.col("_prev") > width)
    departs = F.col("_next").isNull() | (F.col("_next") - F.col("_t") > width)
    change = F.array(
        F.when(arrives, F.struct(F.col("_t").alias("_t"), F.lit(0).alias("_kind"), F.lit(1).alias("_d"))),
        F.when(departs, F.struct((F.col("_t") + width).alias("_t"), F.lit(2).alias("_kind"), F.lit(-1).alias("_d"))))
    changes = (gaps.select(key, F.explode(change).alias("_c")).filter(F.col("_c").isNotNull())
               .select(key, "_c.*").groupBy(key, "_t", "_kind").agg(F.sum("_d").alias("_delta")))
    return _count_at(timed, changes, key, tie, out, block_rows).drop("_t")


def running_distinct(df: DataFrame, key: str, item: str, ts: str, tie: str,
                     out: str = "unique_count_session", sightings: DataFrame | None = None,
                     block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Distinct items of the key since the start (W7): a running sum of first sightings."""
    timed = df.withColumn("_t", _micros(ts))
    items = timed if sightings is None else sightings.withColumn("_t", _micros(ts))
    changes = (items.filter(F.col(item).isNotNull()).groupBy(key, item).agg(F.min("_t").alias("_t"))
               .groupBy(key, "_t").agg(F.count(F.lit(1)).alias("_delta")).withColumn("_kind", F.lit(0)))
    return _count_at(timed, changes, key, tie, out, block_rows).drop("_t")


def frame_counts(frames: DataFrame, seconds: float = UNIQUE_WINDOW_SEC, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Both counts at each frame of `(camera_id, frame_id, ts, track_ids)`."""
    seen = frames.select("camera_id", "ts", F.explode("track_ids").alias("track_id"))
    recent = sliding_distinct(frames, "camera_id", "track_id", "ts", "frame_id", seconds,
                              sightings=seen, block_rows=block_rows)
    return running_distinct(recent, "camera_id", "track_id", "ts", "frame_id", sightings=seen, block_rows=block_rows)


def first_of_groups(df: DataFrame, key: str, order: list[str], groups: int, rows: int) -> DataFrame:
    """First `rows` rows of each of the first `groups` keys by name.

    `groups` bounds the broadcast side. Up to MAP_SIDE_ROWS the row limit is applied in the map
    tasks already, so a large group sends no more than `rows` rows per task.
    """
    names = df.select(key).distinct().orderBy(key).limit(groups)
    kept = df.join(F.broadcast(names), key, "left_semi") if groups <= 100_000 else df.join(names, key, "left_semi")
    if rows > MAP_SIDE_ROWS:
        ranked = _numbered(kept, key, order)
    else:
        ranked = kept.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col("_place") <= rows).drop("_place")


def _numbered(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Number the rows of each key from 1, keys of any size."""
    return running_sum(df.withColumn("_one", F.lit(1).cast("bigint")), [key], order, "_one", "_place").drop("_one")


def newest_rows(df: DataFrame, key: str, *order: str, rows: int = HISTORY_ROWS) -> DataFrame:
    """The newest `rows` rows per key."""
    if rows > MAP_SIDE_ROWS:
        totals = df.groupBy(key).agg(F.count(F.lit(1)).alias("_total"))
        ranked = _numbered(df, key, order).join(totals, key)
        return ranked.filter(F.col("_total") - F.col("_place") < rows).drop("_place", "_total")
    place = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order]))
    return df.withColumn("_place", place).filter(F.col("_place") <= rows).drop("_place")


def tail_window(df: DataFrame, ts: str, minutes: float) -> DataFrame:
    """Rows of the last `minutes` before the newest row.

    The bound is a scalar subquery, evaluated once before the scan, so it can prune.
    """
    oldest = df.select(F.max(ts) - F.make_dt_interval(mins=F.lit(0), secs=F.lit(minutes * 60.0).cast("decimal(18,6)")))
    return df.filter(F.col(ts) >= oldest.scalar())


def split_groups(df: DataFrame, key: str, ratios: tuple[float, float] = SPLIT_RATIOS,
                 seed: int = SPLIT_SEED, out: str = "split") -> DataFrame:
    """Assign whole groups to train, val and test.

    Groups are put in the order of a hash of name and seed and cut at `int(0.70 n)` and
    `int(0.85 n)`, so the result does not depend on partitioning.
    """
    names = df.select(key).distinct().withColumn("_h", F.md5(F.concat_ws("|", F.col(key), F.lit(seed))))
    placed = row_index(names, ["_h", key], "_place")
    total = names.select(F.count(F.lit(1))).scalar()
    place, n = F.col("_place"), total.cast("double")
    part = (F.when(place < F.floor(n * ratios[0]), "train")
            .when(place < F.floor(n * ratios[1]), "val").otherwise("test"))
    return df.join(placed.select(key, part.alias(out)), key)
