"""Figures of the dashboards: means, errors, histograms, rates, quantiles, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streetflow.functions.display import CONGESTION_MPH
from streetflow.operators.blocks import BLOCK_ROWS, running_sum
from streetflow.operators.windows import latest_per

# Histogram bins, list lengths, rate window, latency bucket bounds.
RESIDUAL_BINS = 40
NEWEST_READINGS = 5000
TOP_KEYS = 10
RATE_WINDOW = "1 minute"
LATENCY_WINDOW = "5 minutes"
INFERENCE_US_BUCKETS = [50, 100, 200, 500, 1000, 2000, 5000, 10000]
INFERENCE_SECONDS_BUCKETS = [0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0]
UPLOAD_SECONDS_BUCKETS = [0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0]


def newest(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The `n` newest rows (T1, S2): each task keeps its own `n`, no full sort."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order]).limit(n)


def network_speed(readings: DataFrame, threshold: float = CONGESTION_MPH) -> DataFrame:
    """Mean speed and congested share in percent (A1, A2)."""
    return readings.agg(F.avg("speed").alias("avg_speed"),
                        (F.avg((F.col("speed") < threshold).cast("int")) * 100).alias("congested_pct"))


def vehicles_now(counts: DataFrame, key: str = "camera_id", order: Sequence[str] = ("ts",),
                 count: str = "unique_count_5min") -> DataFrame:
    """Sum of the latest count of every camera, and the number of cameras (A3)."""
    latest = latest_per(counts, key, *order)
    return latest.agg(F.sum(count).cast("bigint").alias("vehicles"), F.count(F.lit(1)).alias("active_cameras"))


def regression_errors(df: DataFrame, actual: str = "actual_speed", predicted: str = "predicted_speed",
                      by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R2 in one pass (A4-A6); rows lacking either value are left out."""
    y, error = F.col(actual).cast("double"), F.col(actual).cast("double") - F.col(predicted).cast("double")
    rows = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return rows.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.sum(error * error), F.var_pop(y) * F.count(y))).alias("r2"),
        F.count(F.lit(1)).alias("n"))


def residual_histogram(df: DataFrame, value: str = "residual", bins: int = RESIDUAL_BINS) -> DataFrame:
    """Equal bins from minimum to maximum, the last one closed on the right.

    Empty bins are listed with 0. If all values are equal the range is widened by 0.5 on both
    sides, so they fall in one bin.
    """
    x = F.col(value).cast("double")
    rows = df.filter(x.isNotNull() & ~F.isnan(x)).select(x.alias("_x"))
    lo, hi = F.col("_lo"), F.col("_hi")
    span = (rows.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
            .select(F.when(lo == hi, lo - 0.5).otherwise(lo).alias("_lo"),
                    F.when(lo == hi, hi + 0.5).otherwise(hi).alias("_hi")))
    low, high = span.select("_lo").scalar(), span.select("_hi").scalar()
    placed = rows.select(F.least(F.width_bucket("_x", low, high, F.lit(bins)), F.lit(bins)).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    return (every.join(counts, "bin", "left")
            .select("bin", (low + (F.col("bin") - 1) * (high - low) / bins).alias("bin_start"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def batch_counts(batch: DataFrame, good: Column, alert: Column) -> DataFrame:
    """Valid, invalid and alert counts of a batch in one aggregation."""
    ok = F.coalesce(good, F.lit(False))
    return batch.agg(F.count_if(ok).alias("valid_count"), F.count_if(~ok).alias("invalid_count"),
                     F.count_if(ok & F.coalesce(alert, F.lit(False))).alias("alerts_count"))


def count_by(df: DataFrame, *keys: str, out: str = "n") -> DataFrame:
    """Rows per key or per reason (A10)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def throughput(df: DataFrame, key: str, ts: str = "ts", window: str = RATE_WINDOW,
               slide: str | None = None) -> DataFrame:
    """Rows per second and key in windows of one minute (A11); works on streams as well."""
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    seconds = F.unix_timestamp("w.end") - F.unix_timestamp("w.start")
    return (df.groupBy(span.alias("w"), key).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), key, "n", (F.col("n") / seconds).alias("per_second")))


def top_keys(rates: DataFrame, key: str, n: int = TOP_KEYS) -> DataFrame:
    """The `n` busiest keys of each window, ties by key."""
    busiest = Window.partitionBy("window_start").orderBy(F.col("n").desc(), F.col(key))
    return rates.withColumn("place", F.row_number().over(busiest)).filter(F.col("place") <= n)


def latency_quantiles(df: DataFrame, keys: Sequence[str], value: str, quantiles: Sequence[float] = (0.5, 0.95),
                      exact: bool = True, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One column `p50`, `p95`, ... per quantile, with linear interpolation.

    Equal to the usual `percentile`. The exact form counts equal values first and then walks the cumulative counts, so no task
    holds all values of a key. The approximate form is a mergeable sketch.
    """
    names = {q: f"p{q * 100:g}".replace(".", "_") for q in quantiles}
    rows = df.filter(F.col(value).isNotNull())
    if not exact:
        return rows.groupBy(*keys).agg(*[F.percentile_approx(value, q, 100_000).alias(n) for q, n in names.items()])
    counts = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    ranked = running_sum(counts, keys, [value], "_n", "_upto", block_rows, derived=True)
    ranked = ranked.join(totals, list(keys)) if keys else ranked.withColumn("_total", totals.scalar())

    def at(place: Column) -> Column:
        """The value at a zero-based place of the sorted rows."""
        return F.max(F.when((place >= F.col("_upto") - F.col("_n")) & (place < F.col("_upto")), F.col(value)))

    parts = []
    for q, name in names.items():
        place = (F.col("_total") - 1) * F.lit(q)
        parts += [at(F.floor(place)).alias(f"_lo_{name}"), at(F.ceil(place)).alias(f"_hi_{name}")]
    found = ranked.groupBy(*keys, "_total").agg(*parts)

    def between(q: float, name: str) -> Column:
        place = (F.col("_total") - 1) * F.lit(q)
        share = place - F.floor(place)
        return (F.col(f"_lo_{name}") + share * (F.col(f"_hi_{name}") - F.col(f"_lo_{name}"))).alias(name)

    return found.select(*keys, *[between(q, n) for q, n in names.items()])


def latency_buckets(df: DataFrame, value: str, ts: str = "ts", window: str = LATENCY_WINDOW,
                    bounds: Sequence[float] = INFERENCE_US_BUCKETS) -> DataFrame:
    """Heat map: rows per window with value <= bound, for each bound and for infinity.

    The counts are cumulative and conditional sums of one aggregation, so buckets without a
    row are present too.
    """
    x = F.col(value)
    le = [F.count_if(x <= b).alias(f"_le_{i}") for i, b in enumerate(bounds)]
    wide = df.filter(x.isNotNull()).groupBy(F.window(ts, window).alias("w")).agg(
        *le, F.count(F.lit(1)).alias(f"_le_{len(bounds)}"))
    labels = [f"{b:g}" for b in bounds] + ["+Inf"]
    pairs = F.array(*[F.struct(F.lit(label).alias("le"), F.col(f"_le_{i}").alias("n"))
                      for i, label in enumerate(labels)])
    return wide.select(F.col("w.start").alias("window_start"), F.explode(pairs).alias("_p")).select("window_start", "_p.*")


def bucket_quantiles(df: DataFrame, value: str, ts: str = "ts", window: str = LATENCY_WINDOW,
                     bounds: Sequence[float] = INFERENCE_US_BUCKETS, quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Quantiles per window as monitoring estimates them from bucket counts.

    The rank is placed in its bucket and interpolated between the bucket's bounds, the first
    bucket starting at 0; a rank above the last bound gives that bound.
    """
    x, total = F.col(value), F.col(f"_le_{len(bounds)}")
    le = [F.count_if(x <= b).alias(f"_le_{i}") for i, b in enumerate(bounds)]
    wide = df.filter(x.isNotNull()).groupBy(F.window(ts, window).alias("w")).agg(
        *le, F.count(F.lit(1)).alias(f"_le_{len(bounds)}"))

    def estimate(q: float) -> Column:
        rank = total * F.lit(q)
        guess = F.lit(float(bounds[-1]))
        for i in reversed(range(len(bounds))):
            low, below = (float(bounds[i - 1]), F.col(f"_le_{i - 1}")) if i else (0.0, F.lit(0))
            inside = F.lit(low) + (float(bounds[i]) - low) * (rank - below) / (F.col(f"_le_{i}") - below)
            guess = F.when(F.col(f"_le_{i}") >= rank, inside).otherwise(guess)
        return guess.alias(f"p{q * 100:g}".replace(".", "_"))

    return wide.select(F.col("w.start").alias("window_start"), *[estimate(q) for q in quantiles])


def active_entities(df: DataFrame, key: str) -> DataFrame:
    """Number of distinct keys."""
    return df.select(key).distinct().agg(F.count(key).alias("active"))


def map_centre(df: DataFrame) -> DataFrame:
    """Mean position."""
    return df.agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def label_files(boxes: DataFrame) -> DataFrame:
    """One text per labelled frame: its label lines, one per line, in box order.

    `boxes(sequence, frame, box, line)`. The lines of a frame are as many as the boxes in one
    picture.
    """
    lines = F.transform(F.array_sort(F.collect_list(F.struct("box", "line"))), lambda b: b["line"])
    return boxes.groupBy("sequence", "frame").agg(F.array_join(lines, "\n").alias("label"))
